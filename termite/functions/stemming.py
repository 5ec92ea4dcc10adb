"""Stemmers (P11).

* ``s_stem`` - the plural-only S-stemmer (Harman 1991) as a column expression.
* ``porter_stem`` - the Porter (1980) algorithm as a plain Python function, and
  ``porter_stem_terms`` which applies it through an Arrow-batched pandas UDF to
  the *distinct* vocabulary only, so it runs once per term, not per token; the
  result is joined back on ``term``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def s_stem(x: Column) -> Column:
    """Harman's S-stemmer: -ies -> -y (not -eies/-aies), -es -> -e (not
    -aes/-ees/-oes), -s -> '' (not -us/-ss); first matching rule wins."""
    n = F.length(x)
    return (
        F.when(x.endswith("ies") & ~x.endswith("eies") & ~x.endswith("aies"),
               F.concat(x.substr(F.lit(1), n - 3), F.lit("y")))
        .when(x.endswith("es") & ~x.endswith("aes") & ~x.endswith("ees") & ~x.endswith("oes"),
              x.substr(F.lit(1), n - 1))
        .when(x.endswith("s") & ~x.endswith("us") & ~x.endswith("ss"),
              x.substr(F.lit(1), n - 1))
        .otherwise(x)
    )


# --- Porter (1980), "An algorithm for suffix stripping" ----------------------

_VOWELS = frozenset("aeiou")


def _is_cons(w: str, i: int) -> bool:
    c = w[i]
    if c in _VOWELS:
        return False
    if c == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC){m}[V]."""
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        cons = _is_cons(stem, i)
        if cons and prev_vowel:
            m += 1
        prev_vowel = not cons
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) < 3:
        return False
    return (_is_cons(w, len(w) - 3) and not _is_cons(w, len(w) - 2)
            and _is_cons(w, len(w) - 1) and w[-1] not in "wxy")


def _replace_m(w: str, suffix: str, repl: str, min_m: int) -> str | None:
    """If w ends in suffix: replace when m(stem) > min_m and return the word,
    else return w unchanged; None when the suffix does not match."""
    if not w.endswith(suffix):
        return None
    stem = w[: len(w) - len(suffix)]
    return stem + repl if _measure(stem) > min_m else w


# Suffix rules of steps 2, 3 and 4 of the published algorithm (fixed values).
_STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
          ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"),
          ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
          ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
          ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
_STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
          ("ical", "ic"), ("ful", ""), ("ness", "")]
_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
          "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def porter_stem(word: str) -> str:
    """Porter stem of a lower-case word (words of <= 2 letters are kept)."""
    w = word
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    extra = False
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # step 2
    for suf, rep in _STEP2:
        r = _replace_m(w, suf, rep, 0)
        if r is not None:
            w = r
            break
    # step 3
    for suf, rep in _STEP3:
        r = _replace_m(w, suf, rep, 0)
        if r is not None:
            w = r
            break
    # step 4
    for suf in _STEP4:
        if w.endswith(suf):
            stem = w[: len(w) - len(suf)]
            if suf == "ion":
                if _measure(stem) > 1 and stem[-1:] in ("s", "t"):
                    w = stem
            elif _measure(stem) > 1:
                w = stem
            break
    # step 5a
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _cvc(stem)):
            w = stem
    # step 5b
    if _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w


@F.pandas_udf(T.StringType())
def _porter_udf(terms: pd.Series) -> pd.Series:
    return terms.map(porter_stem)


def porter_stem_terms(vocab: DataFrame, term_col: str = "term") -> DataFrame:
    """(term) -> (term, stem) over the distinct terms of ``vocab``.

    Run on the distinct vocabulary, then join the mapping back to the token
    table on ``term``; the UDF is Arrow-batched and never touches tokens."""
    distinct = vocab.select(F.col(term_col).alias("term")).distinct()
    return distinct.select("term", _porter_udf(F.col("term")).alias("stem"))


def apply_term_map(tokens: DataFrame, mapping: DataFrame, src: str = "term",
                   dst: str = "stem") -> DataFrame:
    """Replace ``tokens.term`` by ``mapping.dst`` where a mapping exists.

    ``mapping`` has one row per distinct term, so the join is an equi-join on
    ``term``; Catalyst/AQE pick broadcast or sort-merge from its size."""
    m = mapping.select(F.col(src).alias("_t"), F.col(dst).alias("_m"))
    out = tokens.join(m, tokens["term"] == m["_t"], "left")
    return out.withColumn("term", F.coalesce(F.col("_m"), F.col("term"))).drop("_t", "_m")
