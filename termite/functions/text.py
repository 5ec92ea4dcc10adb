"""Scalar text functions as Spark column expressions.

All of them are built-in Catalyst expressions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termite.functions import constants as K
from termite.functions.stemming import s_stem


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def concat_fields(*cols: Column | str) -> Column:
    """Join text fields with one space (NULL fields are skipped)."""
    return F.concat_ws(" ", *[_c(c) for c in cols])


def strip_punctuation(col: Column | str) -> Column:
    """Delete the 32 ASCII punctuation characters."""
    return F.translate(_c(col), K.PUNCTUATION, "")


def strip_digits(col: Column | str) -> Column:
    """Delete digits."""
    return F.regexp_replace(_c(col), "[0-9]+", "")


def non_alnum_to_space(col: Column | str) -> Column:
    """Every run of characters outside [0-9a-zA-Z] becomes one space."""
    return F.regexp_replace(_c(col), K.NON_ALNUM_PATTERN, " ")


def collapse_whitespace(col: Column | str) -> Column:
    """P5: runs of whitespace (NBSP included) to one space, trimmed."""
    return F.trim(F.regexp_replace(_c(col), "[\\s\\u00a0]+", " "))


def fold_case(col: Column | str) -> Column:
    """Lower-case."""
    return F.lower(_c(col))


def strip_parenthesised(col: Column | str) -> Column:
    """Delete parenthesised parts."""
    return F.regexp_replace(_c(col), "\\([^)]*\\)", "")


def tokenize(col: Column | str) -> Column:
    """Array of terms (runs of >= 2 letters, digits or underscores)."""
    return F.regexp_extract_all(_c(col), F.lit(K.TOKEN_PATTERN), 0)


def remove_stopwords(tokens: Column | str) -> Column:
    """Drop stop words and single characters from a token array.

    The membership test is an ``IN`` list, which Catalyst turns into a hash
    set lookup (``InSet``)."""
    words = list(K.stop_words())
    return F.filter(_c(tokens), lambda x: (F.length(x) >= 2) & ~x.isin(words))


def normalise(text: Column | str, stemmer: str | None = "s") -> Column:
    """Text -> ordered term array.

    lower-case, delete punctuation, split into terms, optionally conflate with
    the S-stemmer (``stemmer='s'``), then drop stop words.  Stop words are
    tested after stemming, as in the original pipeline.  ``stemmer='porter'``
    is not a column expression: :func:`termite.operators.conflation.term_arrays` applies
    it over the distinct vocabulary instead.
    """
    toks = tokenize(strip_punctuation(fold_case(text)))
    if stemmer == "s":
        toks = F.transform(toks, s_stem)
    elif stemmer not in (None, "none"):
        raise ValueError(f"column stemmer must be 's' or None, got {stemmer!r}")
    return remove_stopwords(toks)


def normalise_for_bigrams(text: Column | str, stemmer: str | None = "s") -> Column:
    """Collapse whitespace, delete punctuation and digits, then P13's token part."""
    t = strip_digits(strip_punctuation(collapse_whitespace(text)))
    return normalise(t, stemmer)


def binarise(count: Column | str) -> Column:
    """1 if count > 0 else 0."""
    return (_c(count) > 0).cast("int")


def edit_distance(a: Column | str, b: Column | str, threshold: int | None = None) -> Column:
    """Levenshtein distance in code points; -1 beyond ``threshold``."""
    if threshold is None:
        return F.levenshtein(_c(a), _c(b))
    return F.levenshtein(_c(a), _c(b), threshold)


def word_set(col: Column | str) -> Column:
    """Distinct whitespace-separated words of a string."""
    return F.array_distinct(F.filter(F.split(_c(col), "\\s+"), lambda x: x != ""))


def set_jaccard(a: Column | str, b: Column | str) -> Column:
    """|A n B| / |A u B| over whitespace word sets (NULL when both are empty)."""
    sa, sb = word_set(a), word_set(b)
    union = F.size(F.array_union(sa, sb))
    return F.when(union > 0, F.size(F.array_intersect(sa, sb)) / union)


def count_term_in_list(tokens: Column | str, term: Column | str) -> Column:
    """Occurrences of ``term`` in a token array; NULL array -> 0."""
    t = _c(term)
    return F.coalesce(F.size(F.filter(_c(tokens), lambda x: x == t)), F.lit(0))
