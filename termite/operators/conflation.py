"""P10 + P11 + P12 as one chain over a vocabulary: lemma, Porter stem, stop words.

Neither step is a column expression, and running them on every token would repeat
the work for each occurrence.  The distinct terms of the texts are conflated once
and stored; the tokens of documents and queries meet that table, or only the terms
that the chain changes, in a join, so both get the same forms."""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termite.functions import constants as K
from termite.functions import text as tx
from termite.functions.stemming import porter_stem_terms
from termite.plans.sizing import MAX_BROADCAST_BYTES, table_bytes
from termite.session import stored

HOT_TERM = 1 << 20    # occurrences above which a term is joined by broadcast in any case
MOST_HOT = 1 << 20    # so many such terms at most


@dataclass(frozen=True)
class Conflation:
    """``lemmas(term, lemma)`` first (None: no lemmas), then the Porter stemmer
    (unless ``porter`` is false), then stop words and single characters go."""

    lemmas: DataFrame | None = None
    porter: bool = True


def conflated_forms(terms: DataFrame, how: Conflation) -> DataFrame:
    """``(term, cf, form)`` of ``terms(term, cf)``, distinct; ``form`` is NULL for a
    term that the chain drops."""
    if how.lemmas is not None:
        lemmas = how.lemmas.groupBy("term").agg(F.min("lemma").alias("lemma"))
        forms = terms.join(lemmas, "term", "left").select("term", "cf", F.coalesce("lemma", "term").alias("form"))
    else:
        forms = terms.select("term", "cf", F.col("term").alias("form"))
    if how.porter:
        stems = porter_stem_terms(forms, "form").withColumnRenamed("term", "form")
        forms = forms.join(stems, "form").select("term", "cf", F.col("stem").alias("form"))
    kept = (F.length("form") >= 2) & ~F.col("form").isin(list(K.stop_words()))
    return stored(forms.select("term", "cf", F.when(kept, F.col("form")).alias("form")), "conflated-forms")


def hot_above(forms: DataFrame) -> int:
    """Occurrences above which terms are joined by broadcast: the most frequent ones,
    as many as may be broadcast (by the binary logarithm of their occurrences)."""
    total = forms.agg(F.sum("cf")).first()[0] or 0
    above = max(HOT_TERM, math.ceil(total / MOST_HOT))
    size = F.lit(24) + F.octet_length("term") + F.coalesce(F.octet_length("form"), F.lit(0))
    held = 0
    for level, more in sorted(forms.groupBy(F.floor(F.log2("cf"))).agg(F.sum(size)).collect(), reverse=True):
        held += more
        if held > MAX_BROADCAST_BYTES:
            break
        above = min(above, (1 << level) - 1)
    return above


def term_arrays(texts: DataFrame, id_col: str | list[str], text_col: str, how: str | None | Conflation,
                parts: int | None = None) -> DataFrame:
    """``(id_col, terms ARRAY)`` of every text, in its order; ``id_col`` may be
    several columns.  ``how``: "s" or None for the column expressions of
    :func:`normalise`, "porter" or a :class:`Conflation` for a chain over the
    vocabulary.  A text without terms has an empty array; rows with one id must
    have one text.

    The chain changes few of the terms; these go to all tasks.  If they are too many,
    the most frequent terms do, changed or not, and only the tokens of the other ones
    are shuffled.  With ``parts`` texts are dealt by ``doc_id`` to so many partitions
    before the chain, so that their tokens travel as whole texts, once."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    if how in ("s", "none", None):
        return texts.select(*ids, F.coalesce(tx.normalise(F.col(text_col), how), F.array().cast("array<string>")).alias("terms"))
    how = Conflation() if how == "porter" else how
    words = texts.select(*ids, tx.tokenize(tx.strip_punctuation(tx.fold_case(F.col(text_col)))).alias("words"))
    tokens = words.select(*ids, F.posexplode("words").alias("pos", "term"))
    forms = conflated_forms(tokens.groupBy("term").agg(F.count(F.lit(1)).alias("cf")), how)
    dealt = words.repartition(parts, "doc_id") if parts else words
    dealt = dealt.select(*ids, F.posexplode_outer("words").alias("pos", "term"))
    named = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ids])
    gather = lambda form: F.collect_list(F.when(form.isNotNull() & named, F.struct("pos", form.alias("form"))))
    changed = forms.where("form is null or form != term").select("term", "form", F.lit(True).alias("hit"))
    if table_bytes(changed) <= MAX_BROADCAST_BYTES:
        found = dealt.join(F.broadcast(changed), "term", "left")
        per_text = found.groupBy(*ids).agg(gather(F.when(F.col("hit"), F.col("form")).otherwise(F.col("term"))).alias("v"))
    else:
        above = hot_above(forms)
        hot = F.broadcast(forms.where(F.col("cf") > above).select("term", "form"))
        rare = forms.where((F.col("cf") <= above) & F.col("form").isNotNull()).select("term", "form")
        rest = tokens.join(hot.select("term"), "term", "left_anti").join(rare, "term")
        rest = rest.groupBy(*ids).agg(gather(F.col("form")).alias("more"))
        per_text = dealt.join(hot, "term", "left").groupBy(*ids).agg(gather(F.col("form")).alias("v")).join(rest, ids, "left")
        per_text = per_text.withColumn("v", F.when(F.col("more").isNull(), F.col("v")).otherwise(F.concat("v", "more")))
    return per_text.select(*ids, F.array_sort("v")["form"].alias("terms"))
