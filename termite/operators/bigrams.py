"""Bigram language model.

The word stream is the concatenation of every document's terms in
``(doc_id, pos)`` order, so adjacent pairs also cross document ends (the last
term of a document followed by the first term of the next non-empty one).

Pairs inside a document come from the term array of that row.  Pairs across
document ends need each document's successor; instead of one global window
(a single task), the documents' first and last terms are sorted by range of
``doc_id``, whatever the ids look like: ``lead`` inside each range partition finds
most successors, and a summary with one row per partition (its first and last
term) links the partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termite.functions import constants as K
from termite.functions.text import normalise_for_bigrams
from termite.operators.index import ordinal_within
from termite.session import stored

SUCCESSORS_A_PIECE = 1024


def bigram_token_arrays(docs: DataFrame, text_col: str = "description",
                        stemmer: str | None = "s") -> DataFrame:
    """P14 per document: ``(doc_id, toks)``; documents without text are skipped."""
    return docs.where(F.col(text_col).isNotNull()).select(
        "doc_id", normalise_for_bigrams(F.col(text_col), stemmer).alias("toks"))


def adjacent_pairs(arrays: DataFrame, within_document: bool = False, partitions: int | None = None) -> DataFrame:
    """``(doc_id, pos, w1, w2)``; (doc_id, pos) locates ``w1``.  ``partitions``:
    ranges of document ids, by default as many as Spark makes of their size."""
    if not within_document:
        arrays = stored(arrays, "bigram-tokens")  # read twice; normalise once
    inner = arrays.where(F.size("toks") >= 2).select(
        "doc_id",
        F.posexplode(F.transform(
            F.sequence(F.lit(0), F.size("toks") - 2),
            lambda i: F.struct(F.element_at("toks", i + 1).alias("w1"),
                               F.element_at("toks", i + 2).alias("w2")))).alias("pos", "p"),
    ).select("doc_id", "pos", "p.w1", "p.w2")
    if within_document:
        return inner
    ends = arrays.where(F.size("toks") >= 1).select(
        "doc_id", (F.size("toks") - 1).alias("last_pos"),
        F.element_at("toks", 1).alias("first"), F.element_at("toks", -1).alias("last"))
    ends = ends.repartitionByRange(*([partitions] if partitions else []), "doc_id")
    ends = stored(ends.withColumn("part", F.spark_partition_id()), "document-ends")  # fixes the partitions' numbers
    in_part = ends.select("doc_id", "last_pos", "last", F.lead("first").over(
        Window.partitionBy("part").orderBy("doc_id")).alias("nxt"))
    seam_inner = in_part.where(F.col("nxt").isNotNull()).select(
        "doc_id", F.col("last_pos").alias("pos"), F.col("last").alias("w1"), F.col("nxt").alias("w2"))
    summary = ends.groupBy("part").agg(
        F.max_by(F.struct("doc_id", "last_pos", "last"), "doc_id").alias("tail"),
        F.min_by("first", "doc_id").alias("head"))
    by_part = Window.orderBy("part")  # one row per partition: a small table
    seam_outer = summary.select("tail", F.lead("head").over(by_part).alias("nxt")).where(
        F.col("nxt").isNotNull()).select(
        F.col("tail.doc_id").alias("doc_id"), F.col("tail.last_pos").alias("pos"),
        F.col("tail.last").alias("w1"), F.col("nxt").alias("w2"))
    return inner.unionByName(seam_inner).unionByName(seam_outer)


def bigram_counts(pairs: DataFrame) -> DataFrame:
    """``(w1, w2, cnt)`` (partial aggregation before the shuffle)."""
    return pairs.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("cnt"))


def filter_bigrams(counts: DataFrame, min_count: int = K.BIGRAM_MIN_COUNT) -> DataFrame:
    """F8: frequency >= min_count."""
    return counts.where(F.col("cnt") >= min_count)


def sort_bigrams(counts: DataFrame) -> DataFrame:
    """Most frequent first (distributed range sort)."""
    return counts.orderBy(F.col("cnt").desc(), "w1", "w2")


def bigram_nested(counts: DataFrame, size: int = SUCCESSORS_A_PIECE) -> DataFrame:
    """``(w1, piece, successors ARRAY<STRUCT<w2, cnt>>)``, the successors of
    each word by falling count, then word, in pieces of ``size``: a word with very
    many successors is many rows, and no list outgrows a piece."""
    placed = ordinal_within(counts, "w1", [F.col("cnt").desc(), F.col("w2")], "place")
    pieces = placed.groupBy("w1", F.floor((F.col("place") - 1) / size).alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("place", "w2", "cnt"))).alias("v"))
    return pieces.select("w1", "piece", F.transform("v", lambda x: F.struct(
        x["w2"].alias("w2"), x["cnt"].alias("cnt"))).alias("successors"))


def successors_of(nested: DataFrame, size: int = SUCCESSORS_A_PIECE) -> DataFrame:
    """The nested model as rows: ``(w1, place, w2, cnt)``, places from 1."""
    rows = nested.select("w1", "piece", F.posexplode("successors").alias("at", "s"))
    return rows.select("w1", (F.col("piece") * size + F.col("at") + 1).alias("place"), "s.w2", "s.cnt")


def bigram_model(docs: DataFrame, text_col: str = "description",
                 min_count: int = K.BIGRAM_MIN_COUNT, within_document: bool = False) -> DataFrame:
    """P14 -> W4 -> A12 -> F8 -> W8."""
    pairs = adjacent_pairs(bigram_token_arrays(docs, text_col), within_document)
    return sort_bigrams(filter_bigrams(bigram_counts(pairs), min_count))
