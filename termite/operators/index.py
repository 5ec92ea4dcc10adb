"""Indexing operators: token table (F5), term statistics (A1-A3, A10), the
dictionary (A4), the inverted index (A5), collection idf (A6) and the term
weight matrix (A7).

Everything is long and sparse: ``tokens(doc_id, pos, term)``,
``postings(term, doc_id, tf, first_pos)``, ``vocab(term, cf, df, ...)``.  No
dense docs x terms matrix is ever built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termite.functions import constants as K
from termite.operators.conflation import Conflation, term_arrays
from termite.session import cut_lineage


def token_table(docs: DataFrame, text_col: str = "text", stemmer: str | None | Conflation = "s",
                id_col: str = "doc_id") -> DataFrame:
    """F5 + P13: documents -> ``(doc_id, pos, term)``, one row per kept token,
    ``pos`` = position among the kept tokens of the document."""
    return term_arrays(docs, id_col, text_col, stemmer).select(
        F.col(id_col).alias("doc_id"), F.posexplode("terms").alias("pos", "term"))


def postings(tokens: DataFrame) -> DataFrame:
    """A5: ``(term, doc_id, tf, first_pos)``.

    Grouping on ``(term, doc_id)`` spreads a hot term over all its documents,
    and the partial (map-side) aggregate shrinks tokens before the shuffle."""
    return tokens.groupBy("term", "doc_id").agg(
        F.count(F.lit(1)).alias("tf"), F.min("pos").alias("first_pos"))


def vocabulary(post: DataFrame, key: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A1/A2: ``(term, cf, df, first_doc, first_pos)``; ``first_*`` is the first
    occurrence in corpus order, that of the documents' ``key`` and ``pos``."""
    first = F.min(F.struct(*key, "first_pos"))
    return post.groupBy("term").agg(
        F.sum("tf").alias("cf"),
        F.count(F.lit(1)).alias("df"),
        first.alias("_first"),
    ).select("term", "cf", "df",
             F.col("_first.doc_id").alias("first_doc"),
             F.col("_first.first_pos").alias("first_pos"))


def with_collection_idf(vocab: DataFrame) -> DataFrame:
    """``idf = ln((1 + N) / (1 + cf)) + 1`` with N = all tokens of the corpus
    (every token occurrence is a "document" of the vectoriser, as in the
    original).  Also ``idf_dec``: idf rounded to 6 places as a decimal, used
    for exact, order-independent score sums.

    N is a scalar subquery, evaluated once and inlined; no join."""
    n_tokens = vocab.agg(F.sum("cf")).scalar()
    idf = F.log((F.lit(1) + n_tokens) / (F.lit(1) + F.col("cf"))) + F.lit(1)
    idf_dec = F.round(F.col("idf"), K.IDF_SCALE).cast(K.SCORE_DECIMAL)
    return vocab.withColumn("idf", idf).withColumn("idf_dec", idf_dec).withColumn(
        "idf_units", (F.col("idf_dec") * K.IDF_UNITS).cast("long"))


def term_frequency(tokens: DataFrame) -> DataFrame:
    """A1: corpus-wide ``(term, cf)`` of tokens, or of postings with their ``tf``."""
    times = F.sum("tf") if "tf" in tokens.columns else F.count(F.lit(1))
    return tokens.groupBy("term").agg(times.alias("cf"))


def corpus_stats(tokens: DataFrame) -> DataFrame:
    """A2: one row ``(total_terms, unique_terms)``."""
    return tokens.agg(F.count(F.lit(1)).alias("total_terms"),
                      F.count_distinct("term").alias("unique_terms"))


def top_terms(tokens: DataFrame, min_cf: int = K.TOP_TERM_MIN_CF) -> DataFrame:
    """A3 + F7: ``(term, cf)`` with cf > min_cf; order with ``cf desc, term``."""
    return term_frequency(tokens).where(F.col("cf") > min_cf)


def most_common(tokens: DataFrame, n: int) -> DataFrame:
    """The n most common terms (a top-k: planned as TakeOrderedAndProject)."""
    return term_frequency(tokens).orderBy(F.col("cf").desc(), F.col("term")).limit(n)


def distinct_terms_per_doc(post: DataFrame) -> DataFrame:
    """A10: ``(doc_id, n_terms)`` - row sums of the binary doc x term matrix."""
    return post.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"))


def dense_ids(df: DataFrame, order_col: str, id_col: str) -> DataFrame:
    """Dense 0-based ids in ``order_col`` order without a single-partition window.

    Range-sort, write the sorted rows once (a reliable checkpoint fixes the
    partition layout, so a lost executor cannot reshuffle ids), count rows per
    partition, and add each row's partition offset (a table with one row per
    partition, broadcast) to its index within the partition."""
    sorted_df = df.orderBy(order_col).select(
        "*", F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mid"))
    sorted_df = cut_lineage(sorted_df)
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                          F.min("_mid").alias("_base"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_base",
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = sorted_df.join(F.broadcast(offsets), "_pid")
    return out.withColumn(id_col, F.col("_off") + F.col("_mid") - F.col("_base")).drop(
        "_pid", "_mid", "_base", "_off")


def ordinal_within(df: DataFrame, group_col: str, order_cols: list, out_col: str) -> DataFrame:
    """1-based position of each row within its ``group_col`` group, in
    ``order_cols`` order - ``row_number()`` without a window per group.

    A global range sort splits even a group holding a third of all rows over
    many tasks; the sorted rows are written once (reliable checkpoint), each
    (partition, group) run is counted, and a row's rank is the sum of the runs
    of its group in earlier partitions plus its index in its own run.  Only the
    run counts (one row per partition and group) are windowed."""
    keys = [F.col(group_col)] + list(order_cols)
    sorted_df = df.orderBy(*keys).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    sorted_df = cut_lineage(sorted_df)
    runs = sorted_df.groupBy("_pid", group_col).agg(F.count(F.lit(1)).alias("_n"),
                                                    F.min("_mid").alias("_base"))
    w = Window.partitionBy(group_col).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("_pid", group_col, "_base", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = sorted_df.join(offsets, ["_pid", group_col])
    return out.withColumn(out_col, (F.col("_off") + F.col("_mid") - F.col("_base") + 1).cast("int")).drop(
        "_pid", "_mid", "_base", "_off")


def build_dictionary(vocab: DataFrame) -> DataFrame:
    """A4: ``(term, term_id)``, ids dense and lexicographic."""
    return dense_ids(vocab.select("term"), "term", "term_id")


def term_weights(post: DataFrame, vocab_idf: DataFrame) -> DataFrame:
    """``(doc_id, term, tf, tfidf)``."""
    return post.join(vocab_idf.select("term", "idf_dec"), "term").select(
        "doc_id", "term", "tf", (F.col("tf") * F.col("idf_dec")).cast("double").alias("tfidf"))


@dataclass
class Index:
    """The index tables of one corpus (lazy DataFrames)."""

    tokens: DataFrame
    postings: DataFrame
    vocab: DataFrame  # with idf


def build_index(docs: DataFrame, text_col: str = "text", stemmer: str | None | Conflation = "s") -> Index:
    toks = token_table(docs, text_col, stemmer)
    post = postings(toks)
    vocab = with_collection_idf(vocabulary(post))
    return Index(toks, post, vocab)
