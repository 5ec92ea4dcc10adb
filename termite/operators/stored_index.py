"""An index written once and read by every search.

``postings`` is a table bucketed by ``doc_id``: all postings of a document lie in
one bucket, so scores are summed and the best documents chosen inside a bucket,
and only ``k`` rows a query leave it.  Inside a bucket the rows are sorted by the
document's size class (the binary logarithm of its number of terms) and term, so
that a filter on the class skips row groups.

``maxima`` holds the largest term frequency of each term and class.  Summed over a
query's terms it bounds the score of every document of a class.  A search first
scores the classes of the longest documents, which mostly hold the best ones, and
then only the classes whose bound reaches the query's k-th score.

Several corpora share one index if a document's key is (corpus, id): the postings
are partitioned by corpus too, so a search in one of them reads only its files."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termite.functions import constants as K
from termite.operators.conflation import Conflation, term_arrays
from termite.operators.index import vocabulary, with_collection_idf
from termite.plans.sizing import broadcast_if_small
from termite.session import scratch_path, stored

BUCKET_BYTES = 16 << 20  # text of a bucket: a task sorts the tokens of one, and its postings
MOST_BUCKETS = 1 << 15   # larger texts make larger buckets (Spark's own limit is 100,000)
FIRST_SHARE = 8         # the classes scored first hold an eighth of the documents


@dataclass
class StoredIndex:
    """Tables of one corpus; ``sizes``: documents by size class (64 at most)."""

    postings: DataFrame  # term, doc_id, tf, first_pos, size_class
    vocab: DataFrame     # term, cf, df, first_doc, first_pos, idf, idf_dec, idf_units
    maxima: DataFrame    # term, size_class, max_tf
    sizes: dict[int, int]
    key: tuple[str, ...] = ("doc_id",)  # columns that name a document, in result order


def bucket_count(spark: SparkSession, text_bytes: int) -> int:
    return max(spark.sparkContext.defaultParallelism, min(math.ceil(text_bytes / BUCKET_BYTES), MOST_BUCKETS))


def write_index(docs: DataFrame, text_col: str = "text", stemmer: str | None | Conflation = "s",
                buckets: int | None = None, corpus_col: str | None = None) -> StoredIndex:
    """Index ``docs(doc_id, text)``, with ``corpus_col`` documents of several corpora.
    The terms of a document travel once, to its bucket; its postings are counted
    there.  Documents without terms have none."""
    key = (corpus_col, "doc_id") if corpus_col else ("doc_id",)
    spark = docs.sparkSession
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
        buckets = bucket_count(spark, size)
    rows = term_arrays(docs, list(key), text_col, stemmer, buckets).repartition(buckets, "doc_id")
    rows = rows.withColumn("size_class", F.floor(F.log2(F.greatest(F.size("terms"), F.lit(1)))).cast("int"))
    tokens = rows.select(*key, "size_class", F.posexplode("terms").alias("pos", "term"))
    postings = tokens.groupBy(*key, "size_class", "term").agg(
        F.count(F.lit(1)).alias("tf"), F.min("pos").alias("first_pos"))
    name = f"termite_postings_{uuid.uuid4().hex}"
    writer = postings.select("term", *key, "tf", "first_pos", "size_class").write.bucketBy(buckets, "doc_id").sortBy(
        "size_class", "term").option("path", scratch_path(spark, "postings"))
    (writer.partitionBy(corpus_col) if corpus_col else writer).saveAsTable(name)
    postings = spark.table(name)
    vocab = stored(with_collection_idf(stored(vocabulary(postings, key), "term-counts")), "vocabulary")
    maxima = stored(postings.groupBy("term", "size_class").agg(F.max("tf").alias("max_tf")), "term-maxima")
    sizes = postings.groupBy("size_class").agg(F.count_distinct(*key).alias("n")).collect()
    return StoredIndex(postings, vocab, maxima, {r["size_class"]: r["n"] for r in sizes}, key)


def weighted_terms(qterms: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(query_id, term, w)``: query frequency times idf, in units of 10**-6."""
    return qterms.join(vocab.select("term", "idf_units"), "term").select(
        "query_id", "term", (F.col("qtf") * F.col("idf_units")).alias("w"))


def _best(postings: DataFrame, weights: DataFrame, on: list[str], k: int, key: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(query_id, doc_id, score)``: the k best documents of each query and more
    that tie inside other buckets.  With the weights broadcast, neither the sum nor
    the first choice of k needs an exchange."""
    hits = postings.select("term", *key, "tf", "size_class").join(weights, on)
    scores = hits.groupBy("query_id", *key).agg(F.sum(F.col("tf") * F.col("w")).alias("score")).where("score > 0")
    return _ranked(scores, k, key).drop("rank")


def _ranked(scores: DataFrame, k: int, key: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), *key)
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def first_classes(sizes: dict[int, int], k: int) -> list[int]:
    """The classes of the longest documents, at least ``k`` of these and an eighth
    of all."""
    out, held = [], 0
    for c in sorted(sizes, reverse=True):
        if held >= max(k, sum(sizes.values()) / FIRST_SHARE):
            break
        out.append(c)
        held += sizes[c]
    return out


def search(index: StoredIndex, qterms: DataFrame, k: int = K.RESULTS_PER_QUERY, allowed: DataFrame | None = None,
           corpus: str | None = None) -> DataFrame:
    """J3 + W1 + W2: ``(query_id, rank, doc_id, score DOUBLE)``, the k best documents
    of each query of ``qterms(query_id, term, qtf)``, ties by ``doc_id``; with
    ``allowed(doc_id)`` among those, with ``corpus`` among that corpus' (an index of
    several corpora gives theirs before ``doc_id``).  Scores are exact sums of
    integers."""
    postings, key = index.postings, index.key
    if corpus is not None:
        postings = postings.where(F.col(key[0]) == corpus)
    if allowed is not None:
        postings = postings.join(allowed.select(*key).distinct(), list(key), "left_semi")
    weights = stored(weighted_terms(qterms, index.vocab), "query-weights")
    side = broadcast_if_small(weights)
    first = first_classes(index.sizes, k)
    top = stored(_best(postings.where(F.col("size_class").isin(first)), side, ["term"], k, key), "first-results")
    rest = [c for c in index.sizes if c not in first]
    if rest:
        kth = _ranked(top, k, key).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
        bound = weights.join(index.maxima.where(F.col("size_class").isin(rest)), "term").groupBy("query_id", "size_class").agg(
            F.sum(F.col("w") * F.col("max_tf")).alias("bound"))
        open_ = bound.join(kth, "query_id", "left").where("least is null or bound >= least").select("query_id", "size_class")
        open_ = stored(open_, "open-classes")
        classes = [r[0] for r in open_.select("size_class").distinct().collect()]
        if classes:
            more = broadcast_if_small(weights.join(open_, "query_id"))
            top = top.unionByName(_best(postings.where(F.col("size_class").isin(classes)), more, ["term", "size_class"], k, key))
    return _ranked(top, k, key).select("query_id", F.col("rank").cast("int").alias("rank"), *key,
                                  (F.col("score").cast("double") / K.IDF_UNITS).alias("score"))
