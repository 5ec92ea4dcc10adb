"""Vector-space ranking: query terms, scores (J3), ranks (W1) and top-k.

score(q, d) = sum over terms t of tf(d, t) * qtf(q, t) * idf(t), summed as
decimals so that the result does not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termite.functions import constants as K
from termite.operators.conflation import Conflation, term_arrays
from termite.operators.index import ordinal_within
from termite.plans.sizing import broadcast_if_small


def query_tokens(queries: DataFrame, stemmer: str | None | Conflation = "s") -> DataFrame:
    """P13 on query texts: ``(query_id, pos, term)``.  Punctuation such as
    ``?`` and ``,`` is removed like in documents (ledger D17)."""
    return term_arrays(queries, "query_id", "text", stemmer).select("query_id", F.posexplode("terms").alias("pos", "term"))


def query_term_counts(qtokens: DataFrame) -> DataFrame:
    """``(query_id, term, qtf)``."""
    return qtokens.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))


def vsm_scores(post: DataFrame, vocab_idf: DataFrame, qterms: DataFrame) -> DataFrame:
    """``(query_id, doc_id, score BIGINT in 10**-6 units)`` for documents sharing a term with
    the query.

    The weighted query terms (query batch x idf) are the small side: they are
    broadcast behind a measure of their bytes, so the postings are not shuffled
    for the join; the sum is partially aggregated before a shuffle on ``(query_id,
    doc_id)``, which postings bucketed by document do not need.  Documents with
    score 0 are absent (ledger D15)."""
    weighted = broadcast_if_small(qterms.join(vocab_idf.select("term", "idf_units"), "term").select(
        "query_id", "term", (F.col("qtf") * F.col("idf_units")).alias("w")))
    joined = post.select("term", "doc_id", "tf").join(weighted, "term")
    # exact 64-bit sum in units of 10**-6 (idf <= ~20, so far from overflow)
    scores = joined.groupBy("query_id", "doc_id").agg(
        F.sum(F.col("tf") * F.col("w")).alias("score"))
    return scores.where(F.col("score") > 0)


def rank_documents(scores: DataFrame, k: int | None = K.RESULTS_PER_QUERY) -> DataFrame:
    """W1 + W2: ``(query_id, rank, doc_id, score DOUBLE)``; ties by doc_id.

    ``row_number() <= k`` is planned as a partial WindowGroupLimit before the
    shuffle on query_id, so a query matching every document still moves only
    k rows per map partition."""
    if k is None:
        # the whole ranking: a query matching most documents must not become
        # one window task, so rank by a global range sort instead
        ranked = ordinal_within(scores, "query_id", [F.col("score").desc(), F.col("doc_id")], "rank")
    else:
        w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id"))
        ranked = scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "doc_id",
                         (F.col("score").cast("double") / K.IDF_UNITS).alias("score"))
