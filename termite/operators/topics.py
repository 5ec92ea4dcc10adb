"""Topic operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termite.functions.text import normalise


def split_train_predict(news: DataFrame) -> tuple[DataFrame, DataFrame]:
    """topiced documents train, untopiced ones are predicted."""
    return news.where(F.col("topics").isNotNull()), news.where(F.col("topics").isNull())


def explode_topics(news: DataFrame) -> DataFrame:
    """one row per (document, topic); ordered by doc_id."""
    return news.select("doc_id", F.explode("topics").alias("topic"))


def topic_documents(train_rows: DataFrame, predicted: DataFrame) -> DataFrame:
    """A11 (B5 inside): ``(topic, doc_id)`` over training rows and predictions,
    in long form - a topic may hold a large share of all documents, so its
    documents are never gathered into one list."""
    both = train_rows.select("topic", "doc_id").unionByName(predicted.select("topic", "doc_id"))
    return both.distinct()


def topic_restriction(topic_docs: DataFrame, topic: str) -> DataFrame:
    """documents of one topic (labels keep hyphens, e.g. ``soy-oil``)."""
    return topic_docs.where(F.col("topic") == topic).select("doc_id")


def classification_sets(news: DataFrame, stemmer: str | None = "s") -> DataFrame:
    """Training rows (cleaned, topic-exploded) and prediction rows
    (cleaned, topic NULL): ``(split, doc_id, topic, name, description, tokens)``."""
    toks = normalise(F.concat_ws(" ", "description", "name"), stemmer)
    base = news.select("doc_id", "topics", "name", "description", toks.alias("tokens"))
    train = base.where(F.col("topics").isNotNull()).select(
        F.lit("train").alias("split"), "doc_id", F.explode("topics").alias("topic"),
        "name", "description", "tokens")
    pred = base.where(F.col("topics").isNull()).select(
        F.lit("predict").alias("split"), "doc_id", F.lit(None).cast("string").alias("topic"),
        "name", "description", "tokens")
    return train.unionByName(pred)


def union_corpora(courses: DataFrame, news: DataFrame, *more: str) -> DataFrame:
    """Courses followed by news, one table with a ``corpus`` column, which makes
    ``doc_id`` unique again (D10), and the ``more`` columns of both."""
    c = courses.select(F.lit("course").alias("corpus"), "doc_id", "name", "description", *more)
    n = news.select(F.lit("news").alias("corpus"), "doc_id", "name", "description", *more)
    return c.unionByName(n)
