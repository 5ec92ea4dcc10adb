"""Readers for the input tables and the mapping of the driver tables onto the
reference's two corpora (courses and newswire)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termite.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Parquet scan; listing columns here lets the scan read only those.

    A file is split only at row-group boundaries, so a table written as one
    row group scans in one task.  When the scan yields fewer partitions than
    the cluster's default parallelism, its rows are spread round-robin (a
    deterministic repartition) so the text work after the scan runs on every
    core; large inputs already scan in many partitions and are left alone."""
    df = spark.read.parquet(table_path(sf_dir, name))
    df = df.select(*cols) if cols else df
    want = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        df = df.repartition(want)
    return df


def split_name_description(text: F.Column | str) -> tuple[F.Column, F.Column]:
    """First line -> name, rest -> description (NULL when there is no rest)."""
    t = F.col(text) if isinstance(text, str) else text
    nl = F.instr(t, "\n")
    name = F.substring_index(t, "\n", 1)
    rest = F.when(nl > 0, t.substr(nl + 1, F.length(t)))
    description = F.when(F.length(rest) > 0, rest)
    return name, description


def news_documents(spark: SparkSession, sf_dir: str,
                   topic_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """The newswire corpus on the driver tables.

    ``documents`` rows become news records: ``name`` = first line,
    ``description`` = the rest, ``topics`` = the values of ``topic_cols`` for
    documents that appear in ``labels`` (the topiced / training documents) and
    NULL otherwise (the documents whose topic is predicted).

    Output: ``doc_id, name, description, topics ARRAY<STRING>, text``.
    """
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", *topic_cols)
    labelled = (read_table(spark, sf_dir, "labels", "doc_id").distinct()
                .withColumn("_labelled", F.lit(True)))
    name, description = split_name_description("text")
    out = docs.join(labelled, "doc_id", "left").select(
        "doc_id",
        name.alias("name"),
        description.alias("description"),
        F.when(F.col("_labelled"), F.array(*[F.col(c) for c in topic_cols])).alias("topics"),
        "text",
    )
    return out


def query_table(spark: SparkSession, sf_dir: str, source: str = "benchmark") -> DataFrame:
    """Query batches derived from the driver tables, whole texts.

    ``benchmark``: one query per item (``query_id`` = ``item_id``).
    ``conversations``: one query per user turn
    (``query_id`` = ``conv_id:turn`` as a string, unique for any number of turns).
    """
    if source == "benchmark":
        return read_table(spark, sf_dir, "benchmark", "item_id", "text").select(
            F.col("item_id").alias("query_id"), "text")
    if source == "conversations":
        conv = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
        return conv.where(F.col("role") == "user").select(
            F.concat_ws(":", "conv_id", "turn").alias("query_id"), "text")
    raise ValueError(f"unknown query source {source!r}")
