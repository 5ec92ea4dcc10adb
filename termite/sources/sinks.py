"""Sinks and sources (S6, S7, S9, S10, S11): tables written to the shared
checkpoint folder and read back with an explicit schema.

Every write goes to a fresh path below ``spark.checkpoint.dir`` (never a
machine-local folder), so a later stage reads files that survive the loss of
the executors that wrote them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termite.session import scratch_path
from termite.sources.corpus import list_literal, parse_list_literal


def parquet_round_trip(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write Parquet, read it back (lineage cut at the files)."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def json_round_trip(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """JSON lines out and in, read with the writer's schema (no inference)."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").json(path)
    return spark.read.schema(df.schema).json(path)


def csv_round_trip(spark: SparkSession, df: DataFrame, name: str, list_cols: tuple[str, ...] = ()) -> DataFrame:
    """CSV out and in; array columns travel as list literals and are parsed
    back (S8)."""
    path = scratch_path(spark, name)
    out = df
    for c in list_cols:
        out = out.withColumn(c, list_literal(F.col(c)))
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    back = spark.read.schema(out.schema).option("header", True).option("escape", '"').option(
        "multiLine", True).csv(path)
    for c in list_cols:
        back = back.withColumn(c, parse_list_literal(F.col(c)))
    return back
