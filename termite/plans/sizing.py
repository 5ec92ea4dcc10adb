"""Size-checked broadcast, and keys that fall into partitions of their own.

A side is stored and measured before it is broadcast: up to ``max_bytes`` it is
wrapped in ``broadcast()``; above, it is returned as stored and Catalyst / AQE plan
a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termite.session import stored

MAX_BROADCAST_BYTES = 128 << 20
MOST_PARTITIONS = 1 << 13


def table_bytes(df: DataFrame) -> int:
    """Bytes of all rows: 8 a value, and the text of strings."""
    size = F.lit(8 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
    return df.agg(F.sum(size)).first()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The side is written first: the measure and the join - broadcast or not -
    read the files instead of computing its rows again."""
    df = stored(df, "side")
    return F.broadcast(df) if table_bytes(df) <= max_bytes else df


def separate_keys(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers (``long``) that a repartition by hash deals to ``n`` different
    partitions, but for a few."""
    of = spark.range(8 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("part")).groupBy("part").agg(F.min("id").alias("id"))
    found = [r["id"] for r in of.orderBy("part").collect()]
    return found + list(range(8 * n, 9 * n - len(found)))
