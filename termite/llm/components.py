"""Connected components of an edge table, without a hub's edges in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termite.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(v, component)`` for every end of ``edges(u, v)``; the component is its
    smallest member.

    Alternates two steps until the edges stand still: every vertex hands the
    least vertex around it to its larger neighbours, then to its smaller ones and
    itself.  Each step is one partially aggregated minimum and one join, which
    adaptive execution splits where a vertex has very many edges.  The number of
    rounds grows with the logarithm of the longest chain.  Every round is
    checkpointed in the shared folder."""
    spark = edges.sparkSession
    now = cut_lineage(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while state[0]:
        both = now.union(now.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array(
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        now = cut_lineage(small.where("u <> v").distinct())
        before, state = state, _state(now)
        if state == before:
            break
    # Edges now join each vertex to its component's least one.
    roots = now.select("v").distinct()
    out = now.select(F.col("u").alias("v"), F.col("v").alias("component")).union(roots.select("v", "v"))
    return spark.createDataFrame([], out.schema) if not state[0] else out
