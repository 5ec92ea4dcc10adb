"""Mixing sources to target weights along a time-varying curriculum
(DataFrame functions only).

Each source has a share of all words and a linear weight schedule over training
time 0..1: ``w(t) = target * (1 + slope * (1 - 2 t))``.  Its integral is the
cumulative demand for words of the source; inverting that at a document's place
in the source's stream gives the document's training position.  Sources are
streams of their documents in a fixed random order, read again from the start
until the target is met; the last pass ends inside a document.

A source's running total is taken over slices of its documents (by the leading
digits of the ordering key), then inside each slice, so a source with a third of
all rows spreads over many tasks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termite.llm.columns import under_other_names
from termite.operators.index import dense_ids
from termite.session import cut_lineage

WEIGHTS = (5, 2, 1)
SLOPES = (0.5, 0.0, -0.5)
MOST_TIMES = 3
SLICE_ROWS = 50_000
SPACE = r"[\x20\x09-\x0D]+"
NEW = ("size", "source_size", "target", "taken", "position")
PLACE = ("__times", "__rest", "__start", "__slope")
READ = ("doc_id", "text", "source")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")).cast("long")


def _by_rank(rank: Column, values: tuple) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (rank % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES,
            most_times: int = MOST_TIMES) -> DataFrame:
    """``(source, source_size, target, __slope)`` from ``(source, source_size)``.

    Sources in code-point order, null last, weigh ``weights`` in turn.  The level
    ``total / sum of weights`` rises until the sources that stop at ``most_times``
    their size have left their excess to the others; each round is one aggregate."""
    named = dense_ids(sizes.where("source is not null"), "source", "rank")
    nameless = sizes.where("source is null").withColumn("rank", F.lit(named.count()).cast("long"))
    ranked = cut_lineage(named.unionByName(nameless).withColumn("weight", _by_rank(F.col("rank"), weights)))
    total, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level = total / weight if weight else 0.0
    while True:
        full = F.lit(most_times) * F.col("source_size") <= F.lit(float(level)) * F.col("weight")
        held, rest = ranked.agg(F.sum(F.when(full, most_times * F.col("source_size")).otherwise(0)),
                                F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        higher = (total - held) / rest if rest else level
        if higher == level or not rest:
            break
        level = higher
    return ranked.select(
        "source", "source_size",
        F.least((most_times * F.col("source_size")).cast("double"), F.lit(float(level)) * F.col("weight")).alias("target"),
        _by_rank(F.col("rank"), slopes).alias("__slope"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, most_times: int = MOST_TIMES) -> DataFrame:
    """``docs``, one row each, with ``size`` (words), ``source_size``, ``target``
    (of its source), ``taken`` (words the mix takes, repeats counted), ``position``
    (training time of its first reading, null where nothing is taken), and the
    numbers ``__times`` and ``__rest`` of whole readings and of words of a last,
    partial one, ``__start`` and ``__slope`` (its place in the source's stream and
    the schedule's slope).  Input columns of these names are replaced.

    A null or empty text has size 0 and nothing is taken; a null source is a
    source; a null id comes first in its source's order.  Equal rows share what
    their places in the order give, whichever comes first.  No document is taken
    more than ``most_times`` times.  An empty table gives an empty result."""
    return under_other_names(docs.drop(*NEW, *PLACE), READ, lambda d: _mix(d, weights, slopes, most_times))


def _mix(docs: DataFrame, weights: tuple, slopes: tuple, most_times: int) -> DataFrame:
    n = docs.count()
    digits = max(1, math.ceil(math.log(max(1, n / SLICE_ROWS), 16)))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = docs.withColumn("size", word_count(F.col("text"))).withColumn("__key", key).withColumn(
        "__slice", F.substring("__key", 1, digits))
    # Sums by source and slice: small, written once, used for targets and for running totals.
    slices = cut_lineage(sized.groupBy("source", "__slice").agg(F.sum("size").alias("__sum")))
    plan = targets(slices.groupBy("source").agg(F.sum("__sum").alias("source_size")), weights, slopes, most_times)
    before = Window.partitionBy("source").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
    plan = cut_lineage(slices.join(plan.withColumnRenamed("source", "__source"),
                                   F.col("source").eqNullSafe(F.col("__source"))).select(
        "__source", F.col("__slice").alias("__of"), "__before", "source_size", "target", "__slope"))
    inside = Window.partitionBy("source", "__slice").orderBy(
        "__key", F.col("doc_id"), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("__in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        plan, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__slice") == F.col("__of")))
    start = F.col("__before") + F.col("__in")
    words = F.floor(F.col("target") + 0.5)
    times = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(F.lit(0))
    rest = F.greatest(F.lit(0), F.least(F.col("size"), words - F.col("__times") * F.col("source_size") - start))
    out = placed.withColumn("__times", times.cast("long")).withColumn("__rest", rest.cast("long")).withColumn(
        "taken", F.col("__times") * F.col("size") + F.col("__rest"))
    return out.withColumn("__start", start).withColumn(
        "position", F.when(F.col("taken") > 0, _position(F.col("__start")))).drop(
        "__key", "__slice", "__in", "__source", "__of", "__before")


def _position(offset: Column) -> Column:
    """Training time at which the source's cumulative demand reaches ``offset``:
    the root in 0..1 of ``(1 + slope) t - slope t^2 = offset / target``."""
    q = F.least(F.lit(1.0), offset / F.col("target"))
    b = 1 + F.col("__slope")
    return 2 * q / (b + F.sqrt(F.greatest(F.lit(0.0), b * b - 4 * F.col("__slope") * q)))


def readings(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus in training order: a row for each reading of a document,
    sorted by ``position`` (range partitions), with ``reading`` from 0.  The text
    of a partial last reading is cut after its words."""
    return under_other_names(docs.drop(*NEW, "reading"), READ, lambda d: _readings(mix(d, **how)))


def _readings(mixed: DataFrame) -> DataFrame:
    count = F.col("__times") + F.when(F.col("__rest") > 0, 1).otherwise(0)
    rows = mixed.where("taken > 0").withColumn(
        "reading", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    partial = (F.col("reading") == F.col("__times")) & (F.col("__rest") < F.col("size"))
    cut = F.array_join(F.slice(F.array_remove(F.split("text", SPACE), ""), F.lit(1), F.col("__rest").cast("int")), " ")
    rows = rows.withColumn("position", _position(F.col("__start") + F.col("reading") * F.col("source_size"))).withColumn(
        "text", F.when(partial, cut).otherwise(F.col("text")))
    return rows.drop(*PLACE).orderBy("position", "source", "doc_id")
