"""Columns that an operator only carries along."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def under_other_names(docs: DataFrame, read: Iterable[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(docs)`` with the columns that it does not ``read`` renamed
    meanwhile, so that none meets a column of its own.  What ``work`` adds must
    not be named like a column of ``docs``."""
    read = set(read)
    names = [c if c in read else f"__in{i}" for i, c in enumerate(docs.columns)]
    own = dict(zip(names, docs.columns))
    out = work(docs.toDF(*names))
    return out.select(*[F.col(f"`{c}`").alias(own.get(c, c)) for c in out.columns])
