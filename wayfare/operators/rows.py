"""Row-shape operators: union, dealing out, long form, top k."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def dealt_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows, dealt out by a hash of some columns in parts of the adaptive planner's advised size.

    What a task folds per key before the next shuffle is then bounded by that size, not by the rows that a split of the input
    holds, which may be very many if they compress well. A hot key's rows are split over several tasks, since nothing
    that follows may count on finding a key in one part.
    """
    part = F.pmod(F.xxhash64(*keys), F.lit(1 << 15)).cast("smallint")
    return df.withColumn("_part", part).hint("rebalance", "_part").drop("_part")


def to_long(df: DataFrame, measures: Sequence[tuple[str, Column]]) -> DataFrame:
    """Several aggregates of one table as ``(metric, value)`` rows, from one pass."""
    wide = df.agg(*[value.cast("double").alias(name) for name, value in measures])
    rows = F.array(
        *[F.struct(F.lit(name).alias("metric"), F.col(name).alias("value")) for name, _ in measures]
    )
    return wide.select(F.inline(rows))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows. ``order`` must be total for a repeatable answer.

    Each task keeps its own k rows, only those meet in the last step.
    """
    return df.orderBy(*order).limit(k)
