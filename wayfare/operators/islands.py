"""Runs of consecutive points in time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(points: DataFrame, keys: Sequence[str], at: str, step: int, measures: Mapping[str, Column]) -> DataFrame:
    """The runs of points of each key that follow each other by ``step`` seconds: keys, first, last, steps, measures.

    Points at the same time are one step. ``measures`` are greatest values, named (such as ``F.max("value")``). Runs are found day by day,
    so that a key is not ordered in one task over all its time, and those that go on over midnight are joined: one row per run
    and day is left by then. Points without a time belong to no run; keys may be null.
    """
    kind = points.schema[at].dataType.simpleString()
    number = F.unix_seconds(F.col(at).cast("timestamp"))
    daily = points.where(F.col(at).isNotNull()).groupBy(*keys, F.col(at).alias("_at")).agg(
        *[value.alias(name) for name, value in measures.items()], F.first(F.floor(number / step)).alias("_n")
    )
    by_day = Window.partitionBy(*keys, F.to_date("_at")).orderBy("_n")
    runs = daily.withColumn("_run", F.col("_n") - F.row_number().over(by_day)).groupBy(*keys, F.to_date("_at").alias("_day"), "_run")
    greatest = {name: F.max(name).alias(name) for name in measures}
    of_day = runs.agg(F.min("_at").alias("first"), F.max("_at").alias("last"), F.min("_n").alias("_from"), F.max("_n").alias("_to"), *greatest.values())
    in_order = Window.partitionBy(*keys).orderBy("_from")
    begins = F.coalesce(F.col("_from") != F.lag("_to").over(in_order) + 1, F.lit(True))
    joined = of_day.withColumn("_begins", begins.cast("int")).withColumn("_group", F.sum("_begins").over(in_order))
    return (
        joined.groupBy(*keys, "_group")
        .agg(F.min("first").cast(kind).alias("first"), F.max("last").cast(kind).alias("last"), (F.max("_to") - F.min("_from") + 1).alias("steps"), *greatest.values())
        .select(*keys, "first", "last", "steps", *measures)
    )
