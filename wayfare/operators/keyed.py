"""Operators over a business key: newest version, duplicates, flag updates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.operators.rows import dealt_by

UNORDERED = (T.MapType, T.VariantType)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key: greatest ``order`` columns first, NULLs last.

    Ties are broken by the remaining columns, so the same rows give the same answer however
    they are spread. The newest row is the greatest ``(order, remaining)`` struct of its key: an
    aggregate, which every task folds to one row per key before the shuffle, also where the rows
    come out of a join on the same key. A key holding a third of the table sends one row per task.
    """
    others = [field for field in df.schema if field.name not in keys]
    ties = [f.name for f in others if f.name not in order and not isinstance(f.dataType, UNORDERED)]
    rank = F.struct(*order, *ties)
    if len(order) + len(ties) == len(others):
        newest = F.max(rank)
    else:
        newest = F.max_by(F.struct(*[field.name for field in others]), rank)
    found = df.groupBy(*keys).agg(newest.alias("_newest"))
    return found.select(*[F.col(name) if name in keys else F.col(f"_newest.{name}") for name in df.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with ``copies``. Counts are combined before the shuffle, in parts of bounded size."""
    return dealt_by(df, keys).groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def left_lookup(df: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """All rows of ``df`` with the columns of ``values``, which is unique on ``key``.

    ``df`` may be skewed on the key. Rows without a key are spread by their content, not sent to
    one task as NULLs. Nothing is hinted: the adaptive planner broadcasts ``values`` if its
    measured size allows it, and otherwise splits the tasks of a hot key. It can do the latter
    because joining on the hash as well gives ``values`` a shuffle right below the join.
    """
    simple = [f.name for f in df.schema if not isinstance(f.dataType, UNORDERED)]
    content = F.when(F.col(key).isNull(), F.xxhash64(*simple)).otherwise(F.xxhash64(key))
    left = df.withColumn("_spread", content)
    right = values.where(F.col(key).isNotNull()).withColumn("_spread", F.xxhash64(key))
    return left.join(right, [key, "_spread"], "left").drop("_spread")


def update_flags(
    df: DataFrame, ids: DataFrame, key: str, updates: Mapping[str, Column]
) -> DataFrame:
    """Set columns on the rows whose key is among ``ids``; all other rows stay as they are."""
    marks = ids.select(key).distinct().withColumn("_hit", F.col(key).isNotNull())
    changed = {
        name: F.when(F.col("_hit"), value).otherwise(F.col(name)).cast(df.schema[name].dataType).alias(name)
        for name, value in updates.items()
    }
    joined = left_lookup(df, marks, key)
    return joined.select(*[changed.get(name, F.col(name)) for name in df.columns])
