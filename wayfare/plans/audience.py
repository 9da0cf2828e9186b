"""Exact distinct users over any range of days, from bitmaps that are stored once per day.

A day has a bitmap per event type and block of 32,768 user ids. Bitmaps of days are united, never added, so a user counts once
however many days they come back on, and no event is read again. Ids that lie close together share blocks; a
block of few ids is mostly zeros, which the Parquet encoding folds away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event_type string, bucket long, users binary, day date"


def daily_users(events: DataFrame, day: Column | None = None) -> DataFrame:
    """(event_type, bucket, users, day): the users of each type and day; events without a user or a time say nothing."""
    day = F.to_date("event_time") if day is None else day
    known = events.select("event_type", "user_id", day.alias("day")).where("user_id is not null and day is not null")
    block, bit = F.bitmap_bucket_number("user_id"), F.bitmap_bit_position("user_id")
    return known.groupBy("event_type", block.alias("bucket"), "day").agg(F.bitmap_construct_agg(bit).alias("users")).select("event_type", "bucket", "users", "day")


def write_days(users: DataFrame, path: str) -> None:
    """File the bitmaps of some days, a folder per day; days that are there already are replaced, all others stay."""
    users.repartition("day", "event_type").sortWithinPartitions("event_type", "bucket").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("day").parquet(path)


def read_days(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The stored bitmaps of a range of days (ends included); the folders of other days are not read."""
    found = spark.read.schema(SCHEMA).parquet(path).where("users is not null")
    for bound, holds in ((first, lambda c, d: c >= d), (last, lambda c, d: c <= d)):
        if bound is not None:
            found = found.where(holds(F.col("day"), F.to_date(F.lit(bound))))
    return found


def users_count(days: DataFrame, by: Sequence[str] = ("event_type",)) -> DataFrame:
    """Distinct users over all the given days, for each group of ``by`` (over all types if ``by`` is empty)."""
    blocks = days.groupBy(*by, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return blocks.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("users")), F.lit(0)).alias("users_count"))


def rolling_users(days: DataFrame, length: int) -> DataFrame:
    """(event_type, last_day, users_count): distinct users of the ``length`` days that end on each day with events.

    Each day's bitmaps go into the windows that they are part of; events are not copied.
    """
    ends = days.select(F.col("day").alias("last_day")).distinct()
    spread = days.select("event_type", "bucket", "users", F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias("_later"), "day")
    windows = spread.withColumn("last_day", F.date_add("day", F.col("_later"))).join(ends, "last_day", "left_semi")
    return users_count(windows, ("event_type", "last_day"))


def touched_days(changes: DataFrame) -> DataFrame:
    """The days that changed staging events (``before``, ``after``) lie or lay in: those to be filed again."""
    times = F.array(F.col("before.event_time"), F.col("after.event_time"))
    return changes.select(F.explode(times).alias("event_time")).select(F.to_date("event_time").alias("day")).where("day is not null").distinct()


def refresh_days(events: DataFrame, changes: DataFrame, path: str) -> None:
    """File again the days that changes touch, from the staging events of these days.

    A day whose last event went is filed without users. Events are narrowed to the days by a join that the planner broadcasts if the days are few.
    """
    days = touched_days(changes)
    again = daily_users(events.join(days.withColumnRenamed("day", "_day"), F.to_date("event_time") == F.col("_day"), "left_semi"))
    empty = days.select(F.lit(None).cast("string").alias("event_type"), F.lit(0).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("users"), "day")
    write_days(again.unionByName(empty.join(again.select("day").distinct(), "day", "left_anti").select(*again.columns)), path)
