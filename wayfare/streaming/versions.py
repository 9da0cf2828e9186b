"""Keyed tables fed by a stream: versions are appended, the newest one wins on reading."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wayfare.operators import latest_by
from wayfare.sinks.writers import write_batch, write_full_refresh
from wayfare.streaming.batches import read_batches, start, with_backoff


def start_versions(
    stream: DataFrame,
    target: str,
    keys: Sequence[str],
    version: Sequence[str],
    checkpoint: str,
    *,
    trigger: dict | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> StreamingQuery:
    """Start a query that appends the newest version per key of each micro-batch.

    Nothing stored is rewritten per batch, so a batch costs what it holds, not what the table holds.
    """

    def handle(batch: DataFrame, batch_id: str) -> None:
        newest = latest_by(batch, keys, version)
        with_backoff(lambda: write_batch(newest, target, batch_id), sleep=sleep)

    return start(stream, handle, checkpoint, trigger)


def read_newest(
    spark: SparkSession, target: str, keys: Sequence[str], version: Sequence[str], schema: str | None = None
) -> DataFrame:
    """The keyed table: one row per key, its newest version."""
    return latest_by(read_batches(spark, target, schema).drop("batch_id"), keys, version)


def compact(
    spark: SparkSession, target: str, into: str, keys: Sequence[str], version: Sequence[str]
) -> None:
    """Write the keyed table, sorted by key, into another place."""
    write_full_refresh(read_newest(spark, target, keys, version), into, keys)
