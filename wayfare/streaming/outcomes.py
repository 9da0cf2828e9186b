"""Outcome counts per window from a stream: filed per batch, or kept in the state store with a watermark."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wayfare.operators import latest_by
from wayfare.plans.health import outcome_counts, windows_of_slots
from wayfare.sinks.writers import write_batch
from wayfare.streaming.batches import read_batches, start, with_backoff


def start_outcome_counts(
    stream: DataFrame,
    counts: str,
    checkpoint: str,
    *,
    minutes: int = 5,
    time_column: str = "ts",
    trigger: dict | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> StreamingQuery:
    """Start a query that files each micro-batch's own counts.

    Counts of batches add up, so no state is kept and an event is counted however late it comes.
    """

    def handle(batch: DataFrame, batch_id: str) -> None:
        partial = outcome_counts(batch, minutes, time=time_column)
        with_backoff(lambda: write_batch(partial, counts, batch_id), sleep=sleep)

    return start(stream, handle, checkpoint, trigger)


def read_outcome_counts(spark: SparkSession, counts: str) -> DataFrame:
    """Totals per window over all batches."""
    return (
        read_batches(spark, counts)
        .groupBy("window_start", "window_end", "outcome")
        .agg(F.sum("events_count").alias("events_count"))
    )


SPREAD = 8
_KEPT = "slot timestamp, outcome string, part int, kind string, events_count long, seen long"


def _hour_state(window_seconds: int):
    """Counts of the slots of one hour, outcome and part: what came in time is kept as state, what came too late is handed on."""

    def update(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        _, outcome, part = key
        came: dict = {}
        for chunk in rows:
            for slot, n in chunk["slot"].value_counts(dropna=False).items():
                came[slot] = came.get(slot, 0) + int(n)
        kept, seen = state.get if state.exists else ("{}", 0)
        counts, seen = json.loads(kept), seen + 1
        passed = state.getCurrentWatermarkMs()
        found = []
        for slot, n in came.items():
            # The last window that a slot is part of begins with it.
            if not pd.isna(slot) and int(slot.timestamp() + window_seconds) * 1000 <= passed:
                found.append((slot, outcome, part, "late", n, seen))
                continue
            name = "" if pd.isna(slot) else str(int(slot.timestamp()))
            counts[name] = counts.get(name, 0) + n
            found.append((None if pd.isna(slot) else slot, outcome, part, "counted", counts[name], seen))
        # Slots that are closed change no more; an hour of them leaves a few bytes.
        open_slots = {name: n for name, n in counts.items() if not name or (int(name) + window_seconds) * 1000 > passed}
        state.update((json.dumps(open_slots), seen))
        frame = pd.DataFrame(found, columns=["slot", "outcome", "part", "kind", "events_count", "seen"])
        yield frame.astype({"slot": "datetime64[ns]"})

    return update


def start_outcome_windows(
    stream: DataFrame,
    counts: str,
    late: str,
    checkpoint: str,
    *,
    minutes: int = 5,
    slide: int = 1,
    delay: str = "10 minutes",
    time_column: str = "ts",
    trigger: dict | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> StreamingQuery:
    """Start the query that keeps counts per slot (of ``slide`` minutes) in the state store.

    Each batch writes the new counts of the slots that it touched (update mode) to ``counts``. An event is late if the watermark, the
    greatest time so far less ``delay``, has passed the end of the last window that it is in: it changes no count and is
    counted in the side table ``late`` of its batch. The state is kept by hour, outcome and part of the events, so a minute or an
    outcome with most of the events is not one task's; slots leave it when they are closed. Events
    without a time or an outcome are counted like others, under null, and are never late.
    """
    if minutes % slide:
        raise ValueError("the window must be a multiple of the slide")
    # A watermark stands on times with a zone; those without one are UTC.
    timed = stream.withColumn(time_column, F.col(time_column).cast("timestamp")).withWatermark(time_column, delay)
    slot = F.window(time_column, f"{slide} minutes")["start"].cast("timestamp").alias("slot")
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in stream.columns]), F.lit(SPREAD)).cast("int").alias("part")
    keyed = timed.select(slot, "outcome", part, F.col(time_column).alias("_time"))
    keyed = keyed.withColumn("hour", F.date_trunc("hour", F.col("slot")))
    # Without a time-out: events behind the watermark must come through, to be counted as late.
    updates = keyed.groupBy("hour", "outcome", "part").applyInPandasWithState(
        _hour_state(60 * minutes), _KEPT, "counts string, seen long", "update", GroupStateTimeout.NoTimeout
    )

    def handle(batch: DataFrame, batch_id: str) -> None:
        rows = batch.persist()
        try:
            with_backoff(lambda: write_batch(rows.where("kind = 'counted'").drop("kind"), counts, batch_id), sleep=sleep)
            with_backoff(lambda: write_batch(rows.where("kind = 'late'").select("slot", "outcome", "events_count"), late, batch_id), sleep=sleep)
        finally:
            rows.unpersist()

    return start(updates, handle, checkpoint, trigger, mode="update")


def read_outcome_windows(spark: SparkSession, counts: str, minutes: int = 5, slide: int = 1, late: str | None = None) -> DataFrame:
    """Counts per window: those in time, or with ``late`` all events, as a batch query over all of them would count."""
    newest = latest_by(read_batches(spark, counts).drop("batch_id"), ["slot", "outcome", "part"], ["seen"])
    slots = newest.select("slot", "outcome", "events_count")
    if late is not None:
        slots = slots.unionByName(read_batches(spark, late).select(*slots.columns))
    return windows_of_slots(slots.groupBy(F.col("slot").alias("window_start"), "outcome").agg(F.sum("events_count").alias("events_count")), minutes, slide)


def read_late(spark: SparkSession, late: str) -> DataFrame:
    """Late events per slot and outcome over all batches."""
    return read_batches(spark, late).groupBy("slot", "outcome").agg(F.sum("events_count").alias("events_count"))
