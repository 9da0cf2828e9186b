"""Order changes: change envelopes into the raw change table."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfare.sinks.writers import write_batch
from wayfare.sources.ingest import ORDERS_TOPIC, raw_changes, read_envelopes
from wayfare.streaming.batches import counter_row, start, with_backoff


def start_cdc_orders(
    stream: DataFrame,
    raw: str,
    checkpoint: str,
    *,
    topic: str = ORDERS_TOPIC,
    metrics: str | None = None,
    arrived_at: Column | None = None,
    trigger: dict | None = None,
    write: Callable[[DataFrame, str, str], None] = write_batch,
    sleep: Callable[[float], None] = time.sleep,
) -> StreamingQuery:
    """Start the change query over a stream with the message text in ``value``.

    Unreadable messages are counted as failed and skipped; they never stop the query.
    """

    def handle(batch: DataFrame, batch_id: str) -> None:
        counts: dict[str, int] = {}

        def write_rows() -> None:
            # Counted while the batch is written; an observation serves one action.
            seen = Observation()
            envelopes = read_envelopes(batch).observe(seen, *envelope_columns())
            write(raw_changes(envelopes, topic, arrived_at), raw, batch_id)
            counts.update(seen.get)

        with_backoff(write_rows, sleep=sleep)
        if metrics is not None:
            row = counter_row(batch.sparkSession, "orders_cdc", counts)
            with_backoff(lambda: write(row, metrics, batch_id), sleep=sleep)

    return start(stream, handle, checkpoint, trigger)


def envelope_columns() -> list[Column]:
    """What is counted of change messages that are taken apart."""
    return [
        F.count("*").alias("received"),
        F.count_if(F.col("readable")).alias("processed"),
        F.count_if(~F.col("readable")).alias("failed"),
    ]
