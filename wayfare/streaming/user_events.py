"""User events: validated into the raw table, or routed to the dead letters with a reason."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfare.plans.validation import (
    USER_EVENTS_TOPIC,
    dead_letters,
    normalize_user_event,
    validate_user_events,
)
from wayfare.sinks.writers import write_batch
from wayfare.streaming.batches import counter_row, start, with_backoff

log = logging.getLogger(__name__)


def start_user_events(
    stream: DataFrame,
    raw: str,
    dlq: str,
    checkpoint: str,
    *,
    topic: str = USER_EVENTS_TOPIC,
    fallback: str | None = None,
    metrics: str | None = None,
    arrived_at: Column | None = None,
    trigger: dict | None = None,
    write: Callable[[DataFrame, str, str], None] = write_batch,
    sleep: Callable[[float], None] = time.sleep,
) -> StreamingQuery:
    """Start the event query over a stream with the message text in ``value``.

    Per micro-batch: valid events go to ``raw``, refused ones to ``dlq``, one row of counts to
    ``metrics`` (received, processed, refused, and those whose dead letter could not be filed where
    it belongs), observed while ``write`` writes the valid ones. If the dead letters cannot be
    written even after retries, they go to ``fallback`` as JSON lines. Every write is filed under the batch's name, so a repeated batch replaces
    itself. Which letters have recovered since is read off ``raw``: see ``apply_recoveries``.
    """

    def handle(batch: DataFrame, batch_id: str) -> None:
        checked = validate_user_events(batch).persist()
        try:
            letters = dead_letters(checked, topic, arrived_at)
            counts: dict[str, int] = {}

            def write_valid() -> None:
                # Counted while the batch is written, without a pass of its own; an observation serves one action.
                seen = Observation()
                observed = checked.observe(seen, *outcome_columns())
                write(normalize_user_event(observed, topic, arrived_at), raw, batch_id)
                counts.update(seen.get)

            with_backoff(write_valid, sleep=sleep)
            failed = 0
            try:
                with_backoff(lambda: write(letters, dlq, batch_id), sleep=sleep)
            except Exception:
                if fallback is None:
                    raise
                log.exception("dead letters of batch %s go to %s", batch_id, fallback)
                letters.write.mode("overwrite").json(f"{fallback.rstrip('/')}/batch_id={batch_id}")
                failed = counts.get("dlq", 0)
            if metrics is not None:
                row = counter_row(batch.sparkSession, "user_events", counts | {"failed": failed})
                with_backoff(lambda: write(row, metrics, batch_id), sleep=sleep)
        finally:
            checked.unpersist()

    return start(stream, handle, checkpoint, trigger)


def outcome_columns() -> list[Column]:
    """What is counted of a batch of checked events."""
    return [
        F.count("*").alias("received"),
        F.count_if(F.size("violations") == 0).alias("processed"),
        F.count_if(F.size("violations") > 0).alias("dlq"),
    ]
