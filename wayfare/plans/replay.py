"""The life of a dead letter: picked for replay, sent again, marked, recovered."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import lenient
from wayfare.functions.times import instant
from wayfare.operators import left_lookup, top_k, update_flags
from wayfare.plans.validation import EVENT_TYPES, USER_EVENTS_TOPIC, is_uuid

BATCH = 20
MAX_REPLAYS = 3


def replay_candidates(
    dlq: DataFrame, topic: str = USER_EVENTS_TOPIC, batch: int = BATCH, max_replays: int = MAX_REPLAYS
) -> DataFrame:
    """The oldest dead letters of a topic that are neither recovered nor tried too often."""
    waiting = dlq.where(
        ~F.col("recovered") & (F.col("source_topic") == topic) & (F.col("replay_count") < max_replays)
    )
    order = [F.col("failed_at"), F.col("event_id"), F.col("raw_event")]
    return top_k(waiting.select("event_id", "raw_event", "source_topic", "failed_at"), order, batch)


def encode_for_replay(picked: DataFrame) -> DataFrame:
    """The picked events as topic messages in ``value``; those the topic cannot carry are left out.

    ``properties`` objects become JSON text. A message needs every required field in its type.
    """
    names = ("event_id", "user_id", "event_type", "event_time", "properties", "device_type")
    renamed = picked.select(F.col("event_id").alias("dead_id"), "raw_event")
    parsed = lenient.parse_whole(renamed, "_v", F.col("raw_event"))
    fields = lenient.take(parsed, "_v", names)
    # From the message text, which keeps the keys in their order.
    written = F.get_json_object("raw_event", "$.properties")
    message = lenient.settle(
        fields,
        event_id=lenient.text_value("event_id"),
        user_id=F.when(F.col("_user_id_kind") == "BIGINT", F.try_variant_get("_user_id", "$", "bigint")),
        event_type=lenient.choice_value("event_type", EVENT_TYPES),
        event_time=lenient.text_value("event_time"),
        properties=F.when(F.col("_properties_kind") == "OBJECT", written).otherwise(
            lenient.text_value("properties")
        ),
        device_type=lenient.text_value("device_type"),
    )
    required = ("event_id", "user_id", "event_type", "event_time", "properties")
    return message.dropna(subset=list(required)).select(
        F.col("dead_id").alias("event_id"), F.to_json(F.struct(*required, "device_type")).alias("value")
    )


def mark_replayed(dlq: DataFrame, delivered: DataFrame, at: datetime | str | Column | None = None) -> DataFrame:
    """Dead letters with the delivered ones counted as replayed. Ids that are no UUID are skipped."""
    return update_flags(
        dlq,
        delivered.where(is_uuid(F.col("event_id"))),
        "event_id",
        {
            "replayed": F.lit(True),
            "replayed_at": instant(at),
            "replay_count": F.col("replay_count") + 1,
        },
    )


def mark_recovered(dlq: DataFrame, succeeded: DataFrame, at: datetime | str | Column | None = None) -> DataFrame:
    """Dead letters whose event later got through, marked recovered."""
    return update_flags(
        dlq,
        succeeded.where(is_uuid(F.col("event_id"))),
        "event_id",
        {"recovered": F.lit(True), "recovered_at": instant(at)},
    )


def apply_recoveries(dlq: DataFrame, succeeded: DataFrame, at: str = "ingested_at") -> DataFrame:
    """Dead letters marked recovered by the events that got through: the raw event table.

    An event recovers the letters that had failed by the time ``at`` it came in; the last one
    counts. Reading the marks off the raw table spares the stream a rewrite per batch. Events
    whose id is no UUID mark nothing.
    """
    # Only events of the letters are grouped, and only those since the first of them failed are read.
    ids = dlq.where(is_uuid(F.col("event_id"))).select("event_id").distinct()
    since = dlq.agg(F.min("failed_at").alias("since")).scalar()
    later = succeeded.where(F.col(at) >= since).join(ids, "event_id", "left_semi")
    last = later.groupBy("event_id").agg(F.max(at).alias("_at"))
    hit = F.col("_at") >= F.col("failed_at")
    changed = {
        "recovered": F.col("recovered") | F.coalesce(hit, F.lit(False)),
        "recovered_at": F.when(hit, F.col("_at")).otherwise(F.col("recovered_at")),
    }
    return left_lookup(dlq, last, "event_id").select(
        *[changed[name].alias(name) if name in changed else F.col(name) for name in dlq.columns]
    )


def replay_dlq(
    dlq: DataFrame,
    sink: Callable[[DataFrame], None] | str,
    as_of: datetime | str | Column | None = None,
    batch: int = BATCH,
    max_replays: int = MAX_REPLAYS,
    topic: str = USER_EVENTS_TOPIC,
) -> DataFrame:
    """Send the oldest waiting dead letters again and return the dead-letter table after that.

    ``sink`` is a folder that the event stream reads, or a function that delivers the messages
    (column ``value``), for example to a topic. Marks are set only after it returned.
    """
    messages = encode_for_replay(replay_candidates(dlq, topic, batch, max_replays))
    if callable(sink):
        sink(messages.select("value"))
    else:
        messages.select("value").write.mode("append").text(sink)
    return mark_replayed(dlq, messages.select("event_id"), as_of)
