"""What happened to dead letters, as an append-only table of marks; their state is read off it.

The letters themselves are never rewritten, so a stream may append to them meanwhile. A round of
replay first stores what it picked under its id, then sends and marks what it stored.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.times import instant
from wayfare.operators import left_lookup, top_k
from wayfare.plans.replay import BATCH, MAX_REPLAYS, encode_for_replay
from wayfare.plans.validation import USER_EVENTS_TOPIC, is_uuid

MARKS = "letter_key string, kind string, at timestamp"
PICKED, SENT, RECOVERED = "picked", "sent", "recovered"


def letter_key() -> Column:
    """Name of a letter by its content: letters without an id, or with a shared one, have names too."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("event_id", "raw_event", "failed_at")]
    return F.md5(F.concat_ws("\n", *parts))


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """All marks with their ``mark_id``; none if nothing was marked yet."""
    try:
        return spark.read.schema(f"{MARKS}, mark_id string").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{MARKS}, mark_id string")


def write_marks(keys: DataFrame, path: str, mark_id: str, kind: str, at: datetime | str | Column | None) -> None:
    """Mark the letters of ``letter_key``. Doing it again under the same id changes nothing."""
    rows = keys.select("letter_key", F.lit(kind).alias("kind"), instant(at).alias("at"))
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/mark_id={mark_id}-{kind}")


def with_state(letters: DataFrame, marks: DataFrame) -> DataFrame:
    """The letters with ``letter_key`` and their flags after all marks."""
    kind, at = F.col("kind"), F.col("at")
    state = marks.groupBy("letter_key").agg(
        F.count_if(kind == PICKED).cast("int").alias("_tries"),
        F.max(F.when(kind == SENT, at)).alias("_sent"),
        F.min(F.when(kind == RECOVERED, at)).alias("_recovered"),
    )
    changed = {
        "recovered": F.col("recovered") | F.col("_recovered").isNotNull(),
        "recovered_at": F.coalesce("_recovered", F.col("recovered_at").cast("timestamp")),
        "replay_count": F.col("replay_count") + F.coalesce("_tries", F.lit(0)),
        "replayed": F.col("replayed") | F.col("_sent").isNotNull(),
        "replayed_at": F.coalesce("_sent", F.col("replayed_at").cast("timestamp")),
    }
    joined = left_lookup(letters.withColumn("letter_key", letter_key()), state, "letter_key")
    return joined.select("letter_key", *[changed.get(name, F.col(name)).alias(name) for name in letters.columns])


def replay_round(
    letters: DataFrame,
    marks: str,
    outbox: str,
    sink: Callable[[DataFrame], DataFrame | None] | str,
    replay_id: str,
    as_of: datetime | str | Column | None = None,
    batch: int = BATCH,
    max_replays: int = MAX_REPLAYS,
    topic: str = USER_EVENTS_TOPIC,
) -> None:
    """Send the oldest waiting letters of a topic again.

    Every picked letter counts a try, also if it cannot be encoded, so none blocks those behind
    it. ``sink`` is a folder, or a function that takes ``letter_key`` and ``value`` and may return the
    ``letter_key`` of what it delivered; without an answer, all was. Only then are letters marked as sent.
    """
    spark = letters.sparkSession
    state = with_state(letters, read_marks(spark, marks))
    waiting = state.where(~F.col("recovered") & (F.col("source_topic") == topic) & (F.col("replay_count") < max_replays))
    order = [F.col("failed_at"), F.col("event_id"), F.col("raw_event")]
    stored = f"{outbox.rstrip('/')}/replay_id={replay_id}"
    top_k(waiting.select("letter_key", "event_id", "raw_event", "failed_at"), order, batch).write.mode("overwrite").parquet(stored)
    picked = spark.read.parquet(stored)
    write_marks(picked, marks, replay_id, PICKED, as_of)
    messages = encode_for_replay(picked.withColumn("event_id", F.col("letter_key"))).withColumnRenamed("event_id", "letter_key")
    delivered = None
    if callable(sink):
        delivered = sink(messages)
    else:
        messages.select("value").write.mode("append").text(sink)
    write_marks(messages if delivered is None else delivered, marks, replay_id, SENT, as_of)


def mark_recoveries(letters: DataFrame, marks: str, succeeded: DataFrame, mark_id: str, at: str = "ingested_at") -> None:
    """Mark the letters whose event got through at or after the time they failed.

    Events of other ids are left out before anything is grouped; ids that are no UUID mark nothing.
    """
    named = letters.where(is_uuid(F.col("event_id"))).select(letter_key().alias("letter_key"), "event_id", "failed_at")
    since = letters.agg(F.min("failed_at")).scalar()
    later = succeeded.where(F.col(at) >= since).join(named.select("event_id").distinct(), "event_id", "left_semi")
    last = later.groupBy("event_id").agg(F.max(at).alias("_at"))
    hit = named.join(last, "event_id").where(F.col("_at") >= F.col("failed_at"))
    write_marks(hit.select("letter_key", "_at"), marks, mark_id, RECOVERED, F.col("_at"))
