"""Records as they arrive turned into raw-table rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.jsontext import plain_number, to_json_strings
from wayfare.functions.lenient import read_whole, settle
from wayfare.functions.times import booking_ts, instant
from wayfare.plans.validation import validate_ads

ORDERS_TOPIC = "orders.public.orders"

# A booking record as the booking interface delivers it.
BOOKING_RECORD = (
    "booking_id long, user_id long, route string, transport_type string, status string, "
    "price double, currency string, created_at string"
)


def _created(text: Column) -> Column:
    return booking_ts(text).try_cast("timestamp")


def ingest_bookings(records: DataFrame, run_id: str | Column, loaded_at: datetime | str | Column) -> DataFrame:
    """Booking records as raw rows of one run: creation text cleaned, lineage columns added.

    Records whose creation text is no time are left out: see ``unreadable_bookings``.
    """
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    timed = settle(records, _created=_created(F.col("created_at")))
    return timed.where(F.col("created_at").isNull() | F.col("_created").isNotNull()).select(
        "booking_id",
        "user_id",
        "route",
        "transport_type",
        "status",
        "price",
        "currency",
        F.col("_created").alias("created_at"),
        instant(loaded_at).alias("loaded_at"),
        run.alias("run_id"),
    )


def unreadable_bookings(records: DataFrame, failed_at: datetime | str | Column) -> DataFrame:
    """Dead letters of the records whose creation text is no time; the text is kept."""
    fields = ("booking_id", "user_id", "route", "transport_type", "status", "price", "currency", "created_at")
    return records.where(F.col("created_at").isNotNull() & _created(F.col("created_at")).isNull()).select(
        "booking_id",
        to_json_strings(**{name: plain_number(F.col(name)) if name == "price" else F.col(name) for name in fields}).alias("raw_record"),
        F.lit("created_at is not a time").alias("error_reason"),
        instant(failed_at).alias("failed_at"),
    )


def ingest_ads(messages: DataFrame, loaded_at: datetime | str | Column, mode: str = "fail") -> DataFrame:
    """Ad records (JSON text in ``value``) as raw rows, validated.

    ``mode='fail'`` raises if any record of the batch is invalid; ``mode='split'`` keeps the
    valid ones.
    """
    return validate_ads(messages, mode).select(
        "campaign_id",
        "campaign_name",
        "clicks",
        "impressions",
        "spend",
        "platform",
        instant(loaded_at).alias("loaded_at"),
    )


def archive_payload(responses: DataFrame, platform: str, fetched_at: datetime | str | Column) -> DataFrame:
    """Answers of the advertising interface (JSON text in ``value``), one archived row per call.

    The text is kept as it came, however many records it holds; nothing is grouped or cut.
    """
    return responses.select(
        F.lit(platform).alias("source"),
        F.lit(platform.replace("_", "-")).alias("endpoint"),
        F.col("value").alias("payload"),
        instant(fetched_at).alias("fetched_at"),
    )


def unpack_payload(archive: DataFrame, schema: str) -> DataFrame:
    """The records of archived calls, one row each."""
    record = F.explode(F.from_json("payload", f"array<struct<{schema}>>")).alias("_record")
    return archive.select("source", "endpoint", "fetched_at", record).select(
        "source", "endpoint", "fetched_at", "_record.*"
    )


def read_envelopes(changes: DataFrame) -> DataFrame:
    """Change messages (JSON text in ``value``) taken apart once; ``readable`` marks JSON objects.

    The images stay JSON text. A missing image is the text ``null``.
    """
    fields = "op string, before string, after string, ts_ms string"
    image = {name: F.coalesce(F.col(f"_e.{name}"), F.lit("null")) for name in ("before", "after")}
    opened = read_whole(changes, "_e", F.col("value"), fields)
    return settle(opened, readable=F.col("_e").isNotNull()).select(
        *changes.columns,
        "readable",
        F.col("_e.op").alias("op"),
        image["before"].alias("before_record"),
        image["after"].alias("after_record"),
        F.col("_e.ts_ms").try_cast("bigint").alias("source_ts_ms"),
    )


def raw_changes(
    envelopes: DataFrame, topic: str = ORDERS_TOPIC, ingested_at: datetime | str | Column | None = None
) -> DataFrame:
    """Change messages that ``read_envelopes`` has taken apart, as raw rows; unreadable ones are left out."""
    order_id = F.coalesce(
        F.get_json_object("after_record", "$.order_id"), F.get_json_object("before_record", "$.order_id")
    )
    return envelopes.where("readable").select(
        order_id.try_cast("bigint").alias("order_id"),
        "op",
        "before_record",
        "after_record",
        F.lit(topic).alias("source_topic"),
        "source_ts_ms",
        instant(ingested_at).alias("ingested_at"),
    )


def cdc_to_raw(
    changes: DataFrame, topic: str = ORDERS_TOPIC, ingested_at: datetime | str | Column | None = None
) -> DataFrame:
    """Order change messages as raw rows; unreadable messages are left out."""
    return raw_changes(read_envelopes(changes), topic, ingested_at)
