"""Staging: the current state per business key, from append-only raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.jsontext import as_float, as_text, as_time, as_uint, json_uint
from wayfare.operators import after_high_water, latest_by, union_all, upsert_latest
from wayfare.plans.validation import booking_is_valid

BOOKING_COLUMNS = (
    "booking_id", "user_id", "route", "transport_type", "status", "price", "currency",
    "created_at", "loaded_at", "run_id",
)
BOOKING_VERSION = ("loaded_at", "run_id", "price", "user_id", "route", "status")
AD_COLUMNS = ("platform", "campaign_id", "campaign_name", "clicks", "impressions", "spend", "loaded_at")
EVENT_COLUMNS = (
    "event_id", "user_id", "event_type", "event_time", "properties", "source_topic", "ingested_at",
)
# Images are parsed as texts in one go and typed afterwards.
ORDER_IMAGE = (
    "user_id string, route string, transport_type string, status string, price string, "
    "currency string, campaign_id string, created_at string, updated_at string"
)
NO_IMAGE = ("", "null")


def stg_bookings_latest(raw: DataFrame) -> DataFrame:
    """Newest version of each booking."""
    return latest_by(raw.select(*BOOKING_COLUMNS), ["booking_id"], BOOKING_VERSION)


def valid_bookings(raw: DataFrame) -> DataFrame:
    """Bookings with a key and no negative price."""
    return raw.where(booking_is_valid())


def new_bookings(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Valid bookings loaded after everything that is already staged."""
    return after_high_water(valid_bookings(raw.select(*BOOKING_COLUMNS)), staged)


def stg_bookings_incremental(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """The staged table after the new valid versions came in; an invalid version replaces nothing."""
    return upsert_latest(staged, new_bookings(raw, staged), ["booking_id"], BOOKING_VERSION)


def _ads(google: DataFrame, meta: DataFrame) -> DataFrame:
    return ad_versions(union_all(google, meta))


def ad_versions(ads: DataFrame) -> DataFrame:
    """Campaign versions of any platform; the campaign id becomes text."""
    return ads.select(*[
        F.col(name).cast("string").alias(name) if name == "campaign_id" else F.col(name) for name in AD_COLUMNS
    ])


def stg_ads_latest(google: DataFrame, meta: DataFrame) -> DataFrame:
    """Newest version of each campaign per platform; the campaign id becomes text."""
    return latest_by(_ads(google, meta), ["platform", "campaign_id"], ["loaded_at"])


def stg_ads_incremental(google: DataFrame, meta: DataFrame, staged: DataFrame) -> DataFrame:
    """The staged campaigns after the versions loaded since came in."""
    new = after_high_water(_ads(google, meta), staged, inclusive=True)
    return upsert_latest(staged, new, ["platform", "campaign_id"], ["loaded_at"])


def _live_orders(raw: DataFrame, legacy: bool) -> DataFrame:
    """Change records that hold an order, with its key: the raw column, or the image's where that is missing."""
    operations = ("c", "u") if legacy else ("c", "u", "r")
    live = raw.where(F.col("op").isin(*operations) & ~F.col("after_record").isin(*NO_IMAGE))
    known = F.when(F.col("order_id") >= 0, F.col("order_id"))
    key = F.col("order_id") if legacy else F.coalesce(known, json_uint(F.col("after_record"), "order_id"))
    return live.withColumn("order_key", key)


def refused_orders(raw: DataFrame) -> DataFrame:
    """Change records whose order id the tables cannot hold, with the reason."""
    refused = _live_orders(raw, legacy=False).where("order_key is null").drop("order_key")
    return refused.withColumn("error_reason", F.lit("order_id is out of range"))


def stg_orders(raw: DataFrame, legacy: bool = False, time_unit: str = "micros") -> DataFrame:
    """Current state of each order from its change records.

    Deletes are left out before ranking, so a deleted order keeps its last live state.
    ``legacy``: snapshot rows are left out too, the key is the raw column instead of the one in
    the image, and the arrival time decides between equal source times. Only a missing key is
    read from the JSON before the shuffle; the winning image is parsed after it. Times that are
    numbers count ``time_unit`` since the epoch. Orders of ``refused_orders`` are left out.
    """
    order = ["source_ts_ms", "ingested_at"] if legacy else ["source_ts_ms"]
    newest = latest_by(order_versions(raw, legacy), ["order_key"], order)
    return order_rows(newest, legacy, time_unit)


def order_versions(raw: DataFrame, legacy: bool = False) -> DataFrame:
    """The change records that hold an order: key, image as text, and when it changed and arrived."""
    live = _live_orders(raw, legacy)
    if not legacy:
        live = live.where("order_key is not null")
    return live.select("order_key", "after_record", "source_ts_ms", "ingested_at")


def order_rows(versions: DataFrame, legacy: bool = False, time_unit: str = "micros") -> DataFrame:
    """Orders read off their change records, one row each; further columns stay out."""
    image = F.from_json("after_record", ORDER_IMAGE).alias("_o")
    newest = versions.select("order_key", "source_ts_ms", "after_record", image)
    order_id = json_uint(F.col("after_record"), "order_id") if legacy else F.col("order_key")
    return newest.select(
        order_id.alias("order_id"),
        as_uint(F.col("_o.user_id")).alias("user_id"),
        as_text(F.col("_o.route")).alias("route"),
        as_text(F.col("_o.transport_type")).alias("transport_type"),
        as_text(F.col("_o.status")).alias("status"),
        as_float(F.col("_o.price")).alias("price"),
        as_text(F.col("_o.currency")).alias("currency"),
        as_uint(F.col("_o.campaign_id")).alias("campaign_id"),
        as_time(F.col("_o.created_at"), time_unit).alias("created_at"),
        as_time(F.col("_o.updated_at"), time_unit).alias("updated_at"),
        "source_ts_ms",
    )


def stg_user_events(raw: DataFrame) -> DataFrame:
    """Newest ingested copy of each event."""
    return latest_by(raw.select(*EVENT_COLUMNS), ["event_id"], ["ingested_at"])


def stg_orders_incremental(new_changes: DataFrame, staged: DataFrame) -> DataFrame:
    """The staged orders after the change records that came in since."""
    return upsert_latest(staged, stg_orders(new_changes), ["order_id"], ["source_ts_ms"])


def stg_user_events_incremental(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """The staged events after the copies ingested since came in."""
    new = after_high_water(raw.select(*EVENT_COLUMNS), staged, "ingested_at", inclusive=True)
    return upsert_latest(staged, new, ["event_id"], ["ingested_at"])
