"""Accepting and refusing records: user events, ad records, bookings."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import lenient
from wayfare.functions.jsontext import plain_number, to_json_strings
from wayfare.functions.times import instant, usual_time
from wayfare.operators import after_high_water

USER_EVENTS_TOPIC = "user.events.avro"

# Fixed values of the contracts.
EVENT_TYPES = ("search_performed", "booking_started", "payment_completed")
PLATFORMS = ("google_ads", "meta_ads")
AD_COLUMNS = ("platform", "campaign_id", "campaign_name", "impressions", "clicks", "spend")
NOT_JSON = "JSONDecodeError"
NOT_VALID = "ValidationError"
# Canonical lower-case form only: keyed updates compare the text.
UUID_TEXT = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"


class InvalidBatch(ValueError):
    """A batch that must be valid as a whole holds invalid records."""


def is_uuid(text: Column) -> Column:
    """Whether a text is a canonical UUID; NULL counts as no."""
    return F.coalesce(text.rlike(UUID_TEXT), F.lit(False))


def _plain_events(messages: DataFrame) -> DataFrame:
    """Add ``_plain``: the fields of a message that is valid and written in the usual way.

    Every field must have a text that no JSON number, literal or object could have where a text
    is required, so nothing is lost by reading all of them as texts. NULL for other messages.
    """
    fields = "event_id string, user_id string, event_type string, event_time string, properties string"
    read = lenient.read_whole(messages, "_m", F.col("value"), fields)
    opened = lenient.read_whole(read, "_p", F.col("_m.properties"), "route string")
    dated = lenient.settle(opened, _time=usual_time(F.col("_m.event_time")))
    usual = (
        is_uuid(F.col("_m.event_id"))
        & F.col("_m.user_id").rlike(r"^\d{1,18}\z")
        & F.col("_m.event_type").isin(*EVENT_TYPES)
        & F.col("_time").isNotNull()
        & F.col("_p.route").rlike(r"^\p{L}")
        & ~F.col("_p.route").isin("true", "false")
    )
    plain = F.struct(
        F.col("_m.event_id").alias("event_id"),
        F.col("_m.user_id").try_cast("bigint").alias("user_id"),
        F.col("_m.event_type").alias("event_type"),
        F.col("_time").alias("event_time"),
        F.col("_p.route").alias("route"),
    )
    return lenient.settle(dated, _plain=F.when(usual, plain)).select(*messages.columns, "_plain")


def validate_user_events(messages: DataFrame) -> DataFrame:
    """User-event messages (JSON text in ``value``) with typed fields and ``violations``.

    ``violations`` lists ``(field, error)``; it is empty for an accepted event. ``properties``
    may be an object or the JSON text of one. Unknown fields are ignored. No message text can
    fail the job. Valid messages in the usual form are read the cheap way; only the others are
    taken apart field by field.
    """
    names = ("event_id", "user_id", "event_type", "event_time", "properties")
    sorted_out = _plain_events(messages)
    unusual = F.when(F.col("_plain").isNull(), F.col("value"))
    fields = lenient.take(lenient.parse_whole(sorted_out, "_v", unusual), "_v", names)
    opened = lenient.parse_whole(fields, "_written", F.col("_properties_text"))
    is_text = F.col("_properties_kind") == "STRING"
    opened = opened.withColumn("_object", F.when(is_text, F.col("_written")).otherwise(F.col("_properties")))
    routed = lenient.take(opened, "_object", ["route"]).withColumn(
        "_object_kind", F.regexp_extract(F.schema_of_variant("_object"), "^[A-Z]+", 0)
    )

    def value(name: str, unusual: Column) -> Column:
        return F.when(F.col("_plain").isNotNull(), F.col(f"_plain.{name}")).otherwise(unusual)

    values = lenient.settle(
        routed,
        event_id=value("event_id", lenient.text_value("event_id")),
        user_id=value("user_id", lenient.int_value("user_id")),
        event_type=value("event_type", lenient.choice_value("event_type", EVENT_TYPES)),
        event_time=value("event_time", lenient.time_value("event_time")),
        route=value("route", lenient.text_value("route")),
    )
    bad_object = (
        F.when(F.col("_properties").isNull(), lenient.MISSING)
        .when(F.col("_object").isNull(), lenient.NOT_JSON)
        .when(F.col("_object_kind") != "OBJECT", lenient.DICT_TYPE)
    )
    rules = {
        "event_id": lenient.text_error("event_id"),
        "user_id": F.coalesce(
            lenient.int_error("user_id", F.col("user_id")), F.when(F.col("user_id") < 0, lenient.NEGATIVE)
        ),
        "event_type": lenient.choice_error("event_type", F.col("event_type")),
        "event_time": lenient.time_error("event_time", F.col("event_time")),
        "properties": bad_object,
        "properties.route": F.when(F.col("_object_kind") == "OBJECT", lenient.text_error("route")),
    }
    present = [F.col(name).isNotNull() for name in ("event_id", "event_type", "event_time", "route")]
    good = reduce(and_, present, F.col("user_id") >= 0)
    judged = lenient.settle(values, violations=lenient.broken(F.col("_v").isNotNull(), good, rules))
    return judged.select(
        *messages.columns,
        "event_id",
        "user_id",
        "event_type",
        "event_time",
        "route",
        F.coalesce("event_id", F.try_variant_get("_event_id", "$", "string")).alias("stated_id"),
        "violations",
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") == 0)


def refused(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") > 0)


def normalize_user_event(
    checked: DataFrame,
    topic: str = USER_EVENTS_TOPIC,
    ingested_at: datetime | str | Column | None = None,
) -> DataFrame:
    """Accepted events as raw rows; ``properties`` holds only the known keys."""
    return accepted(checked).select(
        "event_id",
        "user_id",
        "event_type",
        "event_time",
        F.to_json(F.struct("route")).alias("properties"),
        F.lit(topic).alias("source_topic"),
        instant(ingested_at).alias("ingested_at"),
    )


def error_type(violations: Column) -> Column:
    unreadable = F.exists(violations, lambda broken: broken["error"] == lenient.NOT_JSON)
    return F.when(unreadable, NOT_JSON).otherwise(NOT_VALID)


def dead_letters(
    checked: DataFrame,
    topic: str = USER_EVENTS_TOPIC,
    failed_at: datetime | str | Column | None = None,
) -> DataFrame:
    """Refused events as dead-letter rows: whole text, reason, untouched lifecycle flags."""
    now = instant(failed_at)
    reason = F.to_json(
        F.struct(
            error_type(F.col("violations")).alias("error_type"),
            F.col("violations").alias("error_details"),
            F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("ingested_at"),
        )
    )
    return refused(checked).select(
        F.col("stated_id").alias("event_id"),
        F.col("value").alias("raw_event"),
        reason.alias("error_reason"),
        F.lit(topic).alias("source_topic"),
        now.alias("failed_at"),
        F.lit(False).alias("recovered"),
        F.lit(None).cast("timestamp").alias("recovered_at"),
        F.lit(0).alias("replay_count"),
        F.lit(False).alias("replayed"),
        F.lit(None).cast("timestamp").alias("replayed_at"),
    )


def check_ads(messages: DataFrame) -> DataFrame:
    """Ad records (JSON text in ``value``) with typed fields and ``violations``.

    A missing metric is 0; a metric that is present must be a number and not negative. Names
    are trimmed and must not be blank. Unknown fields are ignored.
    """
    fields = lenient.take(lenient.parse_whole(messages, "_v", F.col("value")), "_v", AD_COLUMNS)
    values = lenient.settle(
        fields,
        platform=lenient.choice_value("platform", PLATFORMS),
        campaign_id=lenient.int_value("campaign_id"),
        campaign_name=F.regexp_replace(lenient.text_value("campaign_name"), r"^\s+|\s+\z", ""),
        impressions=lenient.int_value("impressions"),
        clicks=lenient.int_value("clicks"),
        spend=lenient.float_value("spend"),
    )

    def metric(name: str, error: Column) -> Column:
        below = F.when(F.col(name) < 0, lenient.VALUE)
        return F.when(F.col(f"_{name}").isNotNull(), F.coalesce(error, below))

    blank = F.when(F.length("campaign_name") == 0, lenient.VALUE)
    rules = {
        "platform": lenient.choice_error("platform", F.col("platform")),
        "campaign_id": lenient.int_error("campaign_id", F.col("campaign_id")),
        "campaign_name": F.coalesce(lenient.text_error("campaign_name"), blank),
        "impressions": metric("impressions", lenient.int_error("impressions", F.col("impressions"))),
        "clicks": metric("clicks", lenient.int_error("clicks", F.col("clicks"))),
        "spend": metric("spend", lenient.float_error("spend", F.col("spend"))),
    }
    metrics = [F.col(f"_{name}").isNull() | (F.col(name) >= 0) for name in ("impressions", "clicks", "spend")]
    known = [F.col("platform").isNotNull(), F.col("campaign_id").isNotNull()]
    good = reduce(and_, [*known, *metrics], F.length("campaign_name") > 0)
    judged = lenient.settle(values, violations=lenient.broken(F.col("_v").isNotNull(), good, rules))
    return judged.select(
        *messages.columns,
        "platform",
        "campaign_id",
        "campaign_name",
        F.coalesce("impressions", F.lit(0)).alias("impressions"),
        F.coalesce("clicks", F.lit(0)).alias("clicks"),
        F.coalesce("spend", F.lit(0.0)).alias("spend"),
        "violations",
    )


def validate_ads(messages: DataFrame, mode: str = "fail") -> DataFrame:
    """Valid ad records. ``mode='fail'``: one invalid record refuses the whole batch."""
    checked = check_ads(messages)
    if mode == "fail":
        first = refused(checked).select("violations").head()
        if first is not None:
            raise InvalidBatch(f"ad record validation failed: {first['violations']}")
    elif mode != "split":
        raise ValueError(f"unknown mode {mode!r}")
    return accepted(checked).select(*AD_COLUMNS)


def booking_is_valid() -> Column:
    """A key and a finite price that is not negative. Plain comparisons, so the scan can use them."""
    return (F.col("booking_id") != 0) & (F.col("price") >= 0) & (F.col("price") < float("inf"))


def booking_is_invalid() -> Column:
    booking_id, price = F.col("booking_id"), F.col("price")
    # NaN is above infinity here.
    return (booking_id == 0) | (price < 0) | (price >= float("inf")) | booking_id.isNull() | price.isNull()


def booking_error() -> Column:
    """Reason of the first rule an invalid booking breaks. The texts are fixed values."""
    return (
        F.when(F.col("booking_id") == 0, "booking_id is missing or zero")
        .when(F.col("price") < 0, "price is negative")
        .when(F.col("price") >= float("inf"), "price is not finite")
        .otherwise("unknown validation error")
    )


def bookings_dead_letters(raw: DataFrame, failed_at: datetime | str | Column | None = None) -> DataFrame:
    """Invalid bookings as dead-letter rows: all columns as JSON texts, and the reason."""
    written = "yyyy-MM-dd HH:mm:ss.SSS"
    record = to_json_strings(
        booking_id=F.col("booking_id"),
        user_id=F.col("user_id"),
        route=F.col("route"),
        transport_type=F.col("transport_type"),
        status=F.col("status"),
        price=plain_number(F.col("price")),
        currency=F.col("currency"),
        created_at=F.date_format("created_at", written),
        loaded_at=F.date_format("loaded_at", written),
        run_id=F.col("run_id"),
    )
    return raw.where(booking_is_invalid()).select(
        "booking_id",
        record.alias("raw_record"),
        booking_error().alias("error_reason"),
        instant(failed_at).alias("failed_at"),
    )


def new_dead_letters(
    raw: DataFrame, staged: DataFrame, failed_at: datetime | str | Column | None = None
) -> DataFrame:
    """Dead letters of the bookings loaded after everything that is staged: an append repeats no old one."""
    return bookings_dead_letters(after_high_water(raw, staged), failed_at)


def split_bookings(
    raw: DataFrame, failed_at: datetime | str | Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Valid bookings, and the dead letters of the others."""
    return raw.where(booking_is_valid()), bookings_dead_letters(raw, failed_at)
