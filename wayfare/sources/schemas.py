"""The fixed schema of every table, by layer."""

from __future__ import annotations

from pyspark.sql import types as T

_AD = (
    "campaign_id long, campaign_name string, clicks long, impressions long, spend double, "
    "platform string, loaded_at timestamp"
)
_BOOKING = (
    "booking_id long, user_id long, route string, transport_type string, status string, "
    "price double, currency string, created_at timestamp, loaded_at timestamp, run_id string"
)
_EVENT = (
    "event_id string, user_id long, event_type string, event_time timestamp, properties string, "
    "source_topic string, ingested_at timestamp"
)

RAW = {
    "raw_bookings": _BOOKING,
    "raw_google_ads": _AD,
    "raw_meta_ads": _AD,
    "raw_user_events": _EVENT,
    "raw_cdc_orders": (
        "order_id long, op string, before_record string, after_record string, source_topic string, "
        "source_ts_ms long, ingested_at timestamp"
    ),
    "raw_ads_api_payloads": "source string, endpoint string, payload string, fetched_at timestamp",
}
DLQ = {
    "dlq_bookings": "booking_id long, raw_record string, error_reason string, failed_at timestamp",
    "dlq_user_events": (
        "event_id string, raw_event string, error_reason string, source_topic string, failed_at timestamp, "
        "recovered boolean, recovered_at timestamp, replay_count int, replayed boolean, replayed_at timestamp"
    ),
}
STAGING = {
    "stg_bookings_latest": _BOOKING,
    "stg_ads_latest": (
        "platform string, campaign_id string, campaign_name string, clicks long, impressions long, "
        "spend double, loaded_at timestamp"
    ),
    "stg_orders": (
        "order_id long, user_id long, route string, transport_type string, status string, price double, "
        "currency string, campaign_id long, created_at timestamp, updated_at timestamp, source_ts_ms long"
    ),
    "stg_user_events": _EVENT,
}
QUALITY = {
    "dq_results": (
        "check_name string, check_status string, check_value double, check_threshold double, "
        "checked_at timestamp"
    ),
}
MARTS = {
    "mart_daily_bookings": (
        "booking_date date, total_bookings long, paid_bookings long, created_bookings long, "
        "cancelled_bookings long, total_revenue double"
    ),
    "mart_route_revenue": (
        "route string, transport_type string, total_bookings long, paid_bookings long, total_revenue double"
    ),
    "mart_booking_status": "status string, total_bookings long",
    "mart_ad_performance": (
        "platform string, campaign_id string, campaign_name string, clicks long, impressions long, "
        "spend double, ctr double, cpc double"
    ),
    "mart_campaign_performance": (
        "platform string, campaign_id string, campaign_name string, spend double, clicks long, "
        "impressions long, bookings long, revenue double, cpa double, roas double"
    ),
    "mart_orders_status": "status string, orders_count long, total_revenue double",
    "mart_route_revenue_from_orders": (
        "route string, orders_count long, total_revenue double, avg_order_value double"
    ),
    "mart_user_event_funnel": "event_type string, users_count long, events_count long",
    "mart_booking_conversion": "metric string, value double",
    "mart_dq_latest_results": QUALITY["dq_results"],
}

# Stored sort order of each table: the columns readers filter on.
SORT_KEYS = {
    "raw_bookings": ("booking_id", "loaded_at"),
    "raw_user_events": ("event_id", "ingested_at"),
    "raw_cdc_orders": ("order_id", "source_ts_ms", "ingested_at"),
    "raw_ads_api_payloads": ("source", "endpoint", "fetched_at"),
    "raw_google_ads": ("campaign_id", "loaded_at"),
    "raw_meta_ads": ("campaign_id", "loaded_at"),
    "dlq_bookings": ("booking_id", "failed_at"),
    "dlq_user_events": ("failed_at",),
    "stg_bookings_latest": ("booking_id",),
    "stg_ads_latest": ("platform", "campaign_id"),
    "stg_orders": ("order_id",),
    "stg_user_events": ("event_id",),
    "dq_results": ("check_name", "checked_at"),
    "mart_daily_bookings": ("booking_date",),
    "mart_route_revenue": ("route", "transport_type"),
    "mart_booking_status": ("status",),
    "mart_ad_performance": ("platform", "campaign_id"),
    "mart_campaign_performance": ("platform", "campaign_id"),
    "mart_orders_status": ("status",),
    "mart_route_revenue_from_orders": ("route",),
    "mart_user_event_funnel": ("event_type",),
    "mart_booking_conversion": ("metric",),
    "mart_dq_latest_results": ("check_name",),
}

_ALL = {**RAW, **DLQ, **STAGING, **QUALITY, **MARTS}

# The message on the user-event topic; readers ignore the optional device_type.
EVENT_MESSAGE = (
    "event_id string, user_id long, event_type string, event_time string, properties string, "
    "device_type string"
)
EVENT_AVRO = """{"type": "record", "name": "UserEvent", "fields": [
  {"name": "event_id", "type": "string"},
  {"name": "user_id", "type": "long"},
  {"name": "event_type", "type": {"type": "enum", "name": "UserEventType",
    "symbols": ["search_performed", "booking_started", "payment_completed"]}},
  {"name": "event_time", "type": "string"},
  {"name": "properties", "type": "string"},
  {"name": "device_type", "type": ["null", "string"], "default": null}]}"""


def tables() -> tuple[str, ...]:
    return tuple(_ALL)


def schema(name: str) -> T.StructType:
    """Schema of a declared table."""
    return T.StructType.fromDDL(_ALL[name])
