"""The daily refresh: staging from raw, checks, marts from the written staging."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators import after_high_water, union_all, upsert_latest
from wayfare.plans import marts, quality, staging
from wayfare.sinks.writers import write_table
from wayfare.sources.tables import read_table


STAGING = ("stg_bookings_latest", "stg_ads_latest", "stg_orders", "stg_user_events")


def build_staging(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_bookings_latest": staging.stg_bookings_latest(raw["raw_bookings"]),
        "stg_ads_latest": staging.stg_ads_latest(raw["raw_google_ads"], raw["raw_meta_ads"]),
        "stg_orders": staging.stg_orders(raw["raw_cdc_orders"]),
        "stg_user_events": staging.stg_user_events(raw["raw_user_events"]),
    }


def build_marts(staged: Mapping[str, DataFrame], conversion_by: str = "events") -> dict[str, DataFrame]:
    bookings, ads = staged["stg_bookings_latest"], staged["stg_ads_latest"]
    orders, events = staged["stg_orders"], staged["stg_user_events"]
    return {
        "mart_daily_bookings": marts.mart_daily_bookings(bookings),
        "mart_route_revenue": marts.mart_route_revenue(bookings),
        "mart_booking_status": marts.mart_booking_status(bookings),
        "mart_ad_performance": marts.mart_ad_performance(ads),
        "mart_campaign_performance": marts.mart_campaign_performance(ads, orders),
        "mart_orders_status": marts.mart_orders_status(orders),
        "mart_route_revenue_from_orders": marts.mart_route_revenue_from_orders(orders),
        "mart_user_event_funnel": marts.mart_user_event_funnel(events),
        "mart_booking_conversion": marts.mart_booking_conversion(events, conversion_by),
    }


def extend_staging(raw: Mapping[str, DataFrame], staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The staging tables after what came in since they were written; older raw rows are not read.

    New is by the rows' own times, those equal to the newest time included. Changes of orders are new by their source time,
    since staged orders keep no other. What arrives later than rows with a newer time is not seen here; ``increments.refresh``
    goes by loads and misses nothing.
    """
    orders = staged["stg_orders"]
    return {
        "stg_bookings_latest": upsert_latest(
            staged["stg_bookings_latest"],
            after_high_water(raw["raw_bookings"].select(*staging.BOOKING_COLUMNS), staged["stg_bookings_latest"], inclusive=True),
            ["booking_id"],
            staging.BOOKING_VERSION,
        ),
        "stg_ads_latest": staging.stg_ads_incremental(
            raw["raw_google_ads"], raw["raw_meta_ads"], staged["stg_ads_latest"]
        ),
        "stg_orders": staging.stg_orders_incremental(newer_changes(raw["raw_cdc_orders"], orders), orders),
        "stg_user_events": staging.stg_user_events_incremental(raw["raw_user_events"], staged["stg_user_events"]),
    }


def newer_changes(raw: DataFrame, orders: DataFrame) -> DataFrame:
    """Change records with the source time of the newest staged order or a later one, and those without a source time."""
    mark = orders.agg(F.coalesce(F.max("source_ts_ms"), F.lit(-1))).scalar()
    return raw.where(F.col("source_ts_ms").isNull() | (F.col("source_ts_ms") >= mark))


def refresh(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    conversion_by: str = "events",
    incremental: bool = False,
) -> dict[str, DataFrame]:
    """Write all staging tables and marts below ``root`` and return them as read back.

    Staging is written once and read by every mart, instead of being ranked again for each.
    ``incremental`` folds only what is new into the staging tables that ``root`` holds already.
    """
    staged = {}
    if incremental:
        tables = extend_staging(raw, {name: read_table(spark, name, root) for name in STAGING})
    else:
        tables = build_staging(raw)
    for name, df in tables.items():
        write_table(df, name, root)
        staged[name] = read_table(spark, name, root)
    built = dict(staged)
    for name, df in build_marts(staged, conversion_by).items():
        write_table(df, name, root)
        built[name] = read_table(spark, name, root)
    return built


def model_test_results(models: Mapping[str, DataFrame], as_of) -> DataFrame:
    """Results of the declared column tests of all models."""
    return union_all(*[
        quality.run_suite(models[name], quality.model_checks(name), as_of) for name in quality.MODEL_TESTS
    ])
