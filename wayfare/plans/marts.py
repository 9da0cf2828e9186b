"""Marts: aggregates over staging. Inputs are the staging tables, unique on their key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import count_if, distinct_count, money_avg, money_sum, ratio, sum_if
from wayfare.operators import latest_by, to_long


def paid() -> Column:
    return F.col("status") == "paid"


def earns() -> Column:
    """Whether an order counts as revenue."""
    return F.col("status").isin("paid", "completed")


def mart_daily_bookings(bookings: DataFrame) -> DataFrame:
    """Bookings by creation day: totals by status, revenue of the paid ones."""
    return bookings.groupBy(F.to_date("created_at").alias("booking_date")).agg(
        F.count("*").alias("total_bookings"),
        count_if(paid()).alias("paid_bookings"),
        count_if(F.col("status") == "created").alias("created_bookings"),
        count_if(F.col("status") == "cancelled").alias("cancelled_bookings"),
        sum_if("price", paid()).alias("total_revenue"),
    )


def mart_route_revenue(bookings: DataFrame) -> DataFrame:
    """Bookings and paid revenue by route and transport type."""
    return bookings.groupBy("route", "transport_type").agg(
        F.count("*").alias("total_bookings"),
        count_if(paid()).alias("paid_bookings"),
        sum_if("price", paid()).alias("total_revenue"),
    )


def mart_booking_status(bookings: DataFrame) -> DataFrame:
    return bookings.groupBy("status").agg(F.count("*").alias("total_bookings"))


def mart_ad_performance(ads: DataFrame) -> DataFrame:
    """Click-through rate and cost per click of each campaign."""
    return ads.select(
        "platform",
        "campaign_id",
        "campaign_name",
        "clicks",
        "impressions",
        "spend",
        ratio(F.col("clicks"), F.col("impressions")).alias("ctr"),
        ratio(F.col("spend"), F.col("clicks")).alias("cpc"),
    )


def mart_campaign_performance(ads: DataFrame, orders: DataFrame) -> DataFrame:
    """Campaigns with the orders they earned: cost per booking, return on spend.

    Orders are summed per campaign before the join, so the join sees one row per campaign and
    the orders without a campaign never travel as rows.
    """
    earned = orders.where(earns()).groupBy("campaign_id").agg(F.count("*").alias("bookings"), money_sum("price").alias("revenue"))
    return campaigns_with_orders(ads, earned)


def campaigns_with_orders(ads: DataFrame, earned: DataFrame) -> DataFrame:
    """Campaigns with what they earned: ``earned`` has campaign_id, bookings and revenue, one row per campaign."""
    earned = earned.select(
        F.col("campaign_id").cast("string").alias("campaign_id"), F.col("bookings").alias("_bookings"), F.col("revenue").alias("_revenue")
    )
    bookings = F.coalesce("_bookings", F.lit(0))
    revenue = F.coalesce("_revenue", F.lit(0.0))
    return ads.join(earned, "campaign_id", "left").select(
        "platform",
        "campaign_id",
        "campaign_name",
        "spend",
        "clicks",
        "impressions",
        bookings.alias("bookings"),
        revenue.alias("revenue"),
        ratio(F.col("spend"), bookings).alias("cpa"),
        ratio(revenue, F.col("spend")).alias("roas"),
    )


def mart_orders_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(
        F.count("*").alias("orders_count"), money_sum("price").alias("total_revenue")
    )


def mart_route_revenue_from_orders(orders: DataFrame) -> DataFrame:
    """Revenue and mean value of paid and completed orders by route."""
    return (
        orders.where(earns())
        .groupBy("route")
        .agg(
            F.count("*").alias("orders_count"),
            money_sum("price").alias("total_revenue"),
            money_avg("price").alias("avg_order_value"),
        )
    )


def mart_user_event_funnel(events: DataFrame) -> DataFrame:
    """Events and exact distinct users per event type."""
    return events.groupBy("event_type").agg(
        distinct_count("user_id").alias("users_count"), F.count("*").alias("events_count")
    )


STEPS = (
    ("searches", "search_performed"),
    ("bookings", "booking_started"),
    ("payments", "payment_completed"),
)


def mart_booking_conversion(events: DataFrame, by: str = "events") -> DataFrame:
    """Funnel steps and the rates between them as ``(metric, value)`` rows.

    ``by='events'`` counts events, ``by='users'`` counts distinct users. One pass either way;
    users are counted per type first, so no row is copied per step.
    """
    if by == "events":
        per_type = events.groupBy("event_type").agg(F.count("*").alias("n"))
    elif by == "users":
        per_type = events.groupBy("event_type").agg(distinct_count("user_id").alias("n"))
    else:
        raise ValueError(f"unknown counting unit {by!r}")
    return conversion(per_type)


def conversion(per_type: DataFrame) -> DataFrame:
    """Steps and rates from a number ``n`` per event type."""
    steps = {
        name: F.coalesce(F.sum(F.when(F.col("event_type") == event_type, F.col("n"))), F.lit(0))
        for name, event_type in STEPS
    }
    return to_long(
        per_type,
        [
            *steps.items(),
            ("search_to_booking_rate", ratio(steps["bookings"], steps["searches"])),
            ("booking_to_payment_rate", ratio(steps["payments"], steps["bookings"])),
        ],
    )


def mart_dq_latest_results(results: DataFrame) -> DataFrame:
    """Newest result of each check."""
    return latest_by(
        results.select("check_name", "check_status", "check_value", "check_threshold", "checked_at"),
        ["check_name"],
        ["checked_at"],
    )
