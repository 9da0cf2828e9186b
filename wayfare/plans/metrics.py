"""Named metrics, and the questions that are asked most."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import count_if, sum_if
from wayfare.operators import top_k
from wayfare.plans.marts import paid
from wayfare.plans.quality import row_count

# Aggregates over bookings.
METRICS: dict[str, Callable[[], Column]] = {
    "total_bookings": lambda: F.count("*"),
    "paid_bookings": lambda: count_if(paid()),
    "total_revenue": lambda: sum_if("price", paid()),
}
# Metrics that are a model of their own.
MODEL_METRICS = {
    "route_revenue": "mart_route_revenue",
    "booking_status_distribution": "mart_booking_status",
}
# One row per ... of the models people ask about.
GRAINS = {
    "mart_daily_bookings": ("booking_date",),
    "mart_route_revenue": ("route", "transport_type"),
    "mart_booking_status": ("status",),
}


def metric(bookings: DataFrame, names: str | Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One or more named metrics over bookings, in total or per dimension, from one pass."""
    wanted = [names] if isinstance(names, str) else list(names)
    return bookings.groupBy(*by).agg(*[METRICS[name]().alias(name) for name in wanted])


def model_metric(name: str, models: Mapping[str, DataFrame]) -> DataFrame:
    """A metric that is a model of its own."""
    return models[MODEL_METRICS[name]]


def top_routes(models: Mapping[str, DataFrame], k: int = 10) -> DataFrame:
    """The k routes with the highest revenue."""
    revenue = models["mart_route_revenue"].select("route", "transport_type", "total_revenue")
    return top_k(revenue, [F.col("total_revenue").desc(), F.col("route"), F.col("transport_type")], k)


def status_distribution(models: Mapping[str, DataFrame]) -> DataFrame:
    return models["mart_booking_status"].orderBy(F.col("total_bookings").desc(), "status")


def paid_bookings_per_day(models: Mapping[str, DataFrame]) -> DataFrame:
    return models["mart_daily_bookings"].select("booking_date", "paid_bookings").orderBy("booking_date")


def dlq_size(models: Mapping[str, DataFrame]) -> DataFrame:
    return row_count(models["dlq_bookings"])


def daily_overview(models: Mapping[str, DataFrame]) -> DataFrame:
    return (
        models["mart_daily_bookings"]
        .select("booking_date", "total_bookings", "total_revenue")
        .orderBy("booking_date")
    )


# Asked in this order; anything else gets the daily overview.
QUESTIONS: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "top routes": top_routes,
    "status": status_distribution,
    "paid bookings": paid_bookings_per_day,
    "dlq": dlq_size,
}


def question(name: str, models: Mapping[str, DataFrame]) -> DataFrame:
    """The answer to a named question."""
    asked = name.lower()
    for known, answer in QUESTIONS.items():
        if known in asked:
            return answer(models)
    return daily_overview(models)
