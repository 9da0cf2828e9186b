"""Data-quality checks: one pass per table, results as rows, failing stops the run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import count_if, minutes_between
from wayfare.operators import dealt_by

FRESH_MINUTES = 120
# The statuses staged orders may have.
ORDER_STATUSES = ("paid", "completed", "cancelled")


class QualityError(RuntimeError):
    """A check of the suite failed."""


@dataclass(frozen=True)
class Check:
    """One check: ``kind`` is rows, violations, unique or freshness; ``predicate`` is a SQL condition."""

    name: str
    kind: str
    predicate: str = ""
    keys: tuple[str, ...] = ()
    column: str = "loaded_at"
    threshold: float = 0.0


def not_empty(name: str) -> Check:
    return Check(name, "rows", threshold=1.0)


def no_rows_where(name: str, predicate: str) -> Check:
    return Check(name, "violations", predicate=predicate)


def not_null(name: str, column: str) -> Check:
    return no_rows_where(name, f"{column} IS NULL")


def accepted_values(name: str, column: str, values: Sequence[str]) -> Check:
    listed = ", ".join(f"'{value}'" for value in values)
    return no_rows_where(name, f"{column} NOT IN ({listed})")


def unique(name: str, *keys: str) -> Check:
    return Check(name, "unique", keys=keys)


def fresh(name: str, column: str = "loaded_at", minutes: float = FRESH_MINUTES) -> Check:
    return Check(name, "freshness", column=column, threshold=float(minutes))


RAW_BOOKINGS = (
    not_empty("raw_bookings_completeness"),
    fresh("raw_bookings_freshness"),
    unique("raw_bookings_duplicates_within_run", "booking_id", "run_id"),
)
STG_BOOKINGS = (
    not_empty("stg_bookings_completeness"),
    unique("stg_bookings_uniqueness", "booking_id"),
    fresh("stg_bookings_freshness"),
)
STG_ORDERS = (
    not_empty("stg_orders_not_empty"),
    unique("stg_orders_duplicate_order_ids", "order_id"),
    no_rows_where(
        "stg_orders_positive_price_for_revenue_orders",
        "status IN ('paid', 'completed') AND price <= 0",
    ),
    accepted_values("stg_orders_valid_status", "status", ORDER_STATUSES),
)

# Declared column tests per model: columns that must not be null, and columns that must be unique.
MODEL_TESTS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "stg_bookings_latest": (("booking_id", "status"), ("booking_id",)),
    "stg_ads_latest": (("platform", "campaign_id", "campaign_name"), ()),
    "stg_orders": (("order_id", "status", "price"), ("order_id",)),
    "stg_user_events": (("event_id", "user_id", "event_type"), ("event_id",)),
    "mart_daily_bookings": (("booking_date", "total_bookings", "total_revenue"), ()),
    "mart_route_revenue": (("route", "transport_type", "total_bookings", "total_revenue"), ()),
    "mart_booking_status": (("status", "total_bookings"), ()),
    "mart_campaign_performance": (("platform", "campaign_id", "spend", "revenue"), ()),
    "mart_orders_status": (("status", "orders_count", "total_revenue"), ()),
    "mart_route_revenue_from_orders": (("route", "orders_count", "total_revenue"), ()),
    "mart_user_event_funnel": (("event_type", "users_count", "events_count"), ()),
    "mart_booking_conversion": (("metric", "value"), ("metric",)),
}


def model_checks(model: str) -> tuple[Check, ...]:
    """The declared column tests of a model as checks."""
    required, keys = MODEL_TESTS[model]
    return (
        *[not_null(f"{model}.{column}.not_null", column) for column in required],
        *[unique(f"{model}.{column}.unique", column) for column in keys],
    )


def _passed(check: Check, value: Column) -> Column:
    if check.kind == "rows":
        return value > 0
    if check.kind == "freshness":
        return value <= check.threshold
    return value == 0


def run_suite(df: DataFrame, checks: Sequence[Check], as_of: datetime | str | Column | None = None) -> DataFrame:
    """Results of all checks of one table: name, PASS/FAIL, value, threshold, time.

    The table is read once and, if one key is to be unique, dealt out in parts of bounded size (see ``dealt_by``): counts,
    violations and the newest time are gathered per group of the uniqueness key (combined before the shuffle) and folded into one row. With several uniqueness keys, there
    is one shuffle: each row is counted under each of them, and the other checks under the first; see ``_by_every_key``. The time of an empty table is the
    epoch, so it is stale.
    """
    now = F.current_timestamp() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    now = now.cast("timestamp")
    sets = list(dict.fromkeys(check.keys for check in checks if check.kind == "unique"))
    local: list[Column] = [F.count("*").alias("_rows")]
    total: dict[str, Column] = {"_rows": F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows")}
    values: dict[str, Column] = {}
    for position, check in enumerate(checks):
        slot = f"_c{position}"
        if check.kind == "rows":
            values[check.name] = F.col("_rows")
        elif check.kind == "violations":
            violates = F.expr(check.predicate)
            # Of several copies of a row, the first is looked at; the others lack its columns.
            violates = violates & (F.col("_set") == 0) if len(sets) > 1 else violates
            local.append(count_if(violates).alias(slot))
            total[slot] = F.coalesce(F.sum(slot), F.lit(0)).alias(slot)
            values[check.name] = F.col(slot)
        elif check.kind == "freshness":
            local.append(F.max(F.col(check.column).cast("timestamp")).alias(slot))
            total[slot] = F.coalesce(F.max(slot), F.timestamp_seconds(F.lit(0))).alias(slot)
            values[check.name] = minutes_between(F.col(slot), now)
        elif len(sets) == 1:
            known = [F.col(key).isNotNull() for key in check.keys]
            repeated = F.col("_rows") > 1
            for condition in known:
                repeated = repeated & condition
            total[slot] = count_if(repeated).alias(slot)
            values[check.name] = F.col(slot)
        else:
            mine = (F.col("_set") == sets.index(check.keys)) & F.col("_key").isNotNull()
            total[slot] = count_if(mine & (F.col("_copies") > 1)).alias(slot)
            values[check.name] = F.col(slot)
    if len(sets) > 1:
        folded = _by_every_key(df, sets, local).agg(*total.values())
    else:
        rows = dealt_by(df, sets[0]) if sets else df
        folded = rows.groupBy(*(sets[0] if sets else ())).agg(*local).agg(*total.values())

    def result(check: Check, value: Column) -> Column:
        value = value.cast("double")
        return F.struct(
            F.lit(check.name).alias("check_name"),
            F.when(_passed(check, value), "PASS").otherwise("FAIL").alias("check_status"),
            value.alias("check_value"),
            F.lit(float(check.threshold)).alias("check_threshold"),
            now.alias("checked_at"),
        )

    return folded.select(F.inline(F.array(*[result(check, values[check.name]) for check in checks])))


def _by_every_key(df: DataFrame, sets: Sequence[tuple[str, ...]], local: Sequence[Column]) -> DataFrame:
    """Each row under each set of key columns: (set, key, copies), and the other measures under the first set.

    A key is the text of its values, so keys of any types meet in one shuffle and equal hashes are no matter. It is null if any
    of its columns is; all rows with such keys of one set are a group, which every task folds to one row. What the other
    measures read is there in the copies of the first set alone.
    """
    def text(keys: tuple[str, ...]) -> Column:
        known = F.lit(True)
        for key in keys:
            known = known & F.col(key).isNotNull()
        return F.when(known, F.to_json(F.struct(*keys)))

    listed = F.array(*[F.struct(F.lit(n).alias("set"), text(keys).alias("key")) for n, keys in enumerate(sets)])
    stacked = df.withColumn("_under", F.explode(listed)).withColumns({"_set": F.col("_under.set"), "_key": F.col("_under.key")})
    first = stacked.select("_set", "_key", *[F.when(F.col("_set") == 0, F.col(c)).alias(c) for c in df.columns])
    measures = [F.count("*").alias("_copies"), count_if(F.col("_set") == 0).alias("_rows"), *local[1:]]
    return first.groupBy("_set", "_key").agg(*measures)


def enforce(results: DataFrame) -> None:
    """Raise if any result is FAIL. Only the failing checks travel to the driver."""
    failing = results.where("check_status = 'FAIL'").orderBy("check_name").collect()
    if failing:
        listed = ", ".join(f"{row.check_name} ({row.check_value:g})" for row in failing)
        raise QualityError(f"data quality failed: {listed}")


def check_and_record(
    df: DataFrame, checks: Sequence[Check], path: str, as_of: datetime | str | Column | None = None
) -> None:
    """Run a suite, append its results to the history, then stop if a check failed."""
    history = run_suite(df, checks, as_of)
    rows = history.collect()  # one row per check
    spark = df.sparkSession
    kept = spark.createDataFrame(rows, history.schema)
    kept.coalesce(1).write.mode("append").parquet(path)
    enforce(kept)


def error_reasons(dead_letters: DataFrame) -> DataFrame:
    """Dead letters by reason, the most frequent first."""
    return (
        dead_letters.groupBy("error_reason")
        .agg(F.count("*").alias("records_count"))
        .orderBy(F.col("records_count").desc(), "error_reason")
    )


def last_load(df: DataFrame, column: str = "loaded_at") -> DataFrame:
    return df.agg(F.max(column).alias("last_load"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("records_count"))
