"""Marts kept up by what changed in staging, instead of being built again from all of it.

A change takes its old row out and puts its new row in. What a mart counts and adds is kept as signed
sums per group, one folder of sums per run; the mart is their total. Amounts are added as decimals, so that what is
taken out is exactly what was put in. An amount that no such decimal holds (not finite, very
large, very fine) is kept with the number of times it is there.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import ratio
from wayfare.plans import marts
from wayfare.sinks import files

EXACT = "decimal(38,15)"
#: Amounts from here on are not added as decimals: the sum of a hundred million of them has to fit.
LARGE = 1e15
EARNS = "status IN ('paid', 'completed')"


@dataclass(frozen=True)
class Additive:
    """What a mart counts and adds, as SQL over a staging row: group columns, rows that take part, counts, one amount."""

    staging: str
    keys: Mapping[str, str]
    where: str = "true"
    counts: Mapping[str, str] = field(default_factory=dict)
    amount: str = "cast(null AS double)"


_PAID = "if(status = 'paid', price, null)"
MARTS = {
    "mart_daily_bookings": Additive(
        "stg_bookings_latest",
        {"booking_date": "to_date(created_at)"},
        counts={
            "total_bookings": "true", "paid_bookings": "status = 'paid'", "created_bookings": "status = 'created'",
            "cancelled_bookings": "status = 'cancelled'",
        },
        amount=_PAID,
    ),
    "mart_route_revenue": Additive(
        "stg_bookings_latest",
        {"route": "route", "transport_type": "transport_type"},
        counts={"total_bookings": "true", "paid_bookings": "status = 'paid'"},
        amount=_PAID,
    ),
    "mart_booking_status": Additive("stg_bookings_latest", {"status": "status"}, counts={"total_bookings": "true"}),
    "mart_orders_status": Additive("stg_orders", {"status": "status"}, counts={"orders_count": "true"}, amount="price"),
    "mart_route_revenue_from_orders": Additive("stg_orders", {"route": "route"}, EARNS, {"orders_count": "true"}, "price"),
    "mart_campaign_performance": Additive("stg_orders", {"campaign_id": "campaign_id"}, EARNS, {"bookings": "true"}, "price"),
    # Users are kept one by one: a user leaves a type when their last event of it does.
    "mart_user_event_funnel": Additive(
        "stg_user_events", {"event_type": "event_type", "user_id": "user_id"}, counts={"events_count": "true"}
    ),
}


def columns_read(staging: str, columns: Sequence[str]) -> list[str]:
    """Those columns of a staging table that the SQL of its marts names."""
    texts = [sql for m in MARTS.values() if m.staging == staging for sql in (*m.keys.values(), m.where, *m.counts.values(), m.amount)]
    named = set(re.findall(r"\w+", " ".join(texts)))
    return [c for c in columns if c in named]


def signed(changes: DataFrame) -> DataFrame:
    """Changes (``before``, ``after``) as staging rows with ``_sign``: -1 for what goes, 1 for what comes."""
    rows = F.array(F.struct(F.lit(-1).alias("_sign"), F.col("before").alias("row")), F.struct(F.lit(1).alias("_sign"), F.col("after").alias("row")))
    return changes.select(F.inline(rows)).where("row is not null").select("_sign", "row.*")


def delta(rows: DataFrame, mart: Additive) -> DataFrame:
    """What signed staging rows add to a mart: its groups with signed sums, and ``_loose`` amounts with how often they come."""
    amount = F.expr(mart.amount).cast("double")
    decimal = F.when(F.abs(amount) < LARGE, amount.try_cast(EXACT))
    exact = decimal.isNotNull() & (decimal.cast("double") == amount)
    measured = rows.where(mart.where).select(
        *[F.expr(sql).alias(name) for name, sql in mart.keys.items()],
        F.when(amount.isNotNull() & ~F.coalesce(exact, F.lit(False)), amount).alias("_loose"),
        F.col("_sign").cast("long").alias("_rows"),
        *[F.when(F.expr(sql), F.col("_sign")).otherwise(0).cast("long").alias(name) for name, sql in mart.counts.items()],
        F.when(amount.isNotNull(), F.col("_sign")).otherwise(0).cast("long").alias("_amounts"),
        F.when(F.coalesce(exact, F.lit(False)), F.col("_sign") * decimal).otherwise(0).cast(EXACT).alias("_exact"),
    )
    return added(measured, mart)


def added(deltas: DataFrame, mart: Additive) -> DataFrame:
    """Deltas of several runs as one."""
    sums = ["_rows", *mart.counts, "_amounts"]
    return deltas.groupBy(*mart.keys, "_loose").agg(
        *[F.sum(name).alias(name) for name in sums], F.sum("_exact").cast(EXACT).alias("_exact")
    )


def totals(deltas: DataFrame, mart: Additive) -> DataFrame:
    """The groups that have rows: counts, ``amount`` and how many amounts it is made of."""
    loose = F.when((F.col("_amounts") != 0) & F.col("_loose").isNotNull(), F.col("_loose") * F.col("_amounts"))
    sums = added(deltas, mart).groupBy(*mart.keys).agg(
        F.sum("_rows").alias("_rows"),
        *[F.sum(name).alias(name) for name in mart.counts],
        F.sum("_amounts").alias("_amounts"),
        (F.sum("_exact").cast("double") + F.coalesce(F.sum(loose), F.lit(0.0))).alias("amount"),
    )
    return sums.where("_rows > 0")


def finished(name: str, deltas: DataFrame, ads: DataFrame | None = None) -> DataFrame:
    """The mart as it is declared, from all its deltas (the campaigns need the staged ads, too)."""
    mart = MARTS[name]
    found = totals(deltas, mart)
    if name == "mart_user_event_funnel":
        return found.groupBy("event_type").agg(F.count("user_id").alias("users_count"), F.sum("events_count").alias("events_count"))
    if name == "mart_campaign_performance":
        return marts.campaigns_with_orders(ads, found.select("campaign_id", "bookings", F.col("amount").alias("revenue")))
    measures: list[Column] = [F.col(c) for c in mart.counts]
    if name != "mart_booking_status":
        measures.append(F.col("amount").alias("total_revenue"))
    if name == "mart_route_revenue_from_orders":
        mean = F.when(F.col("_amounts") > 0, ratio(F.col("amount"), F.col("_amounts")))
        measures.append(mean.alias("avg_order_value"))
    return found.select(*mart.keys, *measures)


class Deltas:
    """The stored deltas of one mart: a folder per run, and sums of many runs where they were folded together."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.mart = spark, f"{path.rstrip('/')}/{name}", MARTS[name]

    def write(self, changes: DataFrame, run: str) -> None:
        """File what a run changed, once."""
        folder = f"{self.path}/runs/{run}"
        if not files.is_complete(self.spark, folder):
            delta(signed(changes), self.mart).write.mode("overwrite").parquet(folder)

    def _folded(self) -> tuple[int, set[str]]:
        """The newest complete fold, and the runs that are in it."""
        done = [int(n) for n in files.names_in(self.spark, f"{self.path}/folded") if files.is_complete(self.spark, f"{self.path}/folded/{n}")]
        if not done:
            return 0, set()
        newest = max(done)
        return newest, {r["run"] for r in self.spark.read.parquet(f"{self.path}/folds/{newest}").collect()}

    def _folders(self) -> list[str]:
        newest, within = self._folded()
        runs = [r for r in files.names_in(self.spark, f"{self.path}/runs") if r not in within and files.is_complete(self.spark, f"{self.path}/runs/{r}")]
        return [*([f"{self.path}/folded/{newest}"] if newest else []), *[f"{self.path}/runs/{r}" for r in runs]]

    def read(self) -> DataFrame | None:
        """All deltas; None if there are none yet."""
        folders = self._folders()
        return self.spark.read.parquet(*folders) if folders else None

    def fold(self) -> None:
        """Add the deltas of all runs up, so that reading costs what the mart holds and not how often it changed.

        The runs that a fold covers are noted before it is written, so one that broke off counts for nothing.
        """
        newest, within = self._folded()
        runs = within | {r for r in files.names_in(self.spark, f"{self.path}/runs") if files.is_complete(self.spark, f"{self.path}/runs/{r}")}
        if runs == within:
            return
        self.spark.createDataFrame([(r,) for r in sorted(runs)], "run string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/folds/{newest + 1}")
        sums = added(self.read(), self.mart)
        sums.where("_rows <> 0 or _amounts <> 0").write.mode("overwrite").parquet(f"{self.path}/folded/{newest + 1}")
        for run in runs:
            files.remove(self.spark, f"{self.path}/runs/{run}")
        files.remove(self.spark, f"{self.path}/folded/{newest}")
