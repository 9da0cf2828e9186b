"""Increments: loads of raw tables into keyed staging tables, and their changes into the marts.

For each feed (a raw table and the staging table that it goes into), a run takes in the loads that its
ledger lacks: late rows and rows with equal times included, since loads count and not times. All steps of
a run can be done again after a failure anywhere; see ``Ledger``, ``KeyedTable`` and ``Deltas``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.plans import deltas, marts, staging
from wayfare.sinks import files
from wayfare.sinks.keyed import KeyedTable
from wayfare.sinks.ledger import Ledger
from wayfare.sinks.loads import published_loads, read_loads
from wayfare.sources import schemas

ORDER_VERSION = "order_key long, after_record string, source_ts_ms long, ingested_at timestamp"


def as_kept(kept: DataFrame) -> DataFrame:
    return kept


@dataclass(frozen=True)
class Staged:
    """How a staging table is kept: its rows or what they are read off, by key and version."""

    schema: str
    keys: tuple[str, ...]
    version: tuple[str, ...]
    rows: Callable[[DataFrame], DataFrame] = as_kept


STAGED = {
    "stg_bookings_latest": Staged(schemas.STAGING["stg_bookings_latest"], ("booking_id",), staging.BOOKING_VERSION),
    "stg_ads_latest": Staged(schemas.STAGING["stg_ads_latest"], ("platform", "campaign_id"), ("loaded_at",)),
    # Change records are kept as they came, so that equal source times are decided as in a full build.
    "stg_orders": Staged(ORDER_VERSION, ("order_key",), ("source_ts_ms",), staging.order_rows),
    "stg_user_events": Staged(schemas.STAGING["stg_user_events"], ("event_id",), ("ingested_at",)),
}
#: Raw table -> staging table, and the versions that a raw row is.
FEEDS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "raw_bookings": ("stg_bookings_latest", lambda raw: raw.select(*staging.BOOKING_COLUMNS)),
    "raw_google_ads": ("stg_ads_latest", staging.ad_versions),
    "raw_meta_ads": ("stg_ads_latest", staging.ad_versions),
    "raw_cdc_orders": ("stg_orders", staging.order_versions),
    "raw_user_events": ("stg_user_events", lambda raw: raw.select(*staging.EVENT_COLUMNS)),
}


class Increments:
    """Staging tables and marts below ``root``, fed from the loads of the raw tables below ``raw``."""

    def __init__(self, spark: SparkSession, raw: str, root: str, buckets: int = 64):
        self.spark, self.raw, self.root, self.buckets = spark, raw.rstrip("/"), root.rstrip("/"), buckets

    def table(self, name: str) -> KeyedTable:
        kept = STAGED[name]
        return KeyedTable(f"{self.root}/staging/{name}", T.StructType.fromDDL(kept.schema), kept.keys, kept.version, self.buckets)

    def ledger(self, raw: str) -> Ledger:
        return Ledger(self.spark, f"{self.root}/ledger/{raw}")

    def new_rows(self, raw: str, loads: DataFrame) -> DataFrame:
        """The raw rows of some loads; the folders of other loads are not read."""
        return read_loads(self.spark, f"{self.raw}/{raw}", schemas.RAW[raw], loads)

    def take_in(self, raw: str) -> str | None:
        """Take in all loads of a raw table that are not yet in its staging table; the run's name, or None."""
        run = self.ledger(raw).open(published_loads(self.spark, f"{self.raw}/{raw}"))
        if run is None:
            return None
        name, versions = FEEDS[raw]
        changes = self.table(name).upsert(versions(self.new_rows(raw, run.loads)), run.name)
        fed = [mart for mart, spec in deltas.MARTS.items() if spec.staging == name]
        typed = self._typed_changes(name, changes, run.name) if fed else changes
        for mart in fed:
            self.deltas(mart).write(typed, run.name)
        self.ledger(raw).close(run)
        return run.name

    def _typed_changes(self, name: str, changes: DataFrame, run: str) -> DataFrame:
        """A run's changes as changes of staging rows, with what the marts read of them.

        If rows are read off what is kept, this is done once and written, not once for each mart.
        """
        used = deltas.columns_read(name, [f.name for f in self.staged(name).schema])
        typed = self._typed(changes, STAGED[name].rows, used)
        if STAGED[name].rows is as_kept:
            return typed
        folder = f"{self.table(name).run_folder(run)}/typed"
        if not files.is_complete(self.spark, folder):
            typed.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(typed.schema).parquet(folder)

    def _typed(self, changes: DataFrame, rows: Callable[[DataFrame], DataFrame], used: list[str]) -> DataFrame:
        """Changes of what is kept as changes of some columns of staging rows."""

        def side(name: str, other: str) -> DataFrame:
            found = rows(changes.where(F.col(name).isNotNull()).select(f"{name}.*")).select(*used)
            empty = F.lit(None).cast(found.schema)
            return found.select(F.struct(*found.columns).alias(name), empty.alias(other)).select("before", "after")

        return side("before", "after").unionByName(side("after", "before"))

    def deltas(self, mart: str) -> deltas.Deltas:
        return deltas.Deltas(self.spark, f"{self.root}/deltas", mart)

    def staged(self, name: str) -> DataFrame:
        """A staging table as it is declared."""
        return STAGED[name].rows(self.table(name).read(self.spark))

    def mart(self, name: str) -> DataFrame:
        """A mart from its deltas; rows of staging or raw tables are not read (but for the ads of the campaigns)."""
        found = self.deltas(name).read()
        if found is None:
            spec = deltas.MARTS[name]
            found = deltas.delta(deltas.signed(self._nothing(spec.staging)), spec)
        return deltas.finished(name, found, self.staged("stg_ads_latest") if name == "mart_campaign_performance" else None)

    def _nothing(self, name: str) -> DataFrame:
        row = self.staged(name).schema
        return self.spark.createDataFrame([], T.StructType([T.StructField("before", row), T.StructField("after", row)]))

    def conversion(self, by: str = "events") -> DataFrame:
        """The conversion mart from the deltas of the funnel."""
        if by not in ("events", "users"):
            raise ValueError(f"unknown counting unit {by!r}")
        return marts.conversion(self.mart("mart_user_event_funnel").select("event_type", F.col(f"{by}_count").alias("n")))

    def all_marts(self, conversion_by: str = "events") -> dict[str, DataFrame]:
        """Every mart of the platform."""
        found = {name: self.mart(name) for name in deltas.MARTS}
        found["mart_ad_performance"] = marts.mart_ad_performance(self.staged("stg_ads_latest"))
        found["mart_booking_conversion"] = self.conversion(conversion_by)
        return found


def refresh(inc: Increments, conversion_by: str = "events", fold: bool = False) -> dict[str, DataFrame]:
    """The daily refresh by loads: take in what each feed lacks, and return all staging tables and marts.

    It costs what came in: the loads, the buckets they touch and the marts' deltas. ``fold`` adds the deltas up, which is
    worth it after many runs.
    """
    for raw in FEEDS:
        inc.take_in(raw)
    if fold:
        for mart in deltas.MARTS:
            inc.deltas(mart).fold()
    return {name: inc.staged(name) for name in STAGED} | inc.all_marts(conversion_by)
