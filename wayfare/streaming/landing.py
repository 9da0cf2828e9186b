"""Landing files read once: each batch of new files is a load of its raw tables.

The checkpoint keeps the log of files that were read, so a file counts once whatever its rows hold, and a restart goes on
with the files that are new. Read files can be moved to an archive.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfare.functions.lenient import settle
from wayfare.plans.validation import check_ads, refused
from wayfare.sinks.loads import write_load
from wayfare.sources.ingest import BOOKING_RECORD, archive_payload, ingest_ads, ingest_bookings, unreadable_bookings
from wayfare.sources.schemas import SORT_KEYS
from wayfare.streaming.batches import start, with_backoff

#: Turns the lines of a load (``value``), its id and its time into rows of raw tables.
Prepare = Callable[[DataFrame, str, datetime], dict[str, DataFrame]]


def open_bookings(lines: DataFrame) -> DataFrame:
    """Lines with ``_readable`` and, if they are JSON objects, the booking record ``_record``; each is parsed once."""
    readable = F.col("value").rlike(r"^\s*\{") & F.try_parse_json("value").isNotNull()
    marked = settle(lines, _readable=readable)
    return settle(marked, _record=F.when(F.col("_readable"), F.from_json("value", BOOKING_RECORD)))


def booking_loads(lines: DataFrame, load_id: str, at: datetime) -> dict[str, DataFrame]:
    """Booking records, one JSON object a line; the load is their run. Other lines and unreadable creation times go to the dead letters."""
    opened = lines if "_record" in lines.columns else open_bookings(lines)
    records = opened.where("_readable").select("_record.*")
    torn = opened.where("not _readable").select(
        F.lit(None).cast("long").alias("booking_id"), F.col("value").alias("raw_record"), F.lit("not a JSON object").alias("error_reason"), F.lit(at).cast("timestamp").alias("failed_at")
    )
    return {"raw_bookings": ingest_bookings(records, load_id, at), "dlq_bookings": unreadable_bookings(records, at).unionByName(torn)}


#: What is kept of the lines of a load while its tables are filed: they are parsed once for all of them.
booking_loads.opened = open_bookings


def ad_loads(platform: str) -> Prepare:
    """Answers of the advertising interface, a JSON array or object a line: archived as they came, and their valid records."""

    def prepare(lines: DataFrame, load_id: str, at: datetime) -> dict[str, DataFrame]:
        every = F.coalesce(F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>"), F.array(F.try_parse_json("value")))
        records = lines.select(F.explode(every).alias("record")).where("record is not null").select(F.to_json("record").alias("value"))
        return {
            "raw_ads_api_payloads": archive_payload(lines, platform, at),
            f"raw_{platform}": ingest_ads(records, at, mode="split"),
            f"refused_{platform}": refused(check_ads(records)).select("value", F.array_join("violations.field", ",").alias("fields")),
        }

    return prepare


def start_landing(
    spark: SparkSession,
    landing: str,
    raw: str,
    prepare: Prepare,
    checkpoint: str,
    *,
    at: datetime | None = None,
    archive: str | None = None,
    files_per_load: int | None = None,
    trigger: dict | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> StreamingQuery:
    """Start the query that takes new files below ``landing`` into loads of the raw tables below ``raw``.

    With the trigger ``availableNow`` it reads what is there and ends. A repeated batch has the same load id: a table that it has
    filed already keeps it as it is. If ``prepare`` has a function ``opened``, the lines are kept as it returns them. ``at`` is the time of arrival, by default that of the batch.
    """
    reader = spark.readStream.format("text")
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_load is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_load)

    opened = getattr(prepare, "opened", lambda lines: lines)

    def handle(batch: DataFrame, load_id: str) -> None:
        arrived = at or datetime.now().replace(microsecond=0)
        lines = opened(batch.select("value").where("trim(value) <> ''")).persist()
        try:
            for name, rows in prepare(lines, load_id, arrived).items():
                keys = SORT_KEYS.get(name, ())
                with_backoff(lambda: write_load(rows, f"{raw.rstrip('/')}/{name}", load_id, _day(arrived), keys), sleep=sleep)
        finally:
            lines.unpersist()

    return start(reader.load(landing), handle, checkpoint, trigger)


def _day(at: datetime) -> date:
    return at.date()
