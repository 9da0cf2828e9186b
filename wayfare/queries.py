"""Every query by name: each takes the session and the folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.aggregates import money_avg, money_sum
from wayfare.operators import duplicate_keys, union_all
from wayfare.plans import audience, health, increments, marks, marts, metrics, quality, refresh, replay, staging, validation
from wayfare.session import configure, scratch_dir
from wayfare.sinks.ledger import Ledger
from wayfare.sinks.loads import published_loads, read_loads, write_load
from wayfare.sinks.writers import write_append, write_batch
from wayfare.sources import ingest, sample, tables
from wayfare.sources.sample import table
from wayfare.sources.schemas import DLQ, RAW, SORT_KEYS
from wayfare.sources.streams import stream_source
from wayfare.streaming.batches import read_batches
from wayfare.streaming.cdc_orders import start_cdc_orders
from wayfare.streaming.landing import booking_loads, start_landing
from wayfare.streaming.outcomes import (
    read_outcome_counts,
    read_outcome_windows,
    start_outcome_counts,
    start_outcome_windows,
)
from wayfare.streaming.user_events import start_user_events
from wayfare.streaming.versions import read_newest, start_versions

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

AS_OF = "2024-03-01 00:00:30"
EARLIER = "2024-02-20 12:00:00"
SPLIT_AT = "1998-01-01 00:00:00"
ONCE = {"availableNow": True}


def _plain_times(df: DataFrame) -> DataFrame:
    """Times without a zone (UTC), as the given tables have them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema
    ])


def query(function: Query) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        return _plain_times(function(configure(spark), root))

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    _QUERIES[function.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _google_meta(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return sample.raw_ads(spark, root, "google_ads"), sample.raw_ads(spark, root, "meta_ads")


def _raw(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    google, meta = _google_meta(spark, root)
    return {
        "raw_bookings": sample.raw_bookings(spark, root),
        "raw_google_ads": google,
        "raw_meta_ads": meta,
        "raw_cdc_orders": sample.raw_cdc_orders(spark, root),
        "raw_user_events": sample.raw_user_events(spark, root),
    }


# Staging


@query
def stg_bookings_latest(spark, root):
    return staging.stg_bookings_latest(sample.raw_bookings(spark, root))


@query
def stg_ads_latest(spark, root):
    return staging.stg_ads_latest(*_google_meta(spark, root))


@query
def stg_orders(spark, root):
    return staging.stg_orders(sample.raw_cdc_orders(spark, root))


@query
def stg_orders_legacy(spark, root):
    return staging.stg_orders(sample.raw_cdc_orders(spark, root), legacy=True)


@query
def stg_user_events(spark, root):
    return staging.stg_user_events(sample.raw_user_events(spark, root))


@query
def incremental_bookings(spark, root):
    """Valid versions newer than a staging table that was built some time ago."""
    raw = sample.raw_bookings(spark, root)
    staged = staging.stg_bookings_latest(staging.valid_bookings(raw.where(F.col("loaded_at") <= sample.ntz(SPLIT_AT))))
    return staging.new_bookings(raw, staged)


@query
def upsert_bookings(spark, root):
    """That staging table after the newer versions came in."""
    raw = sample.raw_bookings(spark, root)
    staged = staging.stg_bookings_latest(staging.valid_bookings(raw.where(F.col("loaded_at") <= sample.ntz(SPLIT_AT))))
    return staging.stg_bookings_incremental(raw, staged)


@query
def upsert_ads(spark, root):
    """First versions staged, then the second versions come in."""
    google, meta = _google_meta(spark, root)
    first = F.col("loaded_at") < sample.ntz("2024-01-03 00:00:00")
    staged = staging.stg_ads_latest(google.where(first), meta.where(first))
    return staging.stg_ads_incremental(google, meta, staged)


@query
def incremental_dlq_bookings(spark, root):
    """The dead letters of what came in after a staging table that was built some time ago."""
    raw = sample.raw_bookings(spark, root)
    staged = staging.stg_bookings_latest(staging.valid_bookings(raw.where(F.col("loaded_at") <= sample.ntz(SPLIT_AT))))
    return validation.new_dead_letters(raw, staged, AS_OF)


@query
def upsert_orders(spark, root):
    """Orders staged up to some source time, then the later changes come in."""
    raw = sample.raw_cdc_orders(spark, root)
    before = F.col("source_ts_ms") <= F.unix_millis(F.lit(SPLIT_AT).cast("timestamp"))
    staged = staging.stg_orders(raw.where(before))
    return staging.stg_orders_incremental(refresh.newer_changes(raw, staged), staged)


@query
def upsert_events(spark, root):
    """First copies staged, then the later copies come in."""
    raw = sample.raw_user_events(spark, root)
    staged = staging.stg_user_events(raw.where(F.col("ingested_at") < sample.ntz(sample.LATE_COPY)))
    return staging.stg_user_events_incremental(raw, staged)


# Marts


def _bookings(spark, root):
    return staging.stg_bookings_latest(sample.raw_bookings(spark, root))


def _ads(spark, root):
    return staging.stg_ads_latest(*_google_meta(spark, root))


def _orders(spark, root):
    return staging.stg_orders(sample.raw_cdc_orders(spark, root))


def _events(spark, root):
    return staging.stg_user_events(sample.raw_user_events(spark, root))


@query
def mart_daily_bookings(spark, root):
    return marts.mart_daily_bookings(_bookings(spark, root))


@query
def mart_route_revenue(spark, root):
    return marts.mart_route_revenue(_bookings(spark, root))


@query
def mart_booking_status(spark, root):
    return marts.mart_booking_status(_bookings(spark, root))


@query
def mart_ad_performance(spark, root):
    return marts.mart_ad_performance(_ads(spark, root))


@query
def mart_campaign_performance(spark, root):
    return marts.mart_campaign_performance(_ads(spark, root), _orders(spark, root))


@query
def mart_orders_status(spark, root):
    return marts.mart_orders_status(_orders(spark, root))


@query
def mart_route_revenue_from_orders(spark, root):
    return marts.mart_route_revenue_from_orders(_orders(spark, root))


@query
def mart_user_event_funnel(spark, root):
    return marts.mart_user_event_funnel(_events(spark, root))


@query
def mart_booking_conversion_events(spark, root):
    return marts.mart_booking_conversion(_events(spark, root))


@query
def mart_booking_conversion_users(spark, root):
    return marts.mart_booking_conversion(_events(spark, root), by="users")


# Data quality


@query
def dq_raw_bookings(spark, root):
    return quality.run_suite(sample.raw_bookings(spark, root), quality.RAW_BOOKINGS, AS_OF)


@query
def dq_stg_bookings(spark, root):
    return quality.run_suite(_bookings(spark, root), quality.STG_BOOKINGS, AS_OF)


@query
def dq_orders(spark, root):
    return quality.run_suite(_orders(spark, root), quality.STG_ORDERS, AS_OF)


@query
def dq_duplicate_keys(spark, root):
    """The booking versions that share key and run."""
    return duplicate_keys(sample.raw_bookings(spark, root), ["booking_id", "run_id"])


@query
def dq_model_tests(spark, root):
    """All declared column tests over freshly written models."""
    models = refresh.refresh(spark, _raw(spark, root), scratch_dir(spark, "models"))
    return refresh.model_test_results(models, AS_OF)


@query
def mart_dq_latest_results(spark, root):
    """Newest result per check, after the suites ran at two times."""
    raw = sample.raw_bookings(spark, root)
    history = [quality.run_suite(raw, quality.RAW_BOOKINGS, at) for at in (AS_OF, EARLIER)]
    history.append(quality.run_suite(_orders(spark, root), quality.STG_ORDERS, EARLIER))
    return marts.mart_dq_latest_results(union_all(*history))


@query
def dq_history(spark, root):
    """The history after the raw suite ran twice; each run is kept although it stopped on a failed check."""
    path = f"{scratch_dir(spark, 'dq')}/history"
    raw = sample.raw_bookings(spark, root)
    stopped = []
    for at in (EARLIER, AS_OF):
        try:
            quality.check_and_record(raw, quality.RAW_BOOKINGS, path, at)
        except quality.QualityError:
            stopped.append(at)
    return spark.read.parquet(path).withColumn("stopped", F.lit(len(stopped) == 2))


@query
def metric_route_revenue_model(spark, root):
    """A metric that is bound to a model."""
    return metrics.model_metric("route_revenue", {"mart_route_revenue": marts.mart_route_revenue(_bookings(spark, root))})


@query
def metric_booking_status_model(spark, root):
    """The other metric that is bound to a model."""
    models = {"mart_booking_status": marts.mart_booking_status(_bookings(spark, root))}
    return metrics.model_metric("booking_status_distribution", models)


# Validation and dead letters


@query
def bookings_valid(spark, root):
    valid, _ = validation.split_bookings(sample.raw_bookings(spark, root))
    return valid


@query
def dlq_bookings(spark, root):
    return validation.bookings_dead_letters(sample.raw_bookings(spark, root), AS_OF)


@query
def dlq_error_reasons(spark, root):
    return quality.error_reasons(validation.bookings_dead_letters(sample.raw_bookings(spark, root), AS_OF))


@query
def dlq_count(spark, root):
    letters = validation.bookings_dead_letters(sample.raw_bookings(spark, root), AS_OF)
    return metrics.question("How many records are in the DLQ?", {"dlq_bookings": letters})


@query
def last_load(spark, root):
    return quality.last_load(_bookings(spark, root))


@query
def bookings_ingested(spark, root):
    """Booking records as the interface delivers them, turned into raw rows."""
    records = sample.booking_records(spark, root).select(
        F.from_json("value", ingest.BOOKING_RECORD).alias("r"), "loaded_at", "run_id"
    )
    return ingest.ingest_bookings(
        records.select("r.*", F.col("loaded_at").alias("at"), F.col("run_id").alias("run")), F.col("run"), F.col("at")
    )


@query
def ads_validated(spark, root):
    return ingest.ingest_ads(sample.ad_messages(spark, root), "2024-01-04 00:00:00.123", mode="split")


@query
def ads_rejected(spark, root):
    """Refused campaign records with the fields that broke a rule."""
    bad = validation.refused(validation.check_ads(sample.ad_messages(spark, root)))
    return bad.select("value", F.array_join(F.col("violations.field"), ",").alias("fields"))


def _archived_calls(spark, root):
    return union_all(*[
        ingest.archive_payload(sample.ad_responses(spark, root, platform), platform, AS_OF)
        for platform in ("google_ads", "meta_ads")
    ])


@query
def ads_payload_archive(spark, root):
    """The campaigns of both platforms archived as calls, and taken out of the archive again."""
    record = (
        "platform string, campaign_id bigint, campaign_name string, impressions bigint, clicks bigint, spend double"
    )
    return ingest.unpack_payload(_archived_calls(spark, root), record)


@query
def ads_payload_rows(spark, root):
    """The archive's own rows, one per call: how many records each holds, and the first."""
    records = F.from_json("payload", "array<struct<campaign_id bigint>>")
    return _archived_calls(spark, root).select(
        "source",
        "endpoint",
        "fetched_at",
        F.size(records).cast("bigint").alias("n_records"),
        records[0]["campaign_id"].alias("first_campaign"),
    )


@query
def revenue_with_fine_prices(spark, root):
    """Line items as amounts with more than four decimals, summed per return flag."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    items = table(spark, root, "lineitem").select("l_returnflag", (charge / 7).alias("charge"))
    return items.groupBy("l_returnflag").agg(
        F.round(money_sum("charge"), 4).alias("revenue"), F.round(money_avg("charge"), 6).alias("mean_charge")
    )


@query
def events_valid(spark, root):
    checked = validation.validate_user_events(sample.incoming_events(spark, root))
    return validation.normalize_user_event(checked, ingested_at=F.col("ts"))


def _dead_letters(spark, root):
    checked = validation.validate_user_events(sample.incoming_events(spark, root))
    return validation.dead_letters(checked, failed_at=F.col("ts"))


def _stored(df: DataFrame, label: str) -> DataFrame:
    """A frame that is read more than once, written to the shared folder."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _reason(df: DataFrame) -> DataFrame:
    """Dead letters with the reason taken apart."""
    reason = F.from_json(
        "error_reason",
        "error_type string, error_details array<struct<field string, error string>>, ingested_at string",
    )
    return df.withColumn("_r", reason).select(
        "event_id",
        "raw_event",
        F.col("_r.error_type").alias("error_type"),
        F.array_join(F.col("_r.error_details.field"), ",").alias("fields"),
        "source_topic",
        "failed_at",
        "recovered",
        "replay_count",
    )


@query
def dlq_user_events(spark, root):
    return _reason(_dead_letters(spark, root))


def _aged_letters(spark, root):
    """The event dead letters after some time: a part recovered, a part tried before."""
    return _dead_letters(spark, root).withColumns(
        {
            "recovered": F.minute("failed_at") % 5 == 0,
            "replay_count": F.pmod(F.floor(F.second("failed_at")).cast("int"), F.lit(4)),
        }
    )


@query
def dlq_replay_candidates(spark, root):
    return replay.replay_candidates(_aged_letters(spark, root))


@query
def dlq_replay_messages(spark, root):
    """The messages a replay sends, field by field."""
    messages = replay.encode_for_replay(replay.replay_candidates(_aged_letters(spark, root)))
    fields = "event_id string, user_id bigint, event_type string, event_time string, properties string"
    return messages.select(F.from_json("value", fields).alias("m")).select("m.*")


@query
def dlq_after_replay(spark, root):
    """The dead letters after one replay into a folder."""
    base = scratch_dir(spark, "replay")
    _aged_letters(spark, root).write.parquet(f"{base}/dlq")
    after = replay.replay_dlq(spark.read.parquet(f"{base}/dlq"), f"{base}/topic", as_of=AS_OF)
    return after.select("event_id", "failed_at", "recovered", "replay_count", "replayed", "replayed_at")


@query
def dlq_lifecycle(spark, root):
    """The dead letters after two rounds of replay, one try each: marks are appended, letters stay."""
    base = scratch_dir(spark, "lifecycle")
    letters = _stored(_dead_letters(spark, root), "letters")
    for replay_id in ("first", "second"):
        marks.replay_round(letters, f"{base}/marks", f"{base}/outbox", f"{base}/topic", replay_id, AS_OF, max_replays=1)
    state = marks.with_state(letters, marks.read_marks(spark, f"{base}/marks"))
    return state.select("event_id", "failed_at", "recovered", "replay_count", "replayed", "replayed_at")


@query
def dlq_after_recovery(spark, root):
    """The dead letters after some of their events got through an hour later."""
    letters = _stored(_dead_letters(spark, root), "recovery")
    later = (F.col("failed_at") + F.expr("INTERVAL 1 HOUR")).alias("ingested_at")
    succeeded = letters.where(F.minute("failed_at") % 2 == 0).select("event_id", later)
    after = replay.apply_recoveries(letters, succeeded)
    return after.select("event_id", "failed_at", "recovered", "recovered_at")


@query
def cdc_raw_rows(spark, root):
    """Change messages as raw rows, the images represented by their status."""
    rows = ingest.cdc_to_raw(sample.change_messages(spark, root), ingested_at=sample.ORDERS_INGESTED)
    return rows.select(
        "order_id",
        "op",
        "source_ts_ms",
        F.get_json_object("before_record", "$.status").alias("before_status"),
        F.get_json_object("after_record", "$.status").alias("after_status"),
        "source_topic",
        "ingested_at",
    )


# Health


@query
def events_outcome_5m(spark, root):
    return health.outcome_counts(sample.outcome_events(spark, root))


@query
def events_outcome_5m_sliding(spark, root):
    return health.outcome_counts(sample.outcome_events(spark, root), slide=1)


@query
def consumer_backlog(spark, root):
    return health.consumer_backlog(sample.consumer_offsets(spark, root))


@query
def health_alerts(spark, root):
    outcomes = health.outcome_counts(sample.outcome_events(spark, root), slide=1)
    return health.alerts(outcomes, health.consumer_backlog(sample.sampled_offsets(spark, root)))


# Metrics and questions


@query
def metric_totals(spark, root):
    return metrics.metric(_bookings(spark, root), list(metrics.METRICS))


@query
def metric_by_dims(spark, root):
    return metrics.metric(_bookings(spark, root), list(metrics.METRICS), by=["transport_type", "currency"])


@query
def revenue_by_route(spark, root):
    return metrics.metric(_bookings(spark, root), "total_revenue", by=["route"])


@query
def revenue_by_transport_type(spark, root):
    return metrics.metric(_bookings(spark, root), "total_revenue", by=["transport_type"])


@query
def top_routes_by_revenue(spark, root):
    models = {"mart_route_revenue": marts.mart_route_revenue(_bookings(spark, root))}
    return metrics.question("What are the top routes?", models)


@query
def status_distribution(spark, root):
    models = {"mart_booking_status": marts.mart_booking_status(_bookings(spark, root))}
    return metrics.question("Show the status distribution", models)


@query
def paid_bookings_per_day(spark, root):
    models = {"mart_daily_bookings": marts.mart_daily_bookings(_bookings(spark, root))}
    return metrics.question("Paid bookings per day", models)


@query
def daily_overview(spark, root):
    models = {"mart_daily_bookings": marts.mart_daily_bookings(_bookings(spark, root))}
    return metrics.question("How is business?", models)


# Streams: the input is written as landing files, read by a stream, and the sink is returned.


@query
def stream_user_events(spark, root):
    """Valid events of the stream, then the newest copy of each."""
    base = scratch_dir(spark, "events")
    sample.incoming_events(spark, root).select("value").write.text(f"{base}/landing")
    start_user_events(
        stream_source(spark, "file", path=f"{base}/landing"),
        f"{base}/raw",
        f"{base}/dlq",
        f"{base}/checkpoint",
        metrics=f"{base}/metrics",
        trigger=ONCE,
    ).awaitTermination()
    raw = read_batches(spark, f"{base}/raw").drop("batch_id")
    return staging.stg_user_events(raw).drop("ingested_at")


@query
def stream_event_counters(spark, root):
    """What the event stream counts per batch, added up."""
    base = scratch_dir(spark, "counters")
    sample.incoming_events(spark, root).select("value").write.text(f"{base}/landing")
    start_user_events(
        stream_source(spark, "file", path=f"{base}/landing"),
        f"{base}/raw",
        f"{base}/dlq",
        f"{base}/checkpoint",
        metrics=f"{base}/metrics",
        trigger=ONCE,
    ).awaitTermination()
    names = ("received", "processed", "failed", "dlq")
    return read_batches(spark, f"{base}/metrics").groupBy("query").agg(*[F.sum(n).alias(n) for n in names])


@query
def stream_dead_letters(spark, root):
    """Refused events of the stream."""
    base = scratch_dir(spark, "letters")
    sample.incoming_events(spark, root).select("value").write.text(f"{base}/landing")
    start_user_events(
        stream_source(spark, "file", path=f"{base}/landing"),
        f"{base}/raw",
        f"{base}/dlq",
        f"{base}/checkpoint",
        trigger=ONCE,
    ).awaitTermination()
    return _reason(read_batches(spark, f"{base}/dlq")).drop("failed_at")


@query
def stream_cdc_orders(spark, root):
    """Order changes of the stream, then the current orders."""
    base = scratch_dir(spark, "orders")
    sample.change_messages(spark, root).write.text(f"{base}/landing")
    start_cdc_orders(
        stream_source(spark, "file", path=f"{base}/landing"),
        f"{base}/raw",
        f"{base}/checkpoint",
        metrics=f"{base}/metrics",
        trigger=ONCE,
    ).awaitTermination()
    return staging.stg_orders(read_batches(spark, f"{base}/raw"))


@query
def stream_outcome_5m(spark, root):
    """Outcome counts from the stream of outcomes."""
    base = scratch_dir(spark, "outcomes")
    outcomes = sample.outcome_events(spark, root)
    outcomes.write.parquet(f"{base}/landing")
    stream = spark.readStream.schema(outcomes.schema).parquet(f"{base}/landing")
    start_outcome_counts(stream, f"{base}/counts", f"{base}/checkpoint", trigger=ONCE).awaitTermination()
    return read_outcome_counts(spark, f"{base}/counts")


@query
def stream_upsert_bookings(spark, root):
    """Booking versions from a stream into a keyed table, newest first."""
    base = scratch_dir(spark, "bookings")
    raw = sample.raw_bookings(spark, root)
    raw.write.parquet(f"{base}/landing")
    stream = spark.readStream.schema(raw.schema).parquet(f"{base}/landing")
    key, version = ["booking_id"], staging.BOOKING_VERSION
    start_versions(stream, f"{base}/table", key, version, f"{base}/checkpoint", trigger=ONCE).awaitTermination()
    return read_newest(spark, f"{base}/table", key, version)


# Loads: the input is filed load by load, late rows among them, and each load is taken in as it comes.


def _booking_load() -> Column:
    """By which load a booking version comes: the later ones hold versions older than, as old as and newer than the first."""
    early = (F.col("loaded_at") <= sample.ntz(SPLIT_AT)) & (F.col("booking_id") % 7 != 3)
    return F.when(early, 1).when(F.col("booking_id") % 5 != 2, 2).otherwise(3)


def _order_load() -> Column:
    """Updates of even orders come before their first state, all others after it."""
    return F.when((F.col("op") == "u") == (F.col("order_id") % 2 == 0), 1).otherwise(2)


def _event_load() -> Column:
    return F.when(F.col("event_id").cast("long") % 3 == 0, 2).otherwise(1)


def _filed(spark, rows: DataFrame, name: str, base: str, load: Column, last: int):
    """File the loads of a raw table one after the other; yields after each."""
    rows = tables.conform(rows, name).withColumn("_load", load)
    rows = _stored(rows, name)
    for number in range(1, last + 1):
        one = rows.where(F.col("_load") == number).drop("_load")
        write_load(one, f"{base}/{name}", f"load-{number}", f"2024-03-0{number}", SORT_KEYS[name])
        yield number


def _taken_in(spark, root, *names: str) -> increments.Increments:
    """Staging tables and deltas after all loads of the named raw tables were taken in, each when it came."""
    base = scratch_dir(spark, "loads")
    inc = increments.Increments(spark, f"{base}/raw", f"{base}/out", buckets=8)
    google, meta = _google_meta(spark, root)
    raw = {
        "raw_bookings": (sample.raw_bookings(spark, root), _booking_load(), 3),
        "raw_google_ads": (google, F.lit(1), 1),
        "raw_meta_ads": (meta, F.lit(1), 1),
        "raw_cdc_orders": (sample.raw_cdc_orders(spark, root), _order_load(), 2),
        "raw_user_events": (sample.raw_user_events(spark, root), _event_load(), 2),
    }
    for name in names:
        rows, load, last = raw[name]
        for _ in _filed(spark, rows, name, inc.raw, load, last):
            inc.take_in(name)
    return inc


def _long(mart: str, df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """A mart as rows of (mart, key, measure, value)."""
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    rows = F.array(*[F.struct(F.lit(m).alias("measure"), F.round(F.col(m).cast("double"), 6).alias("value")) for m in measures])
    return df.select(F.lit(mart).alias("mart"), key.alias("key"), F.inline(rows))


@query
def loads_taken_in(spark, root):
    """Every booking version with the load that it came by and the run that took it in; one run broke off and was taken up."""
    base = scratch_dir(spark, "ledger")
    ledger = Ledger(spark, f"{base}/ledger")
    path = f"{base}/raw/raw_bookings"
    runs = []
    for number in _filed(spark, sample.raw_bookings(spark, root), "raw_bookings", f"{base}/raw", _booking_load(), 3):
        for attempt in (1, 2):
            run = ledger.open(published_loads(spark, path))
            if run is None:
                continue
            rows = read_loads(spark, path, RAW["raw_bookings"], run.loads)
            rows.write.mode("overwrite").parquet(f"{base}/taken/run={run.name}")
            if run.name not in runs:
                runs.append(run.name)
            if not (number == 2 and attempt == 1):
                ledger.close(run)
    place = F.array_position(F.array(*[F.lit(r) for r in runs]), F.col("run"))
    taken = spark.read.parquet(f"{base}/taken")
    return taken.select("booking_id", "run_id", "loaded_at", "price", "load_id", place.cast("int").alias("taken_in"))


@query
def loads_stg_bookings(spark, root):
    """The newest version of each booking after three loads, each folded into the buckets that it touches."""
    return _taken_in(spark, root, "raw_bookings").staged("stg_bookings_latest")


@query
def loads_stg_orders(spark, root):
    """The current orders, although their updates came first."""
    return _taken_in(spark, root, "raw_cdc_orders").staged("stg_orders")


@query
def delta_booking_marts(spark, root):
    """The booking marts, kept up by what each load changed."""
    inc = _taken_in(spark, root, "raw_bookings")
    return union_all(
        _long("daily", inc.mart("mart_daily_bookings"), ["booking_date"], ["total_bookings", "paid_bookings", "created_bookings", "cancelled_bookings", "total_revenue"]),
        _long("route", inc.mart("mart_route_revenue"), ["route", "transport_type"], ["total_bookings", "paid_bookings", "total_revenue"]),
        _long("status", inc.mart("mart_booking_status"), ["status"], ["total_bookings"]),
    )


@query
def delta_order_marts(spark, root):
    """The marts over orders, kept up by what each load changed."""
    inc = _taken_in(spark, root, "raw_google_ads", "raw_meta_ads", "raw_cdc_orders")
    return union_all(
        _long("status", inc.mart("mart_orders_status"), ["status"], ["orders_count", "total_revenue"]),
        _long("route", inc.mart("mart_route_revenue_from_orders"), ["route"], ["orders_count", "total_revenue", "avg_order_value"]),
        _long("campaign", inc.mart("mart_campaign_performance"), ["platform", "campaign_id"], ["spend", "bookings", "revenue", "cpa", "roas"]),
    )


@query
def delta_event_marts(spark, root):
    """Funnel and conversion, kept up by what each load changed; the deltas were folded."""
    inc = _taken_in(spark, root, "raw_user_events")
    inc.deltas("mart_user_event_funnel").fold()
    return union_all(
        _long("funnel", inc.mart("mart_user_event_funnel"), ["event_type"], ["users_count", "events_count"]),
        _long("by events", inc.conversion("events"), ["metric"], ["value"]),
        _long("by users", inc.conversion("users"), ["metric"], ["value"]),
    )


@query
def audience_rolling_week(spark, root):
    """Distinct users of each event type in the seven days up to each day, from stored bitmaps of days."""
    path = f"{scratch_dir(spark, 'audience')}/users"
    audience.write_days(audience.daily_users(_events(spark, root)), path)
    return audience.rolling_users(audience.read_days(spark, path), 7)


@query
def alert_episodes(spark, root):
    """Alerts as episodes with their peaks."""
    outcomes = health.outcome_counts(sample.outcome_events(spark, root), slide=1)
    return health.episodes(outcomes, health.consumer_backlog(sample.sampled_offsets(spark, root)))


@query
def dq_every_key(spark, root):
    """Several uniqueness keys of the raw bookings and other checks, in one shuffle."""
    checks = (
        quality.not_empty("rows"),
        quality.unique("booking and run", "booking_id", "run_id"),
        quality.unique("booking", "booking_id"),
        quality.unique("user and load", "user_id", "loaded_at"),
        quality.no_rows_where("negative prices", "price < 0"),
        quality.fresh("freshness"),
    )
    return quality.run_suite(sample.raw_bookings(spark, root), checks, AS_OF)


@query
def sink_appended(spark, root):
    """Valid bookings appended in two batches, and one without rows that writes nothing."""
    path = f"{scratch_dir(spark, 'append')}/bookings"
    valid, _ = validation.split_bookings(sample.raw_bookings(spark, root))
    for part in (F.col("booking_id") % 2 == 0, F.col("booking_id") % 2 == 1, F.lit(False)):
        write_append(valid.where(part), path)
    return spark.read.parquet(path)


@query
def stream_outcome_windows(spark, root):
    """Sliding outcome counts kept in the state store, with the late events; the newer half of the events came first."""
    base = scratch_dir(spark, "windows")
    outcomes = _stored(sample.outcome_events(spark, root), "outcomes")
    middle = outcomes.agg(F.timestamp_seconds(F.avg(F.unix_seconds(F.col("ts").cast("timestamp"))).cast("long")).cast("timestamp_ntz")).first()[0]
    for newer in (True, False):
        half = outcomes.where((F.col("ts") >= F.lit(middle)) == newer)
        half.write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(outcomes.schema).parquet(f"{base}/landing")
        start_outcome_windows(stream, f"{base}/counts", f"{base}/late", f"{base}/checkpoint", trigger=ONCE).awaitTermination()
    return read_outcome_windows(spark, f"{base}/counts", late=f"{base}/late")


@query
def stream_after_failures(spark, root):
    """Valid events of a stream whose first writes fail after they wrote: tried again, each is there once."""
    base = scratch_dir(spark, "failures")
    sample.incoming_events(spark, root).select("value").write.text(f"{base}/landing")
    failures = [OSError("store is away")] * 2

    def flaky(rows, path, batch_id):
        write_batch(rows, path, batch_id)
        if failures:
            raise failures.pop()

    start_user_events(
        stream_source(spark, "file", path=f"{base}/landing"), f"{base}/raw", f"{base}/dlq", f"{base}/checkpoint",
        trigger=ONCE, write=flaky, sleep=lambda seconds: None,
    ).awaitTermination()
    return staging.stg_user_events(read_batches(spark, f"{base}/raw").drop("batch_id")).drop("ingested_at")


@query
def stream_fallback_letters(spark, root):
    """Refused events of a stream whose dead letters cannot be filed: they lie in the fallback folder."""
    base = scratch_dir(spark, "fallback")
    sample.incoming_events(spark, root).select("value").write.text(f"{base}/landing")

    def no_letters(rows, path, batch_id):
        if path.endswith("/dlq"):
            raise OSError("dead letters cannot be written")
        write_batch(rows, path, batch_id)

    start_user_events(
        stream_source(spark, "file", path=f"{base}/landing"), f"{base}/raw", f"{base}/dlq", f"{base}/checkpoint",
        fallback=f"{base}/fallback", trigger=ONCE, write=no_letters, sleep=lambda seconds: None,
    ).awaitTermination()
    return _reason(spark.read.schema(DLQ["dlq_user_events"]).json(f"{base}/fallback")).drop("failed_at")


@query
def landing_bookings(spark, root):
    """Booking files taken in as loads; the second run finds only the files that came meanwhile, the third none."""
    base = scratch_dir(spark, "landing")
    records = _stored(sample.booking_records(spark, root).select("value"), "records")
    for first in (True, False, None):
        if first is not None:
            records.where((F.xxhash64("value") % 2 == 0) == first).write.mode("append").text(f"{base}/in")
        start_landing(spark, f"{base}/in", f"{base}/raw", booking_loads, f"{base}/checkpoint", trigger=ONCE).awaitTermination()
    rows = read_loads(spark, f"{base}/raw/raw_bookings", RAW["raw_bookings"])
    return rows.select("booking_id", "user_id", "route", "transport_type", "status", "price", "currency", "created_at")


@query
def landing_json_rows(spark, root):
    """Booking records read from JSON files under their declared schema."""
    path = f"{scratch_dir(spark, 'json')}/records"
    sample.booking_records(spark, root).select("value").write.text(path)
    return tables.read_json_rows(spark, path, ingest.BOOKING_RECORD).drop("created_at")
