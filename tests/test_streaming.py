"""Streams: same result as the batch functions, no duplicates after a restart, failures contained."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wayfare.plans import health, replay, staging, validation
from wayfare.sinks import writers
from wayfare.sources import ingest, schemas, tables
from wayfare.sources.streams import stream_source
from wayfare.streaming import batches
from wayfare.streaming.cdc_orders import start_cdc_orders
from wayfare.streaming.outcomes import read_outcome_counts, start_outcome_counts
from wayfare.streaming.user_events import start_user_events
from wayfare.streaming.versions import compact, read_newest, start_versions

ONCE = {"availableNow": True}
T0 = datetime(2024, 1, 1)


def uid(n):
    return f"00000000-0000-4000-8000-{n:012d}"


def event(n, route="x", **changes):
    return json.dumps(
        {
            "event_id": uid(n), "user_id": n, "event_type": "booking_started", "event_time": "2024-01-01T00:00:00Z",
            "properties": json.dumps({"route": route}), **changes,
        }
    )


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(lines) + "\n")


class Places:
    def __init__(self, base):
        self.landing = base / "landing"
        self.raw, self.dlq, self.checkpoint = (str(base / name) for name in ("raw", "dlq", "checkpoint"))
        self.metrics, self.fallback = (str(base / name) for name in ("metrics", "fallback"))


def run_events(spark, places, **options):
    stream = stream_source(spark, "file", path=str(places.landing), maxFilesPerTrigger="1")
    query = start_user_events(
        stream, places.raw, places.dlq, places.checkpoint,
        metrics=places.metrics, fallback=places.fallback,
        trigger=ONCE, sleep=lambda seconds: None, **options,
    )
    query.awaitTermination()


def test_events_are_routed_and_a_restart_adds_nothing(spark, tmp_path, rows):
    places = Places(tmp_path)
    land(places.landing, "a", [event(1), event(2, user_id="no"), "{torn"])
    land(places.landing, "b", [event(1), event(3), event(2)])
    run_events(spark, places)
    run_events(spark, places)
    raw = batches.read_batches(spark, places.raw).drop("batch_id")
    assert rows(raw, "event_id") == [(uid(1),), (uid(1),), (uid(2),), (uid(3),)]
    dlq = batches.read_batches(spark, places.dlq).drop("batch_id")
    assert rows(dlq, "event_id") == [(uid(2),), (None,)]
    land(places.landing, "c", [event(4)])
    run_events(spark, places)
    raw = tables.conform(batches.read_batches(spark, places.raw), "raw_user_events")
    assert raw.count() == 5 and staging.stg_user_events(raw).count() == 4
    counts = batches.read_batches(spark, places.metrics).agg(F.sum("received"), F.sum("processed"), F.sum("dlq"))
    assert tuple(counts.head()) == (7, 5, 2)
    # the refused event got through later
    after = replay.apply_recoveries(dlq, batches.read_batches(spark, places.raw))
    assert rows(after, "event_id", "recovered") == [(uid(2), True), (None, False)]


def test_stream_equals_batch(spark, tmp_path, rows):
    places = Places(tmp_path)
    lines = [event(n, properties="{" if n % 5 == 0 else {"route": "r"}, user_id=n if n % 7 else None) for n in range(60)]
    for part in range(3):
        land(places.landing, f"p{part}", lines[part::3])
    run_events(spark, places, arrived_at=None)
    checked = validation.validate_user_events(spark.read.text(str(places.landing)))
    columns = ("event_id", "user_id", "event_type", "event_time", "properties")
    assert rows(batches.read_batches(spark, places.raw), *columns) == rows(validation.normalize_user_event(checked), *columns)
    assert rows(batches.read_batches(spark, places.dlq), "event_id", "raw_event") == rows(
        validation.dead_letters(checked), "event_id", "raw_event"
    )


def test_a_failing_write_is_tried_again_and_files_each_row_once(spark, tmp_path, rows):
    places = Places(tmp_path)
    land(places.landing, "a", [event(1), event(2)])
    failures = iter([True, True, False, False, False])

    def flaky(df, path, batch_id):
        writers.write_batch(df, path, batch_id)
        if next(failures):
            raise OSError("store is away")

    run_events(spark, places, write=flaky)
    assert rows(batches.read_batches(spark, places.raw), "event_id") == [(uid(1),), (uid(2),)]


def test_dead_letters_fall_back_to_json_lines(spark, tmp_path):
    places = Places(tmp_path)
    land(places.landing, "a", [event(1), "{torn"])

    def no_dlq(df, path, batch_id):
        if path == places.dlq:
            raise OSError("dead letters cannot be written")
        writers.write_batch(df, path, batch_id)

    run_events(spark, places, write=no_dlq)
    kept = spark.read.schema(schemas.schema("dlq_user_events")).json(places.fallback)
    assert [r.raw_event for r in kept.collect()] == ["{torn"]
    assert batches.read_batches(spark, places.raw).count() == 1


def test_a_lasting_failure_ends_the_query_and_the_restart_repeats_the_batch(spark, tmp_path, rows):
    places = Places(tmp_path)
    land(places.landing, "a", [event(1)])

    def down(df, path, batch_id):
        raise OSError("store is away")

    with pytest.raises(Exception, match="store is away"):
        run_events(spark, places, write=down)
    run_events(spark, places)
    assert rows(batches.read_batches(spark, places.raw), "event_id") == [(uid(1),)]


def test_back_off_doubles_up_to_the_cap():
    waits = []

    def never():
        raise OSError

    with pytest.raises(OSError):
        batches.with_backoff(never, attempts=7, sleep=waits.append)
    assert waits == [2, 4, 8, 16, 30, 30]


def test_replayed_letters_come_back_through_the_stream(spark, tmp_path, rows):
    places = Places(tmp_path)
    land(places.landing, "a", [event(1, event_time="broken"), event(2, properties="{")])
    run_events(spark, places)
    dlq = tables.conform(batches.read_batches(spark, places.dlq), "dlq_user_events")
    fixed = dlq.withColumn("raw_event", F.regexp_replace("raw_event", "broken", "2024-01-01T00:00:00Z"))
    after = replay.replay_dlq(fixed, str(places.landing), as_of=T0)
    table = str(tmp_path / "table")
    writers.write_full_refresh(after, table)
    assert rows(spark.read.parquet(table), "event_id", "replay_count") == [(uid(1), 1), (uid(2), 1)]
    run_events(spark, places)
    assert rows(batches.read_batches(spark, places.raw), "event_id") == [(uid(1),)]
    recovered = replay.apply_recoveries(spark.read.parquet(table), batches.read_batches(spark, places.raw))
    assert rows(recovered, "event_id", "recovered") == [(uid(1), True), (uid(2), False)]


def change(op, n, status, ts):
    return json.dumps({"op": op, "before": None, "after": {"order_id": n, "status": status}, "ts_ms": ts})


def test_order_changes(spark, tmp_path, rows):
    landing, raw, metrics, checkpoint = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "m"), str(tmp_path / "c")
    land(landing, "a", [change("c", 1, "paid", 1), "{torn", change("u", 1, "completed", 3)])
    land(landing, "b", [change("u", 1, "late", 2), change("r", 2, "paid", 1)])
    for _ in range(2):
        stream = stream_source(spark, "file", path=str(landing), maxFilesPerTrigger="1")
        start_cdc_orders(stream, raw, checkpoint, metrics=metrics, trigger=ONCE).awaitTermination()
    changes = batches.read_batches(spark, raw)
    assert changes.count() == 4
    assert rows(staging.stg_orders(changes), "order_id", "status") == [(1, "completed"), (2, "paid")]
    counts = batches.read_batches(spark, metrics)
    assert tuple(counts.agg(F.sum("received"), F.sum("processed"), F.sum("failed")).head()) == (5, 4, 1)


def test_keyed_table_from_a_stream(spark, tmp_path, rows):
    landing, table = tmp_path / "in", str(tmp_path / "table")
    land(landing, "a", ['{"k":1,"v":1,"x":"old"}', '{"k":1,"v":3,"x":"new"}'])
    land(landing, "b", ['{"k":1,"v":2,"x":"late"}', '{"k":2,"v":1,"x":"only"}'])
    schema = "k long, v long, x string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(landing))
    start_versions(stream, table, ["k"], ["v"], str(tmp_path / "c"), trigger=ONCE).awaitTermination()
    assert rows(read_newest(spark, table, ["k"], ["v"])) == [(1, 3, "new"), (2, 1, "only")]
    compact(spark, table, str(tmp_path / "compact"), ["k"], ["v"])
    assert rows(spark.read.parquet(str(tmp_path / "compact"))) == [(1, 3, "new"), (2, 1, "only")]


def outcomes(spark, *rows_):
    return spark.createDataFrame(
        [(T0 + timedelta(seconds=seconds), outcome) for seconds, outcome in rows_], "ts timestamp, outcome string"
    )


def test_late_outcomes_count_in_the_filed_counts(spark, tmp_path, rows):
    landing = str(tmp_path / "in")
    first = outcomes(spark, (0, "failed"), (9000, "processed"))
    late = outcomes(spark, (1, "failed"), (299, "failed"), (300, "failed"))
    first.coalesce(1).write.parquet(landing)
    stream = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    start_outcome_counts(stream, str(tmp_path / "n"), str(tmp_path / "c"), trigger=ONCE).awaitTermination()
    late.coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    start_outcome_counts(stream, str(tmp_path / "n"), str(tmp_path / "c"), trigger=ONCE).awaitTermination()
    counts = read_outcome_counts(spark, str(tmp_path / "n"))
    assert rows(counts) == rows(health.outcome_counts(first.unionByName(late)))
    assert counts.where("window_start = timestamp'2024-01-01 00:00:00'").head().events_count == 3


def test_a_fresh_checkpoint_replaces_nothing(spark, tmp_path):
    landing, counts = str(tmp_path / "in"), str(tmp_path / "n")
    for name, events in (("c1", [(0, "failed"), (1, "failed")]), ("c2", [(2, "dlq")])):
        outcomes(spark, *events).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema("ts timestamp, outcome string").parquet(landing)
        start_outcome_counts(stream, counts, str(tmp_path / name), trigger=ONCE).awaitTermination()
    # The second query reads all events from the start; the first one's counts stay.
    totals = {r.outcome: r.events_count for r in read_outcome_counts(spark, counts).collect()}
    assert totals == {"failed": 4, "dlq": 1}
    assert len({r.batch_id for r in batches.read_batches(spark, counts).collect()}) == 2


def test_a_table_without_batches_is_empty(spark, tmp_path):
    empty = batches.read_batches(spark, str(tmp_path / "none"), "event_id string")
    assert empty.columns == ["event_id", "batch_id"] and empty.count() == 0
    with pytest.raises(AnalysisException):
        batches.read_batches(spark, str(tmp_path / "none"))


def test_sliding_counts_equal_the_built_in_windows(spark, rows):
    frame = outcomes(spark, *[(n * 37, "failed" if n % 3 else "dlq") for n in range(200)])
    window = F.window("ts", "5 minutes", "1 minute")
    plain = frame.groupBy(window.alias("w"), "outcome").agg(F.count("*").alias("n")).select("w.start", "w.end", "outcome", "n")
    assert rows(health.outcome_counts(frame, slide=1)) == rows(plain)
    with pytest.raises(ValueError):
        health.outcome_counts(frame, minutes=5, slide=2)


def test_alerts_need_the_condition_to_hold(spark, rows):
    minute = timedelta(minutes=1)
    windows = [(0, 1), (1, 2), (2, 0), (3, 5), (5, 1), (6, 1), (7, 1)]
    counts = spark.createDataFrame(
        [(T0 + n * minute, T0 + (n + 5) * minute, "failed", value) for n, value in windows] + [(T0, T0 + 5 * minute, "dlq", 9)],
        "window_start timestamp, window_end timestamp, outcome string, events_count long",
    )
    offsets = spark.createDataFrame(
        [("slow", p, T0 + n * minute, 1000, 1000 - lag) for n, lag in enumerate((51, 51, 51, 50, 51)) for p in (0, 1)]
        + [("fast", 0, T0 + n * minute, 10, 9) for n in range(5)],
        "consumer_group string, partition_id int, sampled_at timestamp, end_offset long, committed_offset long",
    )
    fired = health.alerts(counts, health.consumer_backlog(offsets))
    assert rows(fired, "alert", "subject", "fired_at", "value") == sorted(
        [
            ("kafka-consumer-lag-high", "slow", T0 + 2 * minute, 102),
            ("user-events-failed-last-5m", "user_events", T0 + 6 * minute, 2),
            ("user-events-failed-last-5m", "user_events", T0 + 11 * minute, 1),
            ("user-events-failed-last-5m", "user_events", T0 + 12 * minute, 1),
        ],
        key=repr,
    )


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        stream_source(spark, "socket")


def test_writers(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(2, "b"), (1, "a")], "k long, x string")
    assert writers.write_append(frame, path) and not writers.write_append(frame.limit(0), path)
    assert writers.write_append(frame, path, ["x", "k"])
    assert spark.read.parquet(path).count() == 4
    # a refresh may read the table it replaces
    writers.write_full_refresh(spark.read.parquet(path).distinct(), path, ["k"])
    assert [tuple(r) for r in spark.read.parquet(path).select("k", "x").collect()] == [(1, "a"), (2, "b")]
    writers.write_sorted(frame, str(tmp_path / "s"), ["k"], ranges=True)
    assert rows(spark.read.parquet(str(tmp_path / "s"))) == [(1, "a"), (2, "b")]


def test_declared_tables(spark, tmp_path):
    root = str(tmp_path)
    frame = spark.createDataFrame([(1, "paid")], "total_bookings int, status string")
    writers.write_table(frame, "mart_booking_status", root)
    assert tables.read_table(spark, "mart_booking_status", root).schema == schemas.schema("mart_booking_status")
    frame.drop("status").write.mode("overwrite").parquet(f"{root}/mart_booking_status")
    with pytest.raises(ValueError, match="status"):
        tables.read_table(spark, "mart_booking_status", root)
    assert all(schemas.SORT_KEYS[name] for name in schemas.tables())
    assert ingest.BOOKING_RECORD.count("string") == 5
