"""Alert episodes, audience bitmaps, uniqueness in one shuffle, the stateful outcome stream, landing files."""

import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wayfare.operators.islands import islands
from wayfare.plans import audience, health, quality
from wayfare.sinks import files, loads
from wayfare.sources import schemas
from wayfare.streaming import landing
from wayfare.streaming.batches import read_batches
from wayfare.streaming.outcomes import read_late, read_outcome_windows, start_outcome_windows

ONCE = {"availableNow": True}
T0 = datetime(2024, 1, 1)
MINUTE = timedelta(minutes=1)


# Episodes


def test_islands_equal_a_plain_walk(spark, rows):
    pick = random.Random(4)
    points = [(pick.choice(["a", "b", None]), T0 + timedelta(hours=23, minutes=pick.randrange(140)), pick.randrange(9)) for _ in range(260)]
    points += [("long", T0 + n * MINUTE, n % 7) for n in range(4000)] + [("a", None, 99)]
    got = rows(islands(spark.createDataFrame(points, "k string, at timestamp, v int"), ["k"], "at", 60, {"peak": F.max("v")}))
    wanted = []
    for key in {p[0] for p in points}:
        best = {}
        for k, at, v in points:
            if k == key and at is not None:
                best[at] = max(v, best.get(at, v))
        run = []
        for at in sorted(best):
            if run and at - run[-1] > MINUTE:
                wanted.append((key, run[0], run[-1], len(run), max(best[x] for x in run)))
                run = []
            run.append(at)
        wanted.append((key, run[0], run[-1], len(run), max(best[x] for x in run)))
    assert got == sorted(wanted, key=repr)


def test_episodes_end_without_data_and_need_their_time(spark, rows):
    windows = [(0, 1), (1, 2), (2, 0), (3, 5), (5, 1), (6, 4), (7, 1)]
    counts = spark.createDataFrame(
        [(T0 + (n - 5) * MINUTE, T0 + n * MINUTE, "failed", value) for n, value in windows],
        "window_start timestamp, window_end timestamp, outcome string, events_count long",
    )
    # Two runs over a minute without a sample, the second one too short to fire.
    backlog = spark.createDataFrame(
        [("slow", T0 + n * MINUTE, 100 + n) for n in (1, 2, 3, 5, 6)] + [("fast", T0 + n * MINUTE, 100) for n in range(9)],
        "consumer_group string, sampled_at timestamp, backlog long",
    )
    found = health.episodes(counts, backlog)
    assert rows(found, "subject", "pending_at", "fired_at", "resolved_at", "minutes", "peak") == sorted(
        [
            ("user_events", T0, T0 + MINUTE, T0 + 2 * MINUTE, 2, 2),
            ("user_events", T0 + 5 * MINUTE, T0 + 6 * MINUTE, T0 + 8 * MINUTE, 3, 4),
            ("slow", T0 + MINUTE, T0 + 3 * MINUTE, T0 + 4 * MINUTE, 3, 103),
        ],
        key=repr,
    )
    # An episode fires in every minute from fired_at until it is resolved.
    fired = health.alerts(counts, backlog).count()
    assert fired == sum((r.resolved_at - r.fired_at) // MINUTE for r in found.collect())


# Audience


def events(spark, rows_):
    full = [(str(n), user, kind, at, "{}", "t", T0) for n, (user, kind, at) in enumerate(rows_)]
    return spark.createDataFrame(full, schemas.schema("raw_user_events"))


def random_events(pick, n=400):
    users = [None, 0, 1, 32767, 32768, 70000, 1 << 40, -5, *range(100, 130)]
    return [(pick.choice(users), pick.choice(["a", "b", None]), pick.choice([None, T0 + timedelta(days=pick.randrange(12), hours=pick.randrange(24))])) for _ in range(n)]


def test_any_range_of_days_is_answered_from_bitmaps(spark, tmp_path, rows):
    path, every = str(tmp_path / "users"), random_events(random.Random(1))
    audience.write_days(audience.daily_users(events(spark, every)), path)
    for first, last in (("2024-01-03", "2024-01-03"), ("2024-01-02", "2024-01-09"), (None, "2024-01-05"), (None, None)):
        days = audience.read_days(spark, path, first, last)
        low, high = date.fromisoformat(first or "1900-01-01"), date.fromisoformat(last or "2999-01-01")
        users = {}
        for user, kind, at in every:
            if user is not None and at is not None and low <= at.date() <= high:
                users.setdefault(kind, set()).add(user)
        assert rows(audience.users_count(days)) == sorted(((k, len(u)) for k, u in users.items()), key=repr)
        assert audience.users_count(days, []).first()[0] == len(set().union(*users.values()))
    plan = audience.read_days(spark, path, "2024-01-03", "2024-01-04")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_rolling_users(spark, rows):
    every = random_events(random.Random(2))
    got = rows(audience.rolling_users(audience.daily_users(events(spark, every)), 3))
    days = sorted({at.date() for user, _, at in every if user is not None and at is not None})
    wanted = []
    for day in days:
        users = {}
        for user, kind, at in every:
            if user is not None and at is not None and 0 <= (day - at.date()).days < 3:
                users.setdefault(kind, set()).add(user)
        wanted += [(kind, day, len(u)) for kind, u in users.items()]
    assert got == sorted(wanted, key=repr)


def test_only_days_that_changed_are_filed_again(spark, tmp_path, rows):
    path = str(tmp_path / "users")
    before = [(1, "a", T0), (2, "a", T0), (3, "a", T0 + timedelta(days=1)), (4, "b", T0 + timedelta(days=2))]
    after = [(1, "a", T0), (2, "b", T0 + timedelta(days=3)), (3, "a", T0 + timedelta(days=1))]  # 2 moved, 4 went
    audience.write_days(audience.daily_users(events(spark, before)), path)
    kept = files.names_in(spark, f"{path}/day=2024-01-02")
    old, new = events(spark, before).alias("o"), events(spark, [*after, (None, None, None)]).alias("n")
    changed = old.join(new, F.col("o.event_id") == F.col("n.event_id")).where("o.user_id <> 3 and o.user_id <> 1")
    audience.refresh_days(events(spark, after), changed.select(F.struct("o.*").alias("before"), F.struct("n.*").alias("after")), path)
    wanted = audience.users_count(audience.daily_users(events(spark, after)), ("day", "event_type"))
    assert rows(audience.users_count(audience.read_days(spark, path), ("day", "event_type"))) == rows(wanted)
    assert files.names_in(spark, f"{path}/day=2024-01-02") == kept


# Uniqueness


def test_several_keys_in_one_pass_and_one_shuffle(spark, rows):
    full = [(n % 5, n, "r1" if n % 2 else None, "x" if n % 3 else None, T0 + n * MINUTE) for n in range(20)] + [(1, 1, "r1", "x", T0)]
    df = spark.createDataFrame(full, "a int, b long, c string, d string, loaded_at timestamp")
    checks = (
        quality.not_empty("rows"), quality.unique("a", "a"), quality.unique("b", "b"), quality.unique("ac", "a", "c"),
        quality.unique("c", "c"), quality.not_null("d", "d"), quality.fresh("fresh"), quality.unique("b again", "b"),
    )
    found = quality.run_suite(df, checks, T0 + timedelta(minutes=30))
    assert {r.check_name: r.check_value for r in found.collect()} == {"rows": 21, "a": 5, "b": 1, "ac": 5, "c": 1, "d": 7, "fresh": 11, "b again": 1}
    assert [r.check_name for r in found.collect()] == [c.name for c in checks]
    plan = quality.run_suite(df, checks, T0)._jdf.queryExecution().executedPlan().toString()  # one that has not run
    assert plan.count("hashpartitioning") == 1 and plan.count("Scan ") == 1
    empty = {r.check_name: (r.check_value, r.check_status) for r in quality.run_suite(df.limit(0), checks, T0).collect()}
    assert empty["rows"] == (0, "FAIL") and empty["ac"] == (0, "PASS") and empty["fresh"][1] == "FAIL"


# The stateful stream


def outcomes(spark, *rows_):
    return spark.createDataFrame([(T0 + timedelta(seconds=s), o, n) for n, (s, o) in enumerate(rows_)], "ts timestamp, outcome string, event_id long")


class Windows:
    def __init__(self, spark, base):
        self.spark, self.landing = spark, str(base / "in")
        self.counts, self.late, self.checkpoint = (str(base / name) for name in ("counts", "late", "c"))

    def run(self, *rows_):
        outcomes(self.spark, *rows_).coalesce(1).write.mode("append").parquet(self.landing)
        stream = self.spark.readStream.schema("ts timestamp, outcome string, event_id long").option("maxFilesPerTrigger", 1).parquet(self.landing)
        start_outcome_windows(stream, self.counts, self.late, self.checkpoint, delay="10 minutes", trigger=ONCE).awaitTermination()


def test_the_stateful_stream_equals_the_batch_query_with_its_late_rows(spark, tmp_path, rows):
    windows = Windows(spark, tmp_path)
    batches = [
        [(0, "failed"), (30, "failed"), (61, "processed")],
        [(1500, "processed"), (1501, None)],  # the watermark goes on to 15 minutes
        [(1, "failed"), (2, "dlq"), (899, "failed"), (1400, "failed")],  # two too late, two in time
        [(3, "failed"), (1502, "processed")],
    ]
    for batch in batches:  # each run is a restart from the checkpoint
        windows.run(*batch)
    every = [row for batch in batches for row in batch]
    in_time = [row for row in every if row not in [(1, "failed"), (2, "dlq"), (3, "failed")]]
    assert rows(read_late(spark, windows.late)) == [(T0, "dlq", 1), (T0, "failed", 2)]
    assert rows(read_outcome_windows(spark, windows.counts)) == rows(health.outcome_counts(outcomes(spark, *in_time), slide=1))
    assert rows(read_outcome_windows(spark, windows.counts, late=windows.late)) == rows(health.outcome_counts(outcomes(spark, *every), slide=1))


def test_a_batch_of_the_stateful_stream_that_fails_is_counted_once(spark, tmp_path, rows, monkeypatch):
    from wayfare.streaming import outcomes as module

    windows = Windows(spark, tmp_path)
    windows.run((0, "failed"), (70, "failed"))
    with monkeypatch.context() as m:
        m.setattr(module, "with_backoff", lambda action, sleep: 1 / 0)
        with pytest.raises(Exception, match="division"):
            windows.run((1, "failed"))
    windows.run((2, "failed"))
    assert rows(read_outcome_windows(spark, windows.counts, late=windows.late)) == rows(
        health.outcome_counts(outcomes(spark, (0, "failed"), (70, "failed"), (1, "failed"), (2, "failed")), slide=1)
    )
    with pytest.raises(ValueError):
        start_outcome_windows(None, "", "", "", minutes=5, slide=2)


# Landing files


def booking(n, created="2024-01-01T00:00:00Z"):
    return json.dumps({"booking_id": n, "user_id": 1, "route": "R", "transport_type": "bus", "status": "paid", "price": 1.5, "currency": "USD", "created_at": created})


def test_landing_files_are_read_once(spark, tmp_path, rows):
    folder, raw, archive = tmp_path / "landing" / "bookings", str(tmp_path / "raw"), tmp_path / "archive"
    folder.mkdir(parents=True)

    def run():
        query = landing.start_landing(spark, str(folder), raw, landing.booking_loads, str(tmp_path / "c"), at=T0, archive=str(archive), files_per_load=1, trigger=ONCE)
        query.awaitTermination()
        return rows(loads.read_loads(spark, f"{raw}/raw_bookings", schemas.RAW["raw_bookings"]), "booking_id")

    (folder / "a.json").write_text("\n".join([booking(1), booking(2, "no time"), "{torn", ""]) + "\n")
    assert run() == [(1,)] and run() == [(1,)]
    (folder / "b.json").write_text(booking(3) + "\n")
    (folder / "c.json").write_text(booking(1) + "\n")
    assert run() == [(1,), (1,), (3,)] and run() == [(1,), (1,), (3,)]
    letters = loads.read_loads(spark, f"{raw}/dlq_bookings", schemas.DLQ["dlq_bookings"])
    assert rows(letters, "booking_id", "error_reason") == [(2, "created_at is not a time"), (None, "not a JSON object")]
    assert loads.published_loads(spark, f"{raw}/raw_bookings").count() == 3
    assert any(archive.rglob("*.json")) and not (folder / "a.json").exists()


def test_advertising_answers_are_archived_and_validated(spark, tmp_path, rows):
    folder, raw = tmp_path / "landing", str(tmp_path / "raw")
    folder.mkdir()
    good = {"platform": "google_ads", "campaign_id": 1, "campaign_name": "c", "impressions": 10, "clicks": 1, "spend": 0.5}
    (folder / "a.json").write_text(json.dumps([good, good | {"campaign_id": 2, "clicks": -1}]) + "\n" + json.dumps(good | {"campaign_id": 3}) + "\n")
    for _ in range(2):
        landing.start_landing(spark, str(folder), raw, landing.ad_loads("google_ads"), str(tmp_path / "c"), at=T0, trigger=ONCE).awaitTermination()
    assert rows(loads.read_loads(spark, f"{raw}/raw_google_ads", schemas.RAW["raw_google_ads"]), "campaign_id", "spend") == [(1, 0.5), (3, 0.5)]
    assert loads.read_loads(spark, f"{raw}/raw_ads_api_payloads", schemas.RAW["raw_ads_api_payloads"]).count() == 2
    assert rows(loads.read_loads(spark, f"{raw}/refused_google_ads", "value string, fields string"), "fields") == [("clicks",)]


def test_counters_tell_failed_dead_letters(spark, tmp_path):
    from test_streaming import Places, event, land, run_events

    from wayfare.sinks import writers

    places = Places(tmp_path)
    land(places.landing, "a", [event(1), "{torn"])

    def no_dlq(df, path, batch_id):
        if path == places.dlq:
            raise OSError("dead letters cannot be written")
        writers.write_batch(df, path, batch_id)

    run_events(spark, places, write=no_dlq)
    row = read_batches(spark, places.metrics).select("query", "received", "processed", "failed", "dlq").head()
    assert tuple(row) == ("user_events", 2, 1, 1, 1)


def test_booking_lines_are_parsed_once_for_all_tables_of_a_load(spark, tmp_path, rows):
    given = ['{"booking_id":1,"price":2.5,"created_at":"2024-01-01 00:00:00"}', '{"booking_id":2,"created_at":"never"}', "torn", '{"booking_id":3', " ", '{"booking_id":4,"price":1}']
    spark.createDataFrame([(v,) for v in given], "value string").coalesce(1).write.text(str(tmp_path / "in"))
    parsed = []

    def prepare(lines, load_id, at):
        parsed.append("_record" in lines.columns and lines.is_cached)
        return landing.booking_loads(lines, load_id, at)

    prepare.opened = landing.booking_loads.opened
    landing.start_landing(spark, str(tmp_path / "in"), str(tmp_path / "raw"), prepare, str(tmp_path / "c"), at=T0, trigger=ONCE).awaitTermination()
    assert parsed == [True]
    letters = spark.read.parquet(str(tmp_path / "raw" / "dlq_bookings")).select("booking_id", "error_reason")
    assert rows(letters) == rows(spark.createDataFrame([(2, "created_at is not a time"), (None, "not a JSON object"), (None, "not a JSON object")], letters.schema))
    taken = spark.read.parquet(str(tmp_path / "raw" / "raw_bookings"))
    assert sorted((r.booking_id, r.price, r.created_at) for r in taken.collect()) == [(1, 2.5, datetime(2024, 1, 1)), (4, 1.0, None)]
