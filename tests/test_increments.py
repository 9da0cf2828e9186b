"""Loads, ledger, keyed buckets and deltas: nothing lost, nothing twice, also after failures."""

import dataclasses
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.aggregates import money_sum
from wayfare.plans import deltas, increments, marts, staging
from wayfare.sinks import files, keyed, loads
from wayfare.sinks.keyed import KeyedTable
from wayfare.sinks.ledger import Ledger
from wayfare.sources import schemas

T0 = datetime(2024, 1, 1)
ROW = "k long, v long, x string"


def frame(spark, rows, schema=ROW):
    return spark.createDataFrame(rows, schema)


# Loads


def test_a_load_is_filed_once_and_seen_as_a_whole(spark, tmp_path, rows):
    path = str(tmp_path / "raw")
    assert loads.read_loads(spark, path, ROW).collect() == []
    assert loads.write_load(frame(spark, [(2, 1, "b"), (1, 1, "a")]), path, "one", "2024-01-01", ["k"])
    assert not loads.write_load(frame(spark, [(9, 9, "other")]), path, "one", "2024-01-02")
    # A load that broke off before it was published: its files are there, its rows are not.
    frame(spark, [(7, 7, "half")]).write.parquet(f"{path}/load_day=2024-01-02/load_id=two")
    assert rows(loads.read_loads(spark, path, ROW), "k") == [(1,), (2,)]
    assert loads.write_load(frame(spark, [(3, 1, "c")]), path, "two", "2024-01-02")
    assert rows(loads.read_loads(spark, path, ROW), "k", "load_id") == [(1, "one"), (2, "one"), (3, "two")]
    assert rows(loads.published_loads(spark, path), "load_id", "rows") == [("one", 2), ("two", 1)]
    with pytest.raises(ValueError):
        loads.write_load(frame(spark, []), path, "a/b", "2024-01-01")


def test_an_empty_load_is_a_load(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert loads.write_load(frame(spark, []), path, "none", "2024-01-01")
    assert loads.read_loads(spark, path, ROW).collect() == [] and loads.published_loads(spark, path).count() == 1


def test_only_the_folders_of_the_loads_are_read(spark, tmp_path):
    path = str(tmp_path / "raw")
    for day in (1, 2, 3):
        loads.write_load(frame(spark, [(day, 1, "a")]), path, f"load-{day}", f"2024-01-0{day}", ["k"])
    one = loads.published_loads(spark, path).where("load_id = 'load-2'")
    found = loads.read_loads(spark, path, ROW, one)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert [r["k"] for r in found.collect()] == [2]
    by_day = loads.read_loads(spark, path, ROW).where("load_day = date'2024-01-03'")
    assert "PartitionFilters: [isnotnull(load_day" in by_day._jdf.queryExecution().executedPlan().toString()


# Ledger


def test_late_and_equal_marks_are_taken_in_once(spark, tmp_path, rows):
    path = str(tmp_path / "raw")
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    taken = []

    def run():
        opened = ledger.open(loads.published_loads(spark, path))
        if opened is not None:
            taken.extend(r["k"] for r in loads.read_loads(spark, path, ROW, opened.loads).collect())
            ledger.close(opened)
        return opened

    assert run() is None
    loads.write_load(frame(spark, [(1, 10, "a"), (2, 20, "b")]), path, "first", "2024-01-01")
    run()
    # Older than the newest, as new as the newest, and newer.
    loads.write_load(frame(spark, [(3, 5, "late"), (4, 20, "equal"), (5, 30, "new")]), path, "second", "2024-01-01")
    loads.write_load(frame(spark, [(6, 1, "very late")]), path, "third", "2023-12-01")
    run()
    assert run() is None
    assert sorted(taken) == [1, 2, 3, 4, 5, 6]
    assert rows(ledger.entries(), "load_id") == [("first",), ("second",), ("third",)]


def test_a_run_that_broke_off_is_taken_up_with_its_loads(spark, tmp_path, rows):
    path = str(tmp_path / "raw")
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    loads.write_load(frame(spark, [(1, 1, "a")]), path, "first", "2024-01-01")
    broken = ledger.open(loads.published_loads(spark, path))
    loads.write_load(frame(spark, [(2, 1, "b")]), path, "second", "2024-01-01")
    again = ledger.open(loads.published_loads(spark, path))
    assert again.name == broken.name and rows(again.loads, "load_id") == [("first",)]
    ledger.close(again)
    following = ledger.open(loads.published_loads(spark, path))
    assert following.name != broken.name and rows(following.loads, "load_id") == [("second",)]


# Keyed tables


def table(path, buckets=8):
    return KeyedTable(str(path), T.StructType.fromDDL(ROW), ("k",), ("v",), buckets)


def test_upserts_equal_the_newest_of_all_rows(spark, tmp_path, rows):
    kept, every = table(tmp_path / "t"), []
    pick = random.Random(5)
    for run in range(4):
        new = [(pick.choice([None, *range(30)]), pick.choice([None, 1, 2, 3]), pick.choice([None, "a", "b"])) for _ in range(40)]
        new += [(1, 2, "b")] * 20  # a hot key
        every += new
        kept.upsert(frame(spark, new), f"run-{run}")
        newest = staging.latest_by(frame(spark, every), ["k"], ["v"])
        assert rows(kept.read(spark)) == rows(newest)
    assert rows(kept.upsert(frame(spark, every), "again")) == []  # nothing is newer


def test_changes_tell_what_went_and_what_came(spark, tmp_path, rows):
    kept = table(tmp_path / "t")
    first = kept.upsert(frame(spark, [(1, 1, "a"), (2, 5, "b")]), "r1")
    assert rows(first, "before", "after.k") == [(None, 1), (None, 2)]
    second = kept.upsert(frame(spark, [(1, 2, "new"), (2, 4, "late"), (2, 5, "b"), (3, 1, "c")]), "r2")
    assert rows(second.select("before.x", F.col("after.x").alias("y"))) == [("a", "new"), (None, "c")]


def test_only_the_touched_buckets_are_read_and_written(spark, tmp_path):
    kept = table(tmp_path / "t")
    kept.upsert(frame(spark, [(k, 1, "a") for k in range(64)]), "all")
    before = {name: files.names_in(spark, f"{kept.path}/{name}") for name in files.names_in(spark, kept.path)}
    assert len(before) == 8
    kept.upsert(frame(spark, [(5, 2, "b")]), "one")
    bucket = frame(spark, [(5, 2, "b")]).select(kept.bucket()).first()[0]
    after = {name: files.names_in(spark, f"{kept.path}/{name}") for name in files.names_in(spark, kept.path)}
    assert [name for name in before if before[name] != after[name]] == [f"bucket={bucket}"]
    plan = kept._read(spark, [bucket])._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(bucket" in plan or f"(bucket#" in plan.split("PartitionFilters")[1]


@pytest.mark.parametrize("step", ["changes", "merge", "replace", "after"])
def test_an_upsert_that_breaks_off_goes_on_where_it_was(spark, tmp_path, rows, monkeypatch, step):
    kept = table(tmp_path / "t")
    old, new = [(k, 1, "a") for k in range(40)], [(k, 2, "b") for k in range(0, 40, 2)] + [(99, 1, "n")]
    kept.upsert(frame(spark, old), "r1")

    class Broken(RuntimeError):
        pass

    def stop(*_):
        raise Broken

    with monkeypatch.context() as m:
        if step == "changes":
            m.setattr(KeyedTable, "_merge", stop)
        elif step == "merge":
            m.setattr(KeyedTable, "_replace", stop)
        elif step == "replace":
            moves, move = [], files.move

            def some(session, path, to):
                moves.append(path)
                if len(moves) == 3:
                    raise Broken
                move(session, path, to)

            m.setattr(keyed.files, "move", some)
        if step != "after":
            with pytest.raises(Broken):
                kept.upsert(frame(spark, new), "r2")
        else:
            kept.upsert(frame(spark, new), "r2")
    if step == "replace":  # some buckets are in place and some are not: a reader sees all of them, fresh
        assert rows(kept.read(spark)) == rows(staging.latest_by(frame(spark, old + new), ["k"], ["v"]))
    changes = kept.upsert(frame(spark, new), "r2")
    assert changes.where("before is not null").count() == 20 and changes.where("before is null").count() == 1
    assert rows(kept.read(spark)) == rows(staging.latest_by(frame(spark, old + new), ["k"], ["v"]))


def test_another_run_first_puts_the_buckets_of_a_broken_one_in_place(spark, tmp_path, rows, monkeypatch):
    kept = table(tmp_path / "t")
    kept.upsert(frame(spark, [(k, 1, "a") for k in range(20)]), "r1")
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_replace", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.upsert(frame(spark, [(1, 2, "b")]), "r2")
    kept.upsert(frame(spark, [(1, 3, "c"), (2, 2, "d")]), "r3")
    wanted = [(k, 1, "a") for k in range(20)] + [(1, 3, "c"), (2, 2, "d")]
    assert rows(kept.read(spark)) == rows(staging.latest_by(frame(spark, wanted), ["k"], ["v"]))
    kept.upsert(frame(spark, [(1, 2, "b")]), "r2")  # through already
    assert rows(kept.read(spark)) == rows(staging.latest_by(frame(spark, wanted), ["k"], ["v"]))


# Deltas


AMOUNTS = [0.1, 0.2, 0.3, 19.99, 1e15, 2.5e17, 1e-20, 123456.789012345, float("inf"), None, -5.0, 0.0]


def bookings(spark, rows_):
    full = [(k, 7, route, kind, status, price, "USD", created, T0 + timedelta(minutes=v), f"r{v}") for k, v, route, kind, status, price, created in rows_]
    return spark.createDataFrame(full, schemas.schema("raw_bookings"))


def random_bookings(pick, run, n=120):
    return [
        (
            pick.randrange(60), run * 10 + pick.randrange(-12, 10), pick.choice(["R1", "R2", None]), pick.choice(["bus", None]),
            pick.choice(["paid", "created", "cancelled", None]), pick.choice(AMOUNTS), pick.choice([T0, T0 + timedelta(days=1), None]),
        )
        for _ in range(n)
    ]


def same(rows, got, wanted):
    """Equal rows, amounts up to the last digits of a double."""
    got, wanted = (sorted((tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r) for r in rows(df)), key=repr) for df in (got, wanted))
    assert got == wanted


def test_booking_marts_by_deltas_equal_full_builds(spark, tmp_path, rows):
    inc = increments.Increments(spark, str(tmp_path / "raw"), str(tmp_path / "out"), buckets=4)
    pick, every = random.Random(11), []
    for name in ("mart_daily_bookings", "mart_route_revenue", "mart_booking_status"):
        assert inc.mart(name).collect() == []
    for run in range(3):
        new = random_bookings(pick, run)
        every += new
        loads.write_load(bookings(spark, new), f"{inc.raw}/raw_bookings", f"load-{run}", "2024-01-01", ["booking_id"])
        assert inc.take_in("raw_bookings") is not None and inc.take_in("raw_bookings") is None
        staged = staging.stg_bookings_latest(bookings(spark, every))
        assert rows(inc.staged("stg_bookings_latest")) == rows(staged)
        for name in ("mart_daily_bookings", "mart_route_revenue", "mart_booking_status"):
            same(rows, inc.mart(name), getattr(marts, name)(staged))
        if run == 1:
            inc.deltas("mart_daily_bookings").fold()
            inc.deltas("mart_daily_bookings").fold()


def test_amounts_leave_as_they_came(spark, tmp_path, rows):
    """What was added is taken out to the last digit, also an amount that no decimal holds."""
    inc = increments.Increments(spark, str(tmp_path / "raw"), str(tmp_path / "out"), buckets=2)
    first = [(k, 0, "R1", "bus", "paid", price, T0) for k, price in enumerate([0.1, 0.2, float("inf"), 1e300, 7.0])]
    for n, new in enumerate((first, [(k, 5, "R2", "bus", "created", None, T0) for k in range(4)])):
        loads.write_load(bookings(spark, new), f"{inc.raw}/raw_bookings", f"load-{n}", "2024-01-01")
        inc.take_in("raw_bookings")
    assert rows(inc.mart("mart_route_revenue")) == [("R1", "bus", 1, 1, 7.0), ("R2", "bus", 4, 0, 0.0)]


def test_a_run_that_breaks_off_between_staging_and_marts_counts_once(spark, tmp_path, rows, monkeypatch):
    inc = increments.Increments(spark, str(tmp_path / "raw"), str(tmp_path / "out"), buckets=4)
    pick, every = random.Random(3), []
    for run, broken in enumerate((None, "write", "close")):
        new = random_bookings(pick, run, 40)
        every += new
        loads.write_load(bookings(spark, new), f"{inc.raw}/raw_bookings", f"load-{run}", "2024-01-01")
        with monkeypatch.context() as m:
            if broken:
                m.setattr(deltas.Deltas if broken == "write" else Ledger, broken, lambda *_: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    inc.take_in("raw_bookings")
        if not broken or inc.take_in("raw_bookings") is None:
            inc.take_in("raw_bookings")
    staged = staging.stg_bookings_latest(bookings(spark, every))
    same(rows, inc.mart("mart_route_revenue"), marts.mart_route_revenue(staged))
    assert rows(inc.staged("stg_bookings_latest")) == rows(staged)


def changes_of(spark, rows_):
    full = [
        (k, op, "null", f'{{"order_id":{k},"status":"{status}","price":{price},"route":"R{k % 2}","campaign_id":{campaign}}}', "t", ts, T0 + timedelta(seconds=at))
        for k, op, status, price, campaign, ts, at in rows_
    ]
    return spark.createDataFrame(full, schemas.schema("raw_cdc_orders"))


def test_order_marts_with_late_and_equal_source_times(spark, tmp_path, rows):
    inc = increments.Increments(spark, str(tmp_path / "raw"), str(tmp_path / "out"), buckets=4)
    pick, every = random.Random(8), []
    ads = spark.createDataFrame([(n, f"c{n}", 10, 100, 5.0 * n, "google_ads", T0) for n in range(4)], schemas.schema("raw_google_ads"))
    loads.write_load(ads, f"{inc.raw}/raw_google_ads", "ads", "2024-01-01")
    inc.take_in("raw_google_ads")
    for run in range(3):
        new = [(pick.randrange(1, 25), pick.choice("curd"), pick.choice(["paid", "completed", "created"]), pick.randrange(1, 90), pick.randrange(4), pick.randrange(6), run) for _ in range(40)]
        every += new
        loads.write_load(changes_of(spark, new), f"{inc.raw}/raw_cdc_orders", f"load-{run}", "2024-01-01")
        inc.take_in("raw_cdc_orders")
        staged = staging.stg_orders(changes_of(spark, every))
        assert rows(inc.staged("stg_orders")) == rows(staged)
    same(rows, inc.mart("mart_orders_status"), marts.mart_orders_status(staged))
    same(rows, inc.mart("mart_route_revenue_from_orders"), marts.mart_route_revenue_from_orders(staged))
    same(rows, inc.mart("mart_campaign_performance"), marts.mart_campaign_performance(inc.staged("stg_ads_latest"), staged))


def test_order_images_are_read_once_a_run_for_all_marts(spark, tmp_path, rows, monkeypatch):
    inc = increments.Increments(spark, str(tmp_path / "raw"), str(tmp_path / "out"), buckets=2)
    read, kept = [], increments.STAGED["stg_orders"]

    def counted(versions):
        read.append(versions)
        return kept.rows(versions)

    new = [(1, "c", "paid", 5, 1, 1, 0), (2, "c", "created", 7, 1, 1, 0), (3, "u", "paid", 9, 2, 1, 0)]
    loads.write_load(changes_of(spark, new), f"{inc.raw}/raw_cdc_orders", "load-1", "2024-01-01")
    monkeypatch.setitem(increments.STAGED, "stg_orders", dataclasses.replace(kept, rows=counted))
    run = inc.take_in("raw_cdc_orders")
    monkeypatch.undo()
    assert len(read) <= 3  # both sides of the changes and the schema, whatever the number of marts
    typed = spark.read.parquet(f"{inc.table('stg_orders').run_folder(run)}/typed")
    assert rows(typed.select("after.status", "after.price", "before")) == [("created", 7.0, None), ("paid", 5.0, None), ("paid", 9.0, None)]
    same(rows, inc.mart("mart_orders_status"), marts.mart_orders_status(staging.stg_orders(changes_of(spark, new))))


def test_funnel_users_leave_with_their_last_event(spark, tmp_path, rows):
    inc = increments.Increments(spark, str(tmp_path / "raw"), str(tmp_path / "out"), buckets=4)
    pick, every = random.Random(2), []
    for run in range(3):
        new = [(str(pick.randrange(40)), pick.choice([None, 1, 2, 3, 4]), pick.choice([s for _, s in marts.STEPS]), T0, "{}", "t", T0 + timedelta(seconds=pick.randrange(9))) for _ in range(60)]
        every += new
        loads.write_load(spark.createDataFrame(new, schemas.schema("raw_user_events")), f"{inc.raw}/raw_user_events", f"l{run}", "2024-01-01")
        inc.take_in("raw_user_events")
        staged = staging.stg_user_events(spark.createDataFrame(every, schemas.schema("raw_user_events")))
        same(rows, inc.mart("mart_user_event_funnel"), marts.mart_user_event_funnel(staged))
        inc.deltas("mart_user_event_funnel").fold()
    for by in ("events", "users"):
        same(rows, inc.conversion(by), marts.mart_booking_conversion(staged, by))
    with pytest.raises(ValueError):
        inc.conversion("rows")


def test_a_mart_by_deltas_reads_no_raw_or_staging_rows(spark, tmp_path):
    inc = increments.Increments(spark, str(tmp_path / "raw"), str(tmp_path / "out"), buckets=4)
    loads.write_load(bookings(spark, random_bookings(random.Random(1), 0)), f"{inc.raw}/raw_bookings", "l", "2024-01-01")
    inc.take_in("raw_bookings")
    read = inc.mart("mart_route_revenue").inputFiles()
    assert read and all("/deltas/mart_route_revenue/" in name for name in read)


def test_money_sum_agrees_with_signed_sums(spark, rows):
    amounts = spark.createDataFrame([(a,) for a in AMOUNTS if a != float("inf")], "price double")
    spec = deltas.Additive("none", {}, amount="price")
    mine = deltas.totals(deltas.delta(amounts.withColumn("_sign", F.lit(1)), spec), spec).first()["amount"]
    assert mine == pytest.approx(amounts.agg(money_sum("price")).first()[0], rel=1e-15)


def test_the_daily_refresh_by_loads_equals_the_full_one(spark, tmp_path, rows):
    from wayfare.plans import refresh
    from wayfare.sources import sample, tables

    root = "/root/testdata/sf0.001"
    raw = {
        "raw_bookings": sample.raw_bookings(spark, root),
        "raw_google_ads": sample.raw_ads(spark, root, "google_ads"),
        "raw_meta_ads": sample.raw_ads(spark, root, "meta_ads"),
        "raw_cdc_orders": sample.raw_cdc_orders(spark, root),
        "raw_user_events": sample.raw_user_events(spark, root),
    }
    raw = {name: tables.conform(df, name) for name, df in raw.items()}
    inc = increments.Increments(spark, str(tmp_path / "raw"), str(tmp_path / "out"), buckets=2)
    for part in (0, 1):
        for name, df in raw.items():
            one = df.where(F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(2)) == part)
            loads.write_load(one, f"{inc.raw}/{name}", f"load-{part}", "2024-01-01")
        found = increments.refresh(inc, fold=part == 0)
    staged = refresh.build_staging(raw)
    for name, df in (staged | refresh.build_marts(staged)).items():
        same(rows, found[name].select(*df.columns), df)
