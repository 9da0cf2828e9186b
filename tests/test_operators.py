"""Operators over rows and keys, with ties, empty tables, NULL versions and hot keys."""

from datetime import datetime

from pyspark.sql import functions as F

from wayfare import operators as O
from wayfare.plans import quality


def test_latest_takes_the_newest_and_breaks_ties_by_the_other_columns(spark, rows):
    frame = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "z"), (2, 0, "y"), (3, None, "q"), (3, None, "p")],
        "k int, v int, x string",
    )
    expected = [(1, 2, "c"), (2, 0, "y"), (3, None, "q")]
    for parts in (1, 2, 5):
        assert rows(O.latest_by(frame.repartition(parts), ["k"], ["v"])) == expected


def test_latest_of_nothing(spark, rows):
    assert rows(O.latest_by(spark.createDataFrame([], "k int, v int"), ["k"], ["v"])) == []


def test_latest_reduces_a_hot_key_before_the_shuffle(spark, rows):
    hot = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    newest = O.latest_by(hot, ["k"], ["v"])
    assert newest.where("k = 0").head().v == 39999
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan.split("Exchange", 1)[1]


def test_latest_keeps_columns_that_cannot_be_compared(spark):
    frame = spark.sql("SELECT 1 AS k, v, map('v', v) AS m FROM VALUES (1), (3), (2) AS t(v)")
    row = O.latest_by(frame, ["k"], ["v"]).head()
    assert (row.v, row.m) == (3, {"v": 3})


def test_duplicate_keys(spark, rows):
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], "k int, r string")
    assert rows(O.duplicate_keys(frame, ["k", "r"])) == [(1, "a", 2)]
    assert rows(O.duplicate_keys(frame.limit(0), ["k"])) == []


def test_long_form_is_one_scan(spark, rows):
    frame = spark.createDataFrame([(1,), (2,), (3,)], "n int")
    long = O.to_long(frame, [("rows", F.count("*")), ("sum", F.sum("n"))])
    assert rows(long) == [("rows", 3.0), ("sum", 6.0)]


def test_union_matches_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert rows(O.union_all(a, b)) == [(1, "x"), (2, "y")]


def test_top_k(spark):
    frame = spark.createDataFrame([(n % 3, n) for n in range(9)], "a int, b int")
    assert [tuple(r) for r in O.top_k(frame, [F.col("a").desc(), F.col("b")], 4).collect()] == [
        (2, 2), (2, 5), (2, 8), (1, 1),
    ]


def test_high_water_mark(spark, rows):
    source = spark.createDataFrame(
        [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, datetime(2024, 1, 3))], "k int, loaded_at timestamp"
    )
    assert [r[0] for r in rows(O.after_high_water(source, source.where("k <= 2")))] == [3]
    assert [r[0] for r in rows(O.after_high_water(source, source.limit(0)))] == [1, 2, 3]
    assert rows(O.after_high_water(source, source)) == []


def test_upsert(spark, rows):
    target = spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "k int, v int, x string")
    new = spark.createDataFrame([("c", 2, 1), ("d", 4, 2), ("e", 1, 3)], "x string, v int, k int")
    assert rows(O.upsert_latest(target, new, ["k"], ["v"])) == [(1, 2, "c"), (2, 5, "b"), (3, 1, "e")]


def test_flags_change_only_the_named_keys(spark, rows):
    frame = spark.createDataFrame([("a", 0, False), ("b", 1, False), (None, 2, False)], "id string, n int, done boolean")
    ids = spark.createDataFrame([("a",), ("a",), ("zz",), (None,)], "id string")
    changed = O.update_flags(frame, ids, "id", {"n": F.col("n") + 1, "done": F.lit(True)})
    assert changed.columns == frame.columns and changed.dtypes == frame.dtypes
    assert rows(changed) == [("a", 1, True), ("b", 1, False), (None, 2, False)]


def test_rows_without_a_key_are_spread(spark, rows):
    frame = spark.range(2000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("n"))
    values = spark.createDataFrame([("a", 1)], "k string, v int")
    joined = O.left_lookup(frame, values, "k")
    assert joined.count() == 2000 and joined.where("v IS NOT NULL").count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = O.left_lookup(frame, values, "k").groupBy(F.spark_partition_id()).count()
        assert spread.agg(F.max("count")).head()[0] < 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_hot_lookup_key_is_split(spark):
    small = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        hot = spark.range(0, 90000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
            F.uuid().alias("text"), F.lit(False).alias("done"),
        )
        ids = spark.createDataFrame([("hot",), ("7",), ("hot",)], "k string")
        marked = O.update_flags(hot, ids, "k", {"done": F.lit(True)}).groupBy("done").agg(F.count("*"), F.max("text"))
        assert {r.done: r[1] for r in marked.collect()} == {True: 30001, False: 59999}
        assert "skew=true" in marked._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in small:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def _parts_before_folding(frame):
    """Whether rows are dealt out in parts of advised size below the first fold per key."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return "REBALANCE_PARTITIONS_BY_COL" in plan.split("partial_count(1)", 1)[1]


def test_keys_are_counted_in_parts_of_bounded_size(spark, rows):
    frame = spark.createDataFrame([(1, None), (1, None), (0, "a"), (0, "a"), (0, "b"), (None, "a"), (None, "a")] + [(7, "hot")] * 50, "k int, s string")
    for parts in (1, 3):
        found = O.duplicate_keys(frame.repartition(parts), ["k", "s"])
        assert {(r.k, r.s): r.copies for r in found.collect()} == {(1, None): 2, (0, "a"): 2, (None, "a"): 2, (7, "hot"): 50}
    assert _parts_before_folding(O.duplicate_keys(frame, ["k", "s"]))
    suite = [quality.not_empty("rows"), quality.unique("key", "k", "s")]
    assert {r.check_name: r.check_value for r in quality.run_suite(frame, suite).collect()} == {"rows": 57, "key": 2}
    assert _parts_before_folding(quality.run_suite(frame, suite))
