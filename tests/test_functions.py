"""Column functions: zero instead of NULL, boundaries of minutes, time and JSON texts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wayfare import functions as W
from wayfare.functions import aggregates, jsontext, lenient


def one(spark, column, **values):
    names = list(values)
    kinds = ", ".join(
        f"{n} {'double' if isinstance(v, float) else 'bigint' if isinstance(v, int) else 'string'}"
        for n, v in values.items()
    )
    frame = spark.createDataFrame([tuple(values[n] for n in names)], kinds) if names else spark.range(1)
    return frame.select(column.alias("x")).head().x


def test_sums_over_nothing_are_zero(spark):
    empty = spark.createDataFrame([], "price double, status string")
    row = empty.agg(
        W.money_sum("price").alias("a"),
        W.sum_if("price", F.col("status") == "paid").alias("b"),
        W.count_if(F.col("status") == "paid").alias("c"),
        W.money_avg("price").alias("d"),
        W.distinct_count("status").alias("e"),
    ).head()
    assert tuple(row) == (0.0, 0.0, 0, None, 0)


def test_null_predicates_count_as_false(spark):
    frame = spark.createDataFrame([(1.0, None), (2.0, "paid"), (4.0, "new")], "price double, status string")
    paid = F.col("status") == "paid"
    assert tuple(frame.agg(W.count_if(paid), W.sum_if("price", paid)).head()) == (1, 2.0)


def test_money_does_not_depend_on_order(spark):
    frame = spark.createDataFrame([(0.1,)] * 10 + [(1e9,)], "price double")
    sums = {frame.repartition(n).agg(W.money_sum("price").alias("x")).head().x for n in (1, 3, 7)}
    assert sums == {1000000001.0}


@pytest.mark.parametrize("n, d, expected", [(1, 0, 0.0), (0, 0, 0.0), (1, 4, 0.25), (0, 5, 0.0)])
def test_ratio_is_zero_over_zero(spark, n, d, expected):
    assert one(spark, W.ratio(F.col("n"), F.col("d")), n=n, d=d) == expected


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2024-01-01 00:00:59", "2024-01-01 00:01:00", 1),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:59", 0),
        ("2024-01-01 00:00:00", "2024-01-01 02:00:59", 120),
        ("2024-01-01 00:01:00", "2024-01-01 00:00:59", -1),
        ("1969-12-31 23:59:59", "1970-01-01 00:00:00", 1),
    ],
)
def test_minutes_count_boundaries(spark, start, end, expected):
    minutes = W.minutes_between(F.col("a").cast("timestamp"), F.col("b").cast("timestamp"))
    assert one(spark, minutes, a=start, b=end) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-05-24T12:00:00.123Z", "2026-05-24 12:00:00"),
        ("2026-05-24T12:00:00+02:00", "2026-05-24 12:00:00"),
        ("2026-05-24T12:00:00Z", "2026-05-24 12:00:00"),
        ("2026-05-24 12:00:00", "2026-05-24 12:00:00"),
        (" 2026-05-24 12:00:00 ", "2026-05-24 12:00:00"),
        # a negative offset is only cut together with a fraction
        ("2026-05-24T12:00:00-05:00", "2026-05-24 12:00:00-05:00"),
        ("2026-05-24T12:00:00.123-05:00", "2026-05-24 12:00:00"),
    ],
)
def test_booking_time_text(spark, text, expected):
    assert one(spark, W.booking_ts(F.col("t")), t=text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-05-24T12:00:00.123456Z", "2026-05-24 12:00:00"),
        ("2026-05-24T12:00:00.123456-05:00", "2026-05-24 17:00:00"),
        ("2026-05-24 12:00", "2026-05-24 12:00:00"),
        ("2026-05-24T12:00Z", "2026-05-24 12:00:00"),
        ("2026-05-24T12:00+02:00", "2026-05-24 10:00:00"),
        ("2026-05-24T12:00:00-0500", "2026-05-24 17:00:00"),
        ("2026-05-24T12:00:00−05:00", "2026-05-24 17:00:00"),
        ("2026-05-24t12:00:00z", "2026-05-24 12:00:00"),
        ("2026-05-24_12:00:00", "2026-05-24 12:00:00"),
        ("2026-05-24T12:00:00,5Z", "2026-05-24 12:00:00"),
        ("2026-05-24T12:00:00.1234567891Z", "2026-05-24 12:00:00"),
        ("2026-05-24", "2026-05-24 00:00:00"),
        ("1716552000", "2024-05-24 12:00:00"),
        ("1716552000.5", "2024-05-24 12:00:00"),
        ("1716552000000", "2024-05-24 12:00:00"),
        ("2026", "1970-01-01 00:33:46"),
        ("-5", "1969-12-31 23:59:55"),
        ("20000000000", "2603-10-11 11:33:20"),
        ("20000000001", "1970-08-20 11:33:20"),
        ("2026-02-30", None),
        ("2026-02-30T00:00:00Z", None),
        ("2026-05-24T24:00:00", None),
        ("2026-05-24T12:00:60Z", None),
        ("2026-05-24T12:00:00+05", None),
        ("2026-05-24T12:00:00 Z", None),
        ("2026-05-24T12:00:00.", None),
        ("2026-05-24T", None),
        ("2026-05-24T12", None),
        ("2026-5-4", None),
        ("12:00:00", None),
        (" 2026-05-24T12:00:00Z", None),
        ("1e3", None),
        ("not a time", None),
        ("", None),
    ],
)
def test_event_time_in_utc(spark, text, expected):
    expected = datetime.fromisoformat(expected) if expected else None
    assert one(spark, W.event_time_utc(F.col("t")).cast("timestamp_ntz"), t=text) == expected


def test_json_values_default_to_zero_and_empty(spark):
    document = '{"n": 7, "neg": -7, "half": 7.5, "s": "x", "f": 2.5, "none": null, "big": 99999999999999999999}'
    frame = spark.createDataFrame([(document,), ("null",), ("",), ("{broken",)], "d string")
    d = F.col("d")
    got = frame.select(
        W.json_uint(d, "n"), W.json_uint(d, "neg"), W.json_uint(d, "half"), W.json_uint(d, "big"),
        W.json_uint(d, "none"), W.json_str(d, "s"), W.json_str(d, "none"), W.json_float(d, "f"), W.json_float(d, "s"),
    ).collect()
    assert tuple(got[0]) == (7, 0, 0, None, 0, "x", "", 2.5, 0.0)
    assert {tuple(row) for row in got[1:]} == {(0, 0, 0, 0, 0, "", "", 0.0, 0.0)}


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"t": 1716552000123456}', datetime(2024, 5, 24, 12)),
        ('{"t": "2024-05-24T12:00:00.9Z"}', datetime(2024, 5, 24, 12)),
        ('{"t": "2024-05-24 12:00:00"}', datetime(2024, 5, 24, 12)),
        ('{"t": -1}', None),
        ('{"t": 1700000000000}', None),
        ('{"t": 1700000000}', None),
        ('{"t": "soon"}', None),
        ("{}", None),
    ],
)
def test_json_times_take_micros_and_text(spark, text, expected):
    assert one(spark, W.json_time(F.col("d"), "t").cast("timestamp_ntz"), d=text) == expected


@pytest.mark.parametrize(
    "number, expected",
    [(22.0, "22"), (22.5, "22.5"), (-0.05, "-0.05"), (12345678.9, "12345678.9"), (100.0, "100"), (0.0, "0"), (-1e-12, "-0.000000000001"), (1e15, "1000000000000000"), (-1e30, "-1000000000000000000000000000000"), (1e300, "1.0E300"), (float("nan"), "NaN"), (0.1 + 0.2, "0.30000000000000004")],
)
def test_numbers_as_plain_text(spark, number, expected):
    assert one(spark, W.plain_number(F.col("p")), p=number) == expected


@pytest.mark.parametrize("unit, count", [("seconds", 1700000000), ("millis", 1700000000000), ("micros", 1700000000000000)])
def test_times_count_the_stated_unit(spark, unit, count):
    assert one(spark, jsontext.as_time(F.col("t"), unit).cast("timestamp_ntz"), t=str(count)) == datetime(2023, 11, 14, 22, 13, 20)


@pytest.mark.parametrize(
    "text, expected",
    [("5", 5), ("-5", 0), ("x", 0), (None, 0), ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None), ("18446744073709551615", None)],
)
def test_ids_beyond_the_tables_are_not_one_id(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(jsontext.as_uint(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize(
    "amounts, total, mean",
    [
        ([0.00004] * 1000, 0.04, 0.00004),
        ([2.5, 1e15, -1e15], 2.5, 2.5 / 3),
        ([1e300, 1.0], 1e300, 5e299),
        ([1e22, 0.000001, 3.5], 1e22, 1e22 / 3),
        ([], 0.0, None),
        ([None, 1.25], 1.25, 1.25),
        ([2.5, float("inf")], float("inf"), float("inf")),
    ],
)
def test_money_sums_lose_no_amount(spark, amounts, total, mean):
    frame = spark.createDataFrame([(a,) for a in amounts], "a double").repartition(3)
    got = frame.agg(aggregates.money_sum("a"), aggregates.money_avg("a")).first()
    assert got[0] == pytest.approx(total) and (got[1] == mean if mean is None else got[1] == pytest.approx(mean))


def test_json_of_strings_keeps_key_order(spark):
    made = W.to_json_strings(b=F.lit(1), a=F.lit("x"), c=F.lit(True))
    assert one(spark, made) == '{"b":"1","a":"x","c":"true"}'


INTS = {
    '"7"': 7, '" 7 "': 7, '"7.0"': 7, '"7.00"': 7, '"+7"': 7, '"-7"': -7, '"1_000"': 1000, '"007"': 7, "7": 7,
    "7.0": 7, "1e3": 1000, "true": 1, "false": 0, '"1_0.0"': 10, '"\\t7\\n"': 7, '"7.0 "': 7,
    '"7."': "int_parsing", '"7.5"': "int_parsing", '"1e3"': "int_parsing", '""': "int_parsing",
    '"true"': "int_parsing", '".0"': "int_parsing", '"_7"': "int_parsing", '"1__0"': "int_parsing", '"7 0"': "int_parsing",
    "7.5": "int_from_float", "null": "int_type", "[]": "int_type", "{}": "int_type",
}


def test_lenient_integers(spark):
    frame = spark.createDataFrame([(f'{{"i": {text}}}',) for text in INTS], "value string")
    fields = lenient.take(frame.withColumn("_v", F.try_parse_json("value")), "_v", ["i"])
    got = lenient.settle(fields, i=lenient.int_value("i"))
    out = got.select("i", lenient.int_error("i", F.col("i")).alias("e")).collect()
    assert {text: row.i if row.e is None else row.e for text, row in zip(INTS, out)} == INTS


FLOATS = {
    '"12.5"': 12.5, '"1e3"': 1000.0, '"7."': 7.0, '".5"': 0.5, '"1_000.5"': 1000.5, "7": 7.0, "7.5": 7.5, "true": 1.0,
    '""': "float_parsing", '"x"': "float_parsing", '"1d"': "float_parsing", "null": "float_type", "[1]": "float_type",
}


def test_lenient_floats(spark):
    frame = spark.createDataFrame([(f'{{"f": {text}}}',) for text in FLOATS], "value string")
    fields = lenient.take(frame.withColumn("_v", F.try_parse_json("value")), "_v", ["f"])
    got = lenient.settle(fields, f=lenient.float_value("f"))
    out = got.select("f", lenient.float_error("f", F.col("f")).alias("e")).collect()
    assert {text: row.f if row.e is None else row.e for text, row in zip(FLOATS, out)} == FLOATS
