"""Column functions: aggregates, times, JSON text and lenient field reading."""

from wayfare.functions.aggregates import count_if, distinct_count, money_avg, money_sum, ratio, sum_if
from wayfare.functions.jsontext import (
    as_float,
    as_text,
    as_time,
    as_uint,
    json_float,
    json_str,
    json_time,
    json_uint,
    plain_number,
    to_json_strings,
)
from wayfare.functions.times import booking_ts, event_time_utc, minutes_between

__all__ = [
    "as_float",
    "as_text",
    "as_time",
    "as_uint",
    "booking_ts",
    "count_if",
    "distinct_count",
    "event_time_utc",
    "json_float",
    "json_str",
    "json_time",
    "json_uint",
    "minutes_between",
    "money_avg",
    "money_sum",
    "plain_number",
    "ratio",
    "sum_if",
    "to_json_strings",
]
