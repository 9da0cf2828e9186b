"""Typed reading of JSON text where a missing or unreadable value is 0 or the empty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = r"^-?\d+\z"
# Epoch counts per second, and the seconds (1980 to 2200) that a count is believed to mean.
UNITS = {"seconds": 1, "millis": 1_000, "micros": 1_000_000}
PLAUSIBLE = (315_532_800, 7_258_118_400)


def as_uint(text: Column) -> Column:
    """Unsigned integer of a JSON scalar; 0 if it is missing, negative or not an integer.

    NULL from 2^63 on, which the tables cannot hold: such ids must not become one.
    """
    number = text.try_cast("bigint")
    too_large = number.isNull() & F.coalesce(text.rlike(r"^\s*\+?\d{19,}\s*\z"), F.lit(False))
    return F.when(number >= 0, number).when(~too_large, F.lit(0).cast("bigint"))


def as_text(text: Column) -> Column:
    """Text of a JSON scalar; empty if it is missing."""
    return F.coalesce(text, F.lit(""))


def as_float(text: Column) -> Column:
    """Double of a JSON scalar; 0 if it is missing or not a finite number."""
    number = text.try_cast("double")
    return F.when(F.abs(number) < float("inf"), number).otherwise(F.lit(0.0))


def as_time(text: Column, unit: str = "micros") -> Column:
    """Timestamp in whole seconds of a count of ``unit`` since the epoch, or of ISO text; else NULL.

    Counts outside ``PLAUSIBLE`` seconds are in another unit than stated, and are refused.
    """
    count = F.when(text.rlike(DIGITS), text.try_cast("bigint"))
    seconds = F.floor(count / F.lit(UNITS[unit]))
    counted = F.when(seconds.between(*PLAUSIBLE), F.timestamp_seconds(seconds))
    written = F.when(~text.rlike(DIGITS), text.try_cast("timestamp"))
    return F.date_trunc("second", F.coalesce(counted, written))


def json_uint(document: Column, key: str) -> Column:
    return as_uint(F.get_json_object(document, f"$.{key}"))


def json_str(document: Column, key: str) -> Column:
    return as_text(F.get_json_object(document, f"$.{key}"))


def json_float(document: Column, key: str) -> Column:
    return as_float(F.get_json_object(document, f"$.{key}"))


def json_time(document: Column, key: str) -> Column:
    return as_time(F.get_json_object(document, f"$.{key}"))


def plain_number(number: Column) -> Column:
    """Decimal text without exponent or trailing zeros: 22.0 is ``22``.

    Numbers that no decimal of 38 digits holds exactly keep the text of the double.
    """
    forms = [F.regexp_replace(_held(number, scale).cast("string"), r"(\.\d*?)0+\z", "$1") for scale in (10, 20, 36, 0)]
    texts = [F.regexp_replace(text, r"\.\z", "") for text in forms]
    return F.coalesce(*texts, number.cast("string"))


def _held(number: Column, scale: int) -> Column:
    """The number as a decimal of 38 digits if that is exact, else NULL."""
    decimal = number.try_cast(f"decimal(38,{scale})")
    return F.when(decimal.cast("double") == number, decimal)


def to_json_strings(**columns: Column) -> Column:
    """JSON object whose values are all texts, keys in the order given."""
    pairs = [part for name, column in columns.items() for part in (F.lit(name), column.cast("string"))]
    return F.to_json(F.create_map(*pairs))
