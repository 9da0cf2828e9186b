"""Time parsing and differences. The session time zone is UTC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO date, then optionally a separator, HH:MM, :SS, a fraction and a zone.
ISO_TIME = (
    r"^(\d{4}-\d{2}-\d{2})"
    r"(?:[Tt _](\d{2}:\d{2})(?:(:\d{2})(?:[.,]\d+)?)?([Zz]|[+\-−]\d{2}:?\d{2})?)?\z"
)
USUAL_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})?\z"
NO_SECONDS = r"^(.{10}[Tt _]\d{2}:\d{2})(?=[Zz+\-−]|\z)"
EPOCH_NUMBER = r"^[+-]?\d+(\.\d+)?\z"
# Epoch numbers beyond this size are milliseconds, smaller ones seconds.
MILLISECONDS_FROM = 2e10
LAST_SECOND = 253402300799  # 9999-12-31 23:59:59


def instant(value: datetime | str | Column | None = None) -> Column:
    """A timestamp column in whole milliseconds; the query's own start time if none is given."""
    if value is None:
        value = F.current_timestamp()
    elif not isinstance(value, Column):
        value = F.lit(value)
    return F.date_trunc("millisecond", value.cast("timestamp"))


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end (not whole minutes elapsed)."""

    def minute(moment: Column) -> Column:
        return F.floor(F.unix_micros(moment.cast("timestamp")) / F.lit(60_000_000))

    return minute(end) - minute(start)


def booking_ts(text: Column) -> Column:
    """Booking creation text without fraction, ``T``, ``+`` offset or ``Z``.

    The offset is dropped, not applied. A negative offset without a fraction stays in the text.
    """
    spaced = F.replace(F.split_part(text, F.lit("."), F.lit(1)), F.lit("T"), F.lit(" "))
    return F.trim(F.split_part(F.split_part(spaced, F.lit("+"), F.lit(1)), F.lit("Z"), F.lit(1)))


def iso_time(text: Column) -> Column:
    """Timestamp of ISO-8601 text in whole seconds, the offset applied; NULL if it is not ISO."""
    whole = F.regexp_replace(text, NO_SECONDS, "$1:00")
    plain = F.translate(F.regexp_replace(whole, ISO_TIME, "$1 $2$3$4"), "z−", "Z-")
    return F.when(text.rlike(ISO_TIME), F.trim(plain).try_cast("timestamp"))


def epoch_time(number: Column) -> Column:
    """Timestamp of an epoch number in seconds, or milliseconds if it is large; whole seconds."""
    seconds = F.when(F.abs(number) > MILLISECONDS_FROM, number / 1000).otherwise(number)
    return F.when(
        F.abs(seconds) <= LAST_SECOND, F.timestamp_seconds(F.floor(seconds).cast("bigint"))
    )


def usual_time(text: Column) -> Column:
    """Timestamp of text in the usual form, as most messages have it; NULL otherwise."""
    return F.when(text.rlike(USUAL_TIME), F.date_trunc("second", text.try_cast("timestamp")))


def event_time_utc(text: Column) -> Column:
    """Event time text (ISO-8601 or an epoch number) as a UTC timestamp in whole seconds."""
    return (
        F.when(text.rlike(USUAL_TIME), usual_time(text))
        .when(text.rlike(EPOCH_NUMBER), epoch_time(text.try_cast("double")))
        .otherwise(iso_time(text))
    )
