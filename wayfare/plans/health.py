"""Counts of processing outcomes, consumer backlog, and the alerts on both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators import union_all
from wayfare.operators.islands import islands

# The alert rules.
FAILED_ALERT = "user-events-failed-last-5m"
BACKLOG_ALERT = "kafka-consumer-lag-high"
SEVERITY = "warning"
FAILED_ABOVE = 0
BACKLOG_ABOVE = 100
FAILED_FOR = 1
BACKLOG_FOR = 2


def _minutes(count: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(count))


def outcome_counts(
    outcomes: DataFrame, minutes: int = 5, slide: int | None = None, time: str = "ts"
) -> DataFrame:
    """Outcomes per window of the given minutes, tumbling or sliding.

    Sliding windows are summed from counts per slide, so rows are counted once and only the
    counts are copied into the windows they belong to.
    """
    slide = slide or minutes
    if minutes % slide:
        raise ValueError("the window must be a multiple of the slide")
    step = F.window(time, f"{slide} minutes")["start"]
    counts = outcomes.groupBy(step.alias("window_start"), "outcome").agg(F.count("*").alias("events_count"))
    return windows_of_slots(counts, minutes, slide)


def windows_of_slots(counts: DataFrame, minutes: int, slide: int) -> DataFrame:
    """Counts per window from counts per slot (``window_start``, outcome, events_count) of ``slide`` minutes."""
    if slide != minutes:
        earliest = F.col("window_start") - _minutes(minutes - slide)
        starts = F.explode(F.sequence(earliest, F.col("window_start"), _minutes(slide)))
        counts = (
            counts.select(starts.alias("window_start"), "outcome", "events_count")
            .groupBy("window_start", "outcome")
            .agg(F.sum("events_count").alias("events_count"))
        )
    return counts.select(
        "window_start", (F.col("window_start") + _minutes(minutes)).alias("window_end"), "outcome", "events_count"
    )


def consumer_backlog(offsets: DataFrame) -> DataFrame:
    """Messages not yet consumed per consumer group (and sample time, if the offsets have one)."""
    by = [name for name in ("consumer_group", "sampled_at") if name in offsets.columns]
    return offsets.groupBy(*by).agg(F.sum(F.col("end_offset") - F.col("committed_offset")).alias("backlog"))


def _held(hits: DataFrame, minutes: int) -> DataFrame:
    """Hits ``(subject, at, value)`` that were hits in each of the given minutes before, too.

    Every hit is counted for itself and the minutes after it; no ordering of a whole subject.
    """
    spread = F.inline(
        F.transform(
            F.sequence(F.lit(0), F.lit(minutes)),
            lambda lag: F.struct(
                (F.col("at") + F.make_dt_interval(F.lit(0), F.lit(0), lag)).alias("at"),
                F.when(lag == 0, F.col("value")).alias("value"),
            ),
        )
    )
    return (
        hits.select("subject", spread)
        .groupBy("subject", "at")
        .agg(F.count("*").alias("_minutes"), F.max("value").alias("value"))
        .where((F.col("_minutes") == minutes + 1) & F.col("value").isNotNull())
        .select("subject", "at", "value")
    )


def _hits(outcomes: DataFrame, backlog: DataFrame) -> tuple[tuple[str, DataFrame, int, int], ...]:
    """Per rule: its name, the minutes in which its condition is true (subject, at, value), how long it must hold, its threshold."""
    failing = outcomes.where((F.col("outcome") == "failed") & (F.col("events_count") > FAILED_ABOVE)).select(
        F.lit("user_events").alias("subject"), F.col("window_end").alias("at"), F.col("events_count").alias("value")
    )
    behind = backlog.where(F.col("backlog") > BACKLOG_ABOVE).select(
        F.col("consumer_group").alias("subject"), F.col("sampled_at").alias("at"), F.col("backlog").alias("value")
    )
    return ((FAILED_ALERT, failing, FAILED_FOR, FAILED_ABOVE), (BACKLOG_ALERT, behind, BACKLOG_FOR, BACKLOG_ABOVE))


def alerts(outcomes: DataFrame, backlog: DataFrame) -> DataFrame:
    """Alerts that fire, one row per rule, subject and minute.

    ``outcomes`` are five-minute counts sliding by one minute: failures above 0 now and the
    minute before. ``backlog`` is sampled every minute: above 100 now and the two minutes before.
    """
    return union_all(*[
        _held(hits, minutes).select(
            F.lit(name).alias("alert"),
            F.lit(SEVERITY).alias("severity"),
            "subject",
            F.col("at").alias("fired_at"),
            "value",
            F.lit(threshold).cast("bigint").alias("threshold"),
        )
        for name, hits, minutes, threshold in _hits(outcomes, backlog)
    ])


def episodes(outcomes: DataFrame, backlog: DataFrame) -> DataFrame:
    """Alerts as episodes: (alert, severity, subject, pending_at, fired_at, resolved_at, minutes, peak, threshold).

    An episode is a run of consecutive minutes in which the condition of a rule is true. It is pending from its first minute, fires
    when it has held as long as the rule demands, and is resolved in the first minute after its last. A minute without data
    counts as one in which all is well, so it ends an episode. Runs that do not last until they would fire are no episodes.
    ``minutes`` is how many minutes the condition was true, ``peak`` the greatest value in them.
    """
    return union_all(*[
        islands(hits, ["subject"], "at", 60, {"peak": F.max("value")})
        .where(F.col("steps") > minutes)
        .select(
            F.lit(name).alias("alert"),
            F.lit(SEVERITY).alias("severity"),
            "subject",
            F.col("first").alias("pending_at"),
            (F.col("first") + _minutes(minutes)).alias("fired_at"),
            (F.col("last") + _minutes(1)).alias("resolved_at"),
            F.col("steps").alias("minutes"),
            "peak",
            F.lit(threshold).cast("bigint").alias("threshold"),
        )
        for name, hits, minutes, threshold in _hits(outcomes, backlog)
    ])
