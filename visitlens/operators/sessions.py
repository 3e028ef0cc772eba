"""Session metrics.

Sessions are never materialised as groups of records. One aggregate per (session, hour) holds
first and last time and the number of actions, and every other metric follows from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions.times import day_text
from visitlens.sources.tables import with_time

# Fixed values: (level, longest length in ms); below a second is level A, beyond the last is H.
LEVEL_BOUNDS_MS = (("B", 5_000), ("C", 10_000), ("D", 30_000), ("E", 60_000),
                   ("F", 180_000), ("G", 360_000))
INVALID_BELOW_MS = 1_000
INVALID_LEVEL = "A"

# Fixed values: (band, first second, first second of the next band), half open.
LENGTH_BANDS = (("1s_4s", 1, 4), ("4s_7s", 4, 7), ("7s_10s", 7, 10), ("10s_30s", 10, 30),
                ("30s_60s", 30, 60), ("1m_3m", 60, 180), ("3m_10m", 180, 600),
                ("10m_30m", 600, 1800), ("30m", 1800, None))

# Fixed values: (band, fewest actions, most actions).
STEP_BANDS = (("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_29", 10, 29),
              ("30_59", 30, 59), ("60", 60, None))


def _first_last(*extra: Column) -> list[Column]:
    millis = F.unix_millis("ts")
    return [F.min(millis).alias("first_ms"), F.max(millis).alias("last_ms"), *extra]


def session_hours(actions: DataFrame) -> DataFrame:
    """session_id, hour_start, n_actions, first_ms, last_ms: the base of all session metrics."""
    hour = F.date_trunc("hour", "ts").alias("hour_start")
    return with_time(actions).groupBy("session_id", hour).agg(
        *_first_last(F.count(F.lit(1)).alias("n_actions"))
    )


def hours_to_sessions(hours: DataFrame) -> DataFrame:
    """``session_length`` computed from ``session_hours`` instead of from the actions."""
    return hours.groupBy("session_id").agg(
        F.sum("n_actions").alias("n_actions"),
        F.min("first_ms").alias("first_ms"),
        F.max("last_ms").alias("last_ms"),
    ).select(*_session_output())


def hours_to_hourly(hours: DataFrame) -> DataFrame:
    """``session_hour_lengths`` computed from ``session_hours``, with the number of actions."""
    return hours.select(
        "session_id",
        day_text(F.col("hour_start")).alias("day"),
        F.hour("hour_start").alias("hour"),
        (F.col("last_ms") - F.col("first_ms")).alias("length_ms"),
        "n_actions",
    )


def _session_output() -> list:
    length = (F.col("last_ms") - F.col("first_ms")) / 1000
    return ["session_id", "n_actions", length.alias("length_s")]


def session_length(actions: DataFrame) -> DataFrame:
    """session_id, n_actions, length_s (last minus first action)."""
    return with_time(actions).groupBy("session_id").agg(
        *_first_last(F.count(F.lit(1)).alias("n_actions"))
    ).select(*_session_output())


def _length_ms() -> Column:
    return F.round(F.col("length_s") * 1000).cast("bigint")


def session_totals(sessions: DataFrame) -> DataFrame:
    """One row. Lengths are added as whole milliseconds, so the order of adding does not show."""
    return sessions.agg(
        F.count(F.lit(1)).alias("total_session_count"),
        (F.coalesce(F.sum(_length_ms()), F.lit(0)) / 1000).alias("total_session_length"),
        F.count_if(F.col("length_s") < 1).alias("invalid_session_count"),
    )


def _level(length_ms: Column) -> Column:
    level = F.when(length_ms < INVALID_BELOW_MS, F.lit(INVALID_LEVEL))
    for name, longest in LEVEL_BOUNDS_MS:
        level = level.when(length_ms <= longest, F.lit(name))
    return level.otherwise(F.lit("H"))


def session_length_levels(sessions: DataFrame) -> DataFrame:
    """level, session_count; a level without sessions has no row."""
    return level_metrics(sessions).select("level", "session_count")


def level_metrics(sessions: DataFrame) -> DataFrame:
    """level, session_count, length_ms: at most eight rows, from which the totals follow too."""
    return sessions.groupBy(_level(_length_ms()).alias("level")).agg(
        F.count(F.lit(1)).alias("session_count"), F.sum(_length_ms()).alias("length_ms"))


def session_hour_lengths(actions: DataFrame) -> DataFrame:
    """session_id, day, hour, length_ms; a session counts in every hour it has actions in."""
    return hours_to_hourly(session_hours(actions)).drop("n_actions")


def hour_metrics(hourly: DataFrame) -> DataFrame:
    """All metrics of an hour in one pass: session_count, length_s, invalid_count."""
    return hourly.groupBy("day", "hour").agg(
        F.count(F.lit(1)).alias("session_count"),
        F.expr("sum(length_ms) div 1000").alias("length_s"),
        F.count_if(F.col("length_ms") < INVALID_BELOW_MS).alias("invalid_count"),
    )


def hour_session_count(hourly: DataFrame) -> DataFrame:
    return hour_metrics(hourly).select("day", "hour", "session_count")


def hour_session_length(hourly: DataFrame) -> DataFrame:
    return hour_metrics(hourly).select("day", "hour", "length_s")


def hour_invalid_count(hourly: DataFrame) -> DataFrame:
    """Hours without an invalid session have no row."""
    return hour_metrics(hourly).select("day", "hour", "invalid_count").where("invalid_count > 0")


def _band(value: Column, bands, inclusive: bool) -> Column:
    band = F
    for name, low, high in bands:
        inside = value >= low
        if high is not None:
            inside &= (value <= high) if inclusive else (value < high)
        band = band.when(inside, F.lit(name))
    return band.otherwise(F.lit(None))


def _band_shares(sessions: DataFrame, band: Column) -> DataFrame:
    """Counts per band and their share of all sessions. The total is taken over the at most ten
    counted bands, so the sessions are aggregated once."""
    counts = sessions.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("session_count"))
    total = F.sum("session_count").over(Window.partitionBy())
    shares = counts.withColumn("ratio", F.col("session_count") / total)
    return shares.where("band IS NOT NULL")


def session_visit_length_ratios(sessions: DataFrame) -> DataFrame:
    return _band_shares(sessions, _band(F.col("length_s"), LENGTH_BANDS, inclusive=False))


def session_step_length_ratios(sessions: DataFrame) -> DataFrame:
    return _band_shares(sessions, _band(F.col("n_actions"), STEP_BANDS, inclusive=True))
