"""Ad click analysis. Every function without a ranking runs on static and streaming clicks alike.

Clicks: ts, province, city, user_id, ad_id. On a stream, set the watermark before calling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.times import BATCH_STAMP_FORMAT, DATE_KEY_FORMAT
from visitlens.operators.filters import filter_count_threshold
from visitlens.operators.ranking import top_n

# Window sizes, abuse limit, batch length and idle batches after which state goes.
USER_WINDOW, USER_SLIDE = "10 minutes", "3 minutes"
AD_WINDOW, AD_SLIDE = "10 minutes", "1 minute"
ABUSE_LIMIT = 100
BATCH_SECONDS = 30
IDLE_BATCHES = 12

_PANE_SECONDS = 60

DAILY_KEYS = ["date", "province", "city", "ad_id"]


def _count():
    return F.count(F.lit(1)).alias("click_count")


def user_click_windows(
    clicks: DataFrame, win: str = USER_WINDOW, slide: str = USER_SLIDE, threshold: int = ABUSE_LIMIT,
    panes: bool = False,
) -> DataFrame:
    """window_start, window_end, user_id, click_count above the threshold; ``panes`` as in ``ad_click_windows``,
    where a stream lists users only after the window has closed."""
    counts = _counted_windows(clicks, ["user_id"], win, slide, panes)
    return filter_count_threshold(counts, threshold).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "user_id", "click_count",
    )


def anti_join_users(clicks: DataFrame, users: DataFrame) -> DataFrame:
    """Rows of users that are not listed. Spark decides by measured size between broadcast and
    shuffle, where AQE splits hot users."""
    return clicks.join(users.select("user_id"), "user_id", "left_anti")


def anti_join_blacklist(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    return anti_join_users(clicks, blacklist).select(*clicks.columns)


def anti_join_whitelist(counts: DataFrame, whitelist: DataFrame) -> DataFrame:
    return anti_join_users(counts, whitelist).select(*counts.columns)


def blacklist_entries(abusive: DataFrame) -> DataFrame:
    """user_id, count, window_end: the last window in which the user was above the limit."""
    last = top_n(abusive, ["user_id"], [F.col("window_end").desc()], 1)
    return last.select("user_id", F.col("click_count").alias("count"), "window_end")


def ad_daily_counts(clicks: DataFrame) -> DataFrame:
    """date, province, city, ad_id, click_count; the day is an event-time window, so a stream
    drops its state once the watermark has passed the day."""
    counts = clicks.groupBy(F.window("ts", "1 day"), "province", "city", "ad_id").agg(_count())
    date = F.date_format("window.start", DATE_KEY_FORMAT).alias("date")
    return counts.select(date, "province", "city", "ad_id", "click_count")


def province_ad_counts(daily: DataFrame) -> DataFrame:
    return daily.groupBy("date", "province", "ad_id").agg(F.sum("click_count").alias("click_count"))


def province_top_ads(daily: DataFrame, n: int = 5, salts: int | None = None) -> DataFrame:
    """date, province, rank, ad_id, click_count: the ``n`` most clicked ads.

    The ranking already keeps ``n`` rows per map task. ``salts`` adds a first ranking within that
    many slices of the ads, for provinces whose map-side remainder is still too large.
    """
    counts = province_ad_counts(daily)
    order = [F.col("click_count").desc(), F.col("ad_id")]
    if salts:
        sliced = counts.withColumn("_salt", F.pmod(F.xxhash64("ad_id"), F.lit(salts)))
        counts = top_n(sliced, ["date", "province", "_salt"], order, n).drop("_salt")
    ranked = top_n(counts, ["date", "province"], order, n, "rank")
    return ranked.select("date", "province", "rank", "ad_id", "click_count")


def ad_click_windows(
    clicks: DataFrame, win: str = AD_WINDOW, slide: str = AD_SLIDE, panes: bool = False
) -> DataFrame:
    """date (stamp of the window end), ad_id, click_count.

    With ``panes``, clicks are counted per minute first and the counts are spread over the windows instead
    of every click. On static clicks that pays where an ad has many clicks a minute; with few, the second
    aggregation costs more than it saves. On a stream a click then updates one state instead of one per
    window, and a minute and ad one per window; such a chain needs append mode. Windows must be whole minutes.
    """
    counts = _counted_windows(clicks, ["ad_id"], win, slide, panes)
    stamp = F.date_format("window.end", BATCH_STAMP_FORMAT).alias("date")
    return counts.select(stamp, "ad_id", "click_count")


def _counted_windows(clicks: DataFrame, keys: list[str], win: str, slide: str, panes: bool) -> DataFrame:
    """window, keys and click_count, counted at once or by minutes."""
    if not panes:
        return clicks.groupBy(F.window("ts", win, slide), *keys).agg(_count())
    if not (_whole_minutes(win) and _whole_minutes(slide)):
        raise ValueError("panes need windows of whole minutes")
    minutes = clicks.groupBy(F.window("ts", f"{_PANE_SECONDS} seconds").alias("minute"), *keys).agg(_count())
    timed = minutes.select(F.window_time("minute").alias("ts"), *keys, "click_count")
    return timed.groupBy(F.window("ts", win, slide), *keys).agg(F.sum("click_count").alias("click_count"))


def _whole_minutes(interval: str) -> bool:
    return interval.split()[-1].rstrip("s") in ("minute", "hour", "day")


def ad_idle_runs(
    clicks: DataFrame, batch_seconds: int = BATCH_SECONDS, idle_batches: int = IDLE_BATCHES,
    watermark: str | None = None,
) -> DataFrame:
    """run_start, run_end, date, province, city, ad_id, click_count: totals that restart after
    ``idle_batches`` batches in a row without a click.

    A session window over the batch times: two batches belong together while fewer than
    ``idle_batches`` idle ones lie between them. Clicks of one batch share a time, so a hot key
    is reduced to one row per batch before the shuffle. On a stream, give the watermark here: it
    belongs to the batch times.
    """
    seconds = F.unix_seconds("ts")
    batch = F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(batch_seconds)))
    timed = clicks.withColumn("date", F.date_format("ts", DATE_KEY_FORMAT)).withColumn("ts", batch)
    if watermark:
        timed = timed.withWatermark("ts", watermark)
    gap = idle_batches * batch_seconds + 1
    counts = timed.groupBy(F.session_window("ts", f"{gap} seconds"), *DAILY_KEYS).agg(_count())
    last = F.col("session_window.end") - F.expr(f"INTERVAL {gap} SECONDS")
    return counts.select(
        F.col("session_window.start").alias("run_start"), last.alias("run_end"),
        *DAILY_KEYS, "click_count",
    )
