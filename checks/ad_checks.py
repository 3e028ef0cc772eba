"""Ad clicks: batch twins of the streams, and streams run to their end over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import check
from visitlens.functions.times import TIME_FORMAT
from visitlens.operators import ads
from visitlens.operators.filters import filter_count_threshold
from visitlens.session import scratch_path
from visitlens.sources.clicks import file_lines, parse_ad_click, rejected_ad_clicks
from visitlens.streaming import ad_realtime as rt
from visitlens.streaming.keyed_state import IDLE_SCHEMA

# The data has at most a few clicks per user and window, so the limit is 1 here.
LIMIT = 1
# Fixed value: users 0 to 99 stand for the whitelist.
WHITELISTED = 100

_DAILY = "SELECT date, province, city, ad_id, click_count FROM daily"

_TOP5 = """
SELECT date, province, CAST(rn AS INTEGER) AS rank, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rn
  FROM (SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
        FROM {daily} GROUP BY date, province, ad_id)) WHERE rn <= 5"""

_CLEAN_DAILY = """(SELECT strftime(ts, '%Y%m%d') AS date, province, city, ad_id, count(*) AS click_count
  FROM clicks WHERE user_id NOT IN (SELECT user_id FROM blacklist) GROUP BY ALL)"""

_CLICK_LIST = "timestamp, province, city, user_id, ad_id"


def _whitelist(spark):
    return spark.range(WHITELISTED).select(F.col("id").cast("int").alias("user_id"))


def _abusive(spark, sf):
    windows = ads.user_click_windows(views.clicks(spark, sf), threshold=LIMIT)
    return ads.anti_join_whitelist(windows, _whitelist(spark))


def _click_stream(spark, sf, root):
    """The clicks as messages in files, read as a stream and parsed."""
    views.click_lines(views.clicks(spark, sf)).write.text(f"{root}/lines")
    return parse_ad_click(file_lines(spark, f"{root}/lines"))


def _once(spark):
    return {"trigger": {"availableNow": True}, "state_partitions": spark.sparkContext.defaultParallelism}


def _run(query):
    query.awaitTermination()


def _ad_job(spark, sf, label):
    """The four queries of the job, each run to its end before the next starts."""
    root = scratch_path(spark, label)
    tables, how = rt.AdTables(f"{root}/tables"), _once(spark)
    clicks = _click_stream(spark, sf, root)
    _run(rt.start_detector(clicks, tables, f"{root}/c/detector", lambda: _whitelist(spark), LIMIT, **how))
    _run(rt.start_cleaner(clicks, tables, f"{root}/c/cleaner", trigger=how["trigger"]))
    published = rt.clean_clicks(spark, tables)
    _run(rt.start_totals(published, tables, f"{root}/c/totals", top=None, **how))
    _run(rt.start_top_ads(published, tables, f"{root}/c/top_ads", **how))
    _run(rt.start_windows(published, tables, f"{root}/c/windows", **how))
    return tables


def _formatted(windows):
    return windows.select(*[
        F.date_format(c, TIME_FORMAT).alias(c) if c in ("window_start", "window_end", "run_start", "run_end")
        else F.col(c) for c in windows.columns])


@check("parse_ad_click", "clicks", f"SELECT epoch_ms(ts) AS ts, {_CLICK_LIST} FROM clicks")
def parse_clicks(spark, sf):
    parsed = parse_ad_click(views.click_lines(views.clicks(spark, sf)))
    return parsed.withColumn("ts", F.unix_millis("ts"))


@check("rejected_ad_clicks", "clicks", """
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN len(tokens) <> 5 THEN 'width'
    WHEN TRY_CAST(tokens[1] AS BIGINT) IS NULL THEN 'number:timestamp'
    WHEN TRY_CAST(tokens[4] AS INTEGER) IS NULL THEN 'number:user_id'
    WHEN TRY_CAST(tokens[5] AS INTEGER) IS NULL THEN 'number:ad_id' END AS reason
  FROM (SELECT list_filter(list_transform(string_split(text, ' '), lambda t: trim(t, chr(10) || chr(9) || chr(13) || ' ')),
          lambda t: t <> '') AS tokens FROM documents))
WHERE reason IS NOT NULL GROUP BY reason""")
def rejected_clicks(spark, sf):
    lines = views.table(spark, sf, "documents").select(F.col("text").alias("value"))
    return rejected_ad_clicks(lines).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@check("stream_user_clicks_window", "user_windows", """
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, user_id, click_count FROM user_windows""")
def stream_user_clicks_window(spark, sf):
    return _formatted(ads.user_click_windows(views.clicks(spark, sf), threshold=0))


@check("filter_count_threshold", "user_windows", """
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, user_id, click_count
FROM user_windows WHERE click_count > 1""")
def count_threshold(spark, sf):
    windows = ads.user_click_windows(views.clicks(spark, sf), threshold=0)
    return _formatted(filter_count_threshold(windows, LIMIT))


@check("anti_join_whitelist", "abusive", """
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, user_id, click_count FROM abusive""")
def anti_join_whitelist(spark, sf):
    return _formatted(_abusive(spark, sf))


# The detector as a stream, then a listed user with an even id taken off by hand.
@check("stream_blacklist_update", "blacklist", "SELECT user_id, count FROM blacklist WHERE user_id % 2 = 1")
def stream_blacklist_update(spark, sf):
    root = scratch_path(spark, "detector")
    tables = rt.AdTables(root)
    _run(rt.start_detector(_click_stream(spark, sf, root), tables, f"{root}/checkpoint", lambda: _whitelist(spark),
                           LIMIT, **_once(spark)))
    rt.remove_users(rt.read_blacklist(spark, tables).where("user_id % 2 = 0"), tables, "2100-01-01 00:00:00")
    return rt.read_blacklist(spark, tables)


def _clean(spark, sf):
    blacklist = ads.blacklist_entries(_abusive(spark, sf))
    return ads.anti_join_blacklist(views.clicks(spark, sf), blacklist)


_CLEAN = f"""
SELECT epoch_ms(ts) AS ts, {_CLICK_LIST} FROM clicks
WHERE user_id NOT IN (SELECT user_id FROM blacklist)"""


@check("anti_join_blacklist", "blacklist", _CLEAN)
def anti_join_blacklist(spark, sf):
    return _clean(spark, sf).withColumn("ts", F.unix_millis("ts"))


# Two batches: the first meets an empty blacklist, the second the one built from the first.
@check("stream_blacklist_filter", "blacklist", f"""
SELECT 0 AS batch, epoch_ms(ts) AS ts, {_CLICK_LIST} FROM clicks
UNION ALL SELECT 1, * FROM ({_CLEAN})""")
def stream_blacklist_filter(spark, sf):
    clicks = views.clicks(spark, sf)
    tables = rt.AdTables(scratch_path(spark, "blacklist"))
    rt.publish_clean_clicks(clicks, 0, tables)
    rt.update_blacklist(
        ads.user_click_windows(clicks, threshold=LIMIT), 0, tables, _whitelist(spark))
    rt.publish_clean_clicks(clicks, 1, tables)
    return spark.read.schema(f"{rt.CLICK_SCHEMA}, writer string, batch int").parquet(tables.clean).select(
        "batch", F.unix_millis("ts").alias("ts"), *_CLICK_LIST.split(", "))


@check("ad_daily_counts", "daily", _DAILY)
def ad_daily_counts(spark, sf):
    return ads.ad_daily_counts(views.clicks(spark, sf))


@check("province_ad_counts", "daily", """
SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count FROM daily
GROUP BY date, province, ad_id""")
def province_ad_counts(spark, sf):
    return ads.province_ad_counts(ads.ad_daily_counts(views.clicks(spark, sf)))


@check("province_top5_ads", "daily", _TOP5.format(daily="daily"))
def province_top5_ads(spark, sf):
    return ads.province_top_ads(ads.ad_daily_counts(views.clicks(spark, sf)))


@check("province_top5_ads_salted", "daily", _TOP5.format(daily="daily"))
def province_top5_ads_salted(spark, sf):
    return ads.province_top_ads(ads.ad_daily_counts(views.clicks(spark, sf)), salts=100)


_AD_WINDOWS = """
SELECT strftime(w + INTERVAL 10 MINUTE, '%Y%m%d%H%M%S') AS date, ad_id, count(*) AS click_count
FROM (SELECT ad_id, unnest(range(date_trunc('minute', ts) - INTERVAL 9 MINUTE,
    date_trunc('minute', ts) + INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS w FROM clicks)
GROUP BY w, ad_id"""


@check("stream_ad_clicks_window", "clicks", _AD_WINDOWS)
def stream_ad_clicks_window(spark, sf):
    return ads.ad_click_windows(views.clicks(spark, sf))


@check("stream_ad_clicks_window_panes", "clicks", _AD_WINDOWS)
def stream_ad_clicks_window_panes(spark, sf):
    return ads.ad_click_windows(views.clicks(spark, sf), panes=True)


# Runs of batches with fewer than twelve idle ones between: gaps of at most 360 seconds.
@check("stream_idle_expiry", "clicks", """
SELECT strftime(min(b), '%Y-%m-%d %H:%M:%S') AS run_start, strftime(max(b), '%Y-%m-%d %H:%M:%S') AS run_end,
  date, province, city, ad_id, count(*) AS click_count
FROM (SELECT *, sum(starts) OVER (PARTITION BY date, province, city, ad_id ORDER BY b, ts
        ROWS UNBOUNDED PRECEDING) AS run
  FROM (SELECT *, CASE WHEN b - lag(b) OVER (PARTITION BY date, province, city, ad_id ORDER BY b, ts)
          <= INTERVAL 360 SECOND THEN 0 ELSE 1 END AS starts
    FROM (SELECT *, strftime(ts, '%Y%m%d') AS date, time_bucket(INTERVAL 30 SECOND, ts) AS b FROM clicks)))
GROUP BY date, province, city, ad_id, run""")
def stream_idle_expiry(spark, sf):
    return _formatted(ads.ad_idle_runs(views.clicks(spark, sf)))


# Totals per batch of 30 seconds, as a stream replays them: each batch that changed a total, and the twelfth idle
# batch, which ends it. The stream has closed what lies ten minutes and more before the last click.
@check("stream_idle_totals", "clicks", """
WITH closed AS (SELECT max(ts) - INTERVAL 10 MINUTE AS w FROM clicks),
counted AS (
  SELECT strftime(ts, '%Y%m%d') AS date, province, city, ad_id, time_bucket(INTERVAL 30 SECOND, ts) AS b, count(*) AS n
  FROM clicks GROUP BY ALL),
run AS (
  SELECT *, sum(starts) OVER (PARTITION BY date, province, city, ad_id ORDER BY b ROWS UNBOUNDED PRECEDING) AS run
  FROM (SELECT *, CASE WHEN b - lag(b) OVER (PARTITION BY date, province, city, ad_id ORDER BY b)
      <= INTERVAL 360 SECOND THEN 0 ELSE 1 END AS starts
    FROM counted, closed WHERE b + INTERVAL 30 SECOND <= w)),
total AS (
  SELECT date, province, city, ad_id, b, run, CAST(sum(n) OVER (
    PARTITION BY date, province, city, ad_id, run ORDER BY b ROWS UNBOUNDED PRECEDING) AS BIGINT) AS click_count FROM run)
SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS batch, date, province, city, ad_id, click_count, false AS ended FROM total
UNION ALL
SELECT strftime(max(b) + INTERVAL 360 SECOND, '%Y-%m-%d %H:%M:%S'), date, province, city, ad_id, max(click_count), true
FROM total, closed GROUP BY date, province, city, ad_id, run, w HAVING max(b) + INTERVAL 390 SECOND <= w""")
def stream_idle_totals(spark, sf):
    root = scratch_path(spark, "idle-totals")
    _run(rt.start_idle_totals(_click_stream(spark, sf, root), f"{root}/totals", f"{root}/checkpoint", **_once(spark)))
    rows = spark.read.schema(IDLE_SCHEMA).parquet(f"{root}/totals")
    return rows.withColumn("batch", F.date_format("batch", TIME_FORMAT))


# The top ads kept in state by two operators, over a restart half way.
@check("stream_top_ads_state", "daily", _TOP5.format(daily="daily"))
def stream_top_ads_state(spark, sf):
    root = scratch_path(spark, "top-state")
    tables, clicks = rt.AdTables(root), views.clicks(spark, sf)
    for condition in ("ts < TIMESTAMP '2024-01-16 12:00:00'", "ts >= TIMESTAMP '2024-01-16 12:00:00'"):
        views.click_lines(clicks.where(condition)).write.mode("append").text(f"{root}/lines")
        _run(rt.start_top_ads(parse_ad_click(file_lines(spark, f"{root}/lines")), tables, f"{root}/checkpoint",
                              **_once(spark)))
    return rt.read_top_ads(spark, tables)


# Windows over minutes as two stateful operators, for the windows the watermark has passed.
@check("stream_chained_windows", "clicks", f"""
SELECT * FROM ({_AD_WINDOWS}) WHERE strptime(date, '%Y%m%d%H%M%S') <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM clicks)""")
def stream_chained_windows(spark, sf):
    root = scratch_path(spark, "chained")
    tables = rt.AdTables(root)
    _run(rt.start_windows(_click_stream(spark, sf, root), tables, f"{root}/checkpoint", **_once(spark)))
    return spark.read.schema("date string, ad_id int, click_count bigint").parquet(tables.windows)


# The same for the windows of users, which slide by three minutes.
@check("stream_chained_user_windows", "user_windows", """
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, user_id, click_count
FROM user_windows WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM clicks)""")
def stream_chained_user_windows(spark, sf):
    root = scratch_path(spark, "chained-users")
    clicks = _click_stream(spark, sf, root).withWatermark("ts", rt.WATERMARK)
    windows = ads.user_click_windows(clicks, threshold=0, panes=True)
    _run(windows.writeStream.format("parquet").option("path", f"{root}/windows").option(
        "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    return _formatted(spark.read.schema(windows.schema).parquet(f"{root}/windows"))


# Totals written by two batches, the second covering all days again: the last version counts.
@check("stream_ad_daily_counts", "daily", _DAILY)
def stream_ad_daily_counts(spark, sf):
    tables = rt.AdTables(scratch_path(spark, "totals"))
    clicks = views.clicks(spark, sf)
    rt.update_totals(ads.ad_daily_counts(clicks.where("ts < TIMESTAMP '2024-01-10 12:00:00'")), 0, tables)
    rt.update_totals(ads.ad_daily_counts(clicks.where("ts >= TIMESTAMP '2024-01-10'")), 1, tables)
    return rt.read_totals(spark, tables)


@check("stream_province_top5", "daily", _TOP5.format(daily="daily"))
def stream_province_top5(spark, sf):
    tables = rt.AdTables(scratch_path(spark, "top5"))
    clicks = views.clicks(spark, sf)
    rt.update_totals(ads.ad_daily_counts(clicks.where("ts < TIMESTAMP '2024-01-10 12:00:00'")), 0, tables)
    rt.update_totals(ads.ad_daily_counts(clicks.where("ts >= TIMESTAMP '2024-01-10'")), 1, tables)
    return rt.read_top_ads(spark, tables)


@check("job_ad_realtime", "blacklist", _TOP5.format(daily=_CLEAN_DAILY))
def job_ad_realtime(spark, sf):
    return rt.read_top_ads(spark, _ad_job(spark, sf, "ad-job"))


# The four tables of the job, one after the other. Windows are written once the watermark, ten minutes
# behind the last clean click, has passed them.
@check("stream_result_tables", "blacklist", f"""
WITH clean AS (SELECT * FROM clicks WHERE user_id NOT IN (SELECT user_id FROM blacklist)),
totals AS (SELECT * FROM {_CLEAN_DAILY}),
spread AS (
  SELECT ad_id, unnest(range(date_trunc('minute', ts) - INTERVAL 9 MINUTE,
    date_trunc('minute', ts) + INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) + INTERVAL 10 MINUTE AS w_end FROM clean)
SELECT 'black_users' AS result, CAST(user_id AS VARCHAR) AS key, CAST(count AS BIGINT) AS n FROM blacklist
UNION ALL SELECT 'totals', concat_ws('|', date, province, city, ad_id), click_count FROM totals
UNION ALL SELECT 'top_ads', concat_ws('|', date, province, rank, ad_id), click_count
  FROM ({_TOP5.format(daily='totals')})
UNION ALL SELECT 'windows', concat_ws('|', strftime(w_end, '%Y%m%d%H%M%S'), ad_id), count(*)
  FROM spread WHERE w_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM clean) GROUP BY w_end, ad_id""")
def stream_result_tables(spark, sf):
    tables = _ad_job(spark, sf, "ad-tables")
    windows = spark.read.schema("date string, ad_id int, click_count bigint").parquet(tables.windows)
    parts = (
        ("black_users", rt.read_blacklist(spark, tables), ["user_id"], "count"),
        ("totals", rt.read_totals(spark, tables), ads.DAILY_KEYS, "click_count"),
        ("top_ads", rt.read_top_ads(spark, tables), [*rt.TOP_KEYS, "ad_id"], "click_count"),
        ("windows", windows, ["date", "ad_id"], "click_count"),
    )
    rows = [df.select(F.lit(name).alias("result"), F.concat_ws("|", *keys).alias("key"), F.col(n).alias("n"))
            for name, df, keys, n in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


# A file stream of click messages, parsed and written out by the exactly-once file sink.
@check("stream_click_source", "clicks", f"SELECT {_CLICK_LIST} FROM clicks")
def stream_click_source(spark, sf):
    root = scratch_path(spark, "click-source")
    views.click_lines(views.clicks(spark, sf)).write.text(f"{root}/lines")
    query = (
        parse_ad_click(file_lines(spark, f"{root}/lines")).writeStream.format("parquet")
        .option("path", f"{root}/clicks").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/clicks").select(*_CLICK_LIST.split(", "))


# The totals query stopped half way and started again on its checkpoint.
@check("stream_checkpoint", "daily", _DAILY)
def stream_checkpoint(spark, sf):
    root = scratch_path(spark, "restart")
    tables, clicks = rt.AdTables(root), views.clicks(spark, sf)
    for condition in ("ts < TIMESTAMP '2024-01-16'", "ts >= TIMESTAMP '2024-01-16'"):
        views.click_lines(clicks.where(condition)).write.mode("append").text(f"{root}/lines")
        query = rt.start_totals(
            parse_ad_click(file_lines(spark, f"{root}/lines")), tables, f"{root}/checkpoint",
            trigger={"availableNow": True},
            state_partitions=spark.sparkContext.defaultParallelism)
        query.awaitTermination()
    return rt.read_totals(spark, tables)
