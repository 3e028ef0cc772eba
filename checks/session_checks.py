"""Session metrics, samples and their documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import check
from visitlens.functions.times import TIME_FORMAT
from visitlens.operators import documents as doc
from visitlens.operators import sampling as smp
from visitlens.operators import sessions as ses
from visitlens.operators.filters import filter_invalid_sessions
from visitlens.params import TaskParams
from visitlens.plans.session_analysis import analyse_sessions

RATIO = 0.05

_LEVELS = """CASE WHEN len < 1 THEN 'A' WHEN len <= 5 THEN 'B' WHEN len <= 10 THEN 'C'
  WHEN len <= 30 THEN 'D' WHEN len <= 60 THEN 'E' WHEN len <= 180 THEN 'F'
  WHEN len <= 360 THEN 'G' ELSE 'H' END"""

_RECORD = """'{"date":"' || date || '","user_id":' || user_id || ',"session_id":"' || session_id
  || '","page_id":' || page_id || ',"action_time":"' || action_time
  || '","search_keyword":"' || search_keyword || '","click_category_id":"' || click_category_id
  || '","click_product_id":"' || click_product_id || '","order_category_ids":"' || order_category_ids
  || '","order_product_ids":"' || order_product_ids || '","pay_category_ids":"' || pay_category_ids
  || '","pay_product_ids":"' || pay_product_ids || '","city_id":' || city_id || '}'"""

_HOURS = """
  SELECT day, hour, count(*) AS session_count, CAST(sum(length_ms) // 1000 AS BIGINT) AS length_s,
    count(*) FILTER (WHERE length_ms < 1000) AS invalid_count FROM hourly GROUP BY day, hour"""

_METRICS = f"""
SELECT '{{"total_session_count":' || (SELECT count(*) FROM sessions)
  || ',"total_session_length":"' || (SELECT CAST(sum(len) AS BIGINT) FROM sessions)
  || '","invalid_session_count":' || (SELECT count(*) FILTER (WHERE len < 1) FROM sessions)
  || ',"pre_session_type_of_count":[' || (
    SELECT string_agg('{{"type":"' || level || '","count":' || n || '}}', ',' ORDER BY level)
    FROM (SELECT {_LEVELS} AS level, count(*) AS n FROM sessions GROUP BY 1))
  || '],"pre_hour_of_session_count":[' || (
    SELECT string_agg('{{"day":"' || day || '","hour":' || hour || ',"count":' || session_count || '}}', ',' ORDER BY day, hour)
    FROM ({_HOURS}))
  || '],"pre_hour_of_session_length":[' || (
    SELECT string_agg('{{"day":"' || day || '","hour":' || hour || ',"length":' || length_s || '}}', ',' ORDER BY day, hour)
    FROM ({_HOURS}))
  || '],"pre_hour_of_invalid_session_count":[' || (
    SELECT string_agg('{{"day":"' || day || '","hour":' || hour || ',"invalid":' || invalid_count || '}}', ',' ORDER BY day, hour)
    FROM ({_HOURS}) WHERE invalid_count > 0)
  || ']}}' AS document"""


def _hourly(spark, sf):
    return ses.session_hour_lengths(views.actions(spark, sf))


def _sessions(spark, sf):
    return ses.session_length(views.actions(spark, sf))


def _sample(spark, sf):
    return smp.sample_sessions(_hourly(spark, sf), RATIO)


def _detail(spark, sf):
    actions = views.actions(spark, sf)
    return smp.sampled_actions(actions, ses.session_hour_lengths(actions), RATIO)


check("session_length", "sessions",
      "SELECT session_id, n_actions, CAST(len AS DOUBLE) AS length_s FROM sessions")(_sessions)


@check("session_totals", "sessions", """
SELECT count(*) AS total_session_count, CAST(sum(len) AS DOUBLE) AS total_session_length,
  count(*) FILTER (WHERE len < 1) AS invalid_session_count FROM sessions""")
def session_totals(spark, sf):
    return ses.session_totals(_sessions(spark, sf))


@check("session_length_levels", "sessions",
       f"SELECT {_LEVELS} AS level, count(*) AS session_count FROM sessions GROUP BY 1")
def session_length_levels(spark, sf):
    return ses.session_length_levels(_sessions(spark, sf))


check("session_hour_lengths", "hourly",
      "SELECT session_id, day, hour, length_ms FROM hourly")(_hourly)


@check("hour_session_count", "hourly",
       "SELECT day, hour, count(*) AS session_count FROM hourly GROUP BY day, hour")
def hour_session_count(spark, sf):
    return ses.hour_session_count(_hourly(spark, sf))


@check("hour_session_length", "hourly", """
SELECT day, hour, CAST(sum(length_ms) // 1000 AS BIGINT) AS length_s
FROM hourly GROUP BY day, hour""")
def hour_session_length(spark, sf):
    return ses.hour_session_length(_hourly(spark, sf))


@check("hour_invalid_count", "hourly", """
SELECT day, hour, count(*) AS invalid_count FROM hourly WHERE length_ms < 1000
GROUP BY day, hour""")
def hour_invalid_count(spark, sf):
    return ses.hour_invalid_count(_hourly(spark, sf))


@check("session_visit_length_ratios", "sessions", """
SELECT band, count(*) AS session_count, count(*) / max(total) AS ratio FROM (
  SELECT CASE WHEN len < 1 THEN NULL WHEN len < 4 THEN '1s_4s' WHEN len < 7 THEN '4s_7s'
    WHEN len < 10 THEN '7s_10s' WHEN len < 30 THEN '10s_30s' WHEN len < 60 THEN '30s_60s'
    WHEN len < 180 THEN '1m_3m' WHEN len < 600 THEN '3m_10m' WHEN len < 1800 THEN '10m_30m'
    ELSE '30m' END AS band, (SELECT count(*) FROM sessions) AS total FROM sessions)
WHERE band IS NOT NULL GROUP BY band""")
def session_visit_length_ratios(spark, sf):
    return ses.session_visit_length_ratios(_sessions(spark, sf))


@check("session_step_length_ratios", "sessions", """
SELECT band, count(*) AS session_count, count(*) / max(total) AS ratio FROM (
  SELECT CASE WHEN n_actions <= 3 THEN '1_3' WHEN n_actions <= 6 THEN '4_6'
    WHEN n_actions <= 9 THEN '7_9' WHEN n_actions <= 29 THEN '10_29'
    WHEN n_actions <= 59 THEN '30_59' ELSE '60' END AS band,
    (SELECT count(*) FROM sessions) AS total FROM sessions) GROUP BY band""")
def session_step_length_ratios(spark, sf):
    return ses.session_step_length_ratios(_sessions(spark, sf))


@check("filter_invalid_sessions", "sessions",
       "SELECT session_id, n_actions, CAST(len AS DOUBLE) AS length_s FROM sessions WHERE len < 1")
def invalid_sessions(spark, sf):
    return filter_invalid_sessions(_sessions(spark, sf))


@check("session_aggr_json", "sessions hourly", _METRICS)
def session_aggr_json(spark, sf):
    hours = ses.session_hours(views.actions(spark, sf))
    return doc.session_aggr_json(ses.hours_to_sessions(hours), ses.hours_to_hourly(hours))


@check("sample_stratified", "keyed",
       "SELECT session_id, day, hour FROM keyed WHERE key < '0ccccccc'")
def sample_stratified(spark, sf):
    return smp.sample_stratified(_hourly(spark, sf), RATIO)


# With replacement: a key is drawn as often as the Poisson distribution says, i.e. at least n + 1 times if
# it lies below 1 minus the sum of exp(-r) r^k / k! for k up to n, as a share of the 32-bit keys.
@check("sample_stratified_poisson", "keyed", """
SELECT session_id, day, hour FROM keyed JOIN (
  SELECT n, 4294967296 * (1 - sum(exp(-0.05) * pow(0.05, n) / factorial(n)) OVER (ORDER BY n)) AS at_most
  FROM (SELECT CAST(unnest(range(0, 12)) AS INTEGER) AS n))
ON CAST('0x' || substr(key, 1, 8) AS BIGINT) < floor(at_most)""")
def sample_stratified_poisson(spark, sf):
    return smp.sample_stratified(_hourly(spark, sf), RATIO, "poisson")


@check("sample_floor_cap", "topup", "SELECT session_id, day, hour FROM topup")
def sample_floor_cap(spark, sf):
    return smp.sample_topup(_hourly(spark, sf), RATIO)


check("sample_sessions", "sample", "SELECT session_id, day, hour FROM sample")(_sample)


@check("union_distinct_samples", "keyed topup", """
SELECT session_id, day, hour FROM keyed WHERE key < '0ccccccc'
UNION SELECT session_id, day, hour FROM topup""")
def union_distinct_samples(spark, sf):
    hourly = _hourly(spark, sf)
    return smp.union_distinct_samples(
        smp.sample_stratified(hourly, RATIO), smp.sample_topup(hourly, RATIO))


@check("except_keys", "keyed", """
SELECT day, hour FROM keyed EXCEPT SELECT day, hour FROM keyed WHERE key < '0ccccccc'""")
def except_keys(spark, sf):
    hourly = _hourly(spark, sf)
    return smp.except_keys(hourly, smp.sample_stratified(hourly, RATIO), smp.HOUR)


@check("sample_count_bounded", "sample", """
SELECT day, hour, count(*) AS n_sampled,
  CASE WHEN count(*) < 50 THEN string_agg(session_id, ',' ORDER BY session_id) END AS session_ids
FROM sample GROUP BY day, hour""")
def sample_count_bounded(spark, sf):
    counts = smp.sample_count_bounded(_sample(spark, sf))
    return counts.withColumn("session_ids", F.array_join("session_ids", ","))


@check("sample_items", "hourly keyed", """
SELECT session_id, day, hour FROM (
  SELECT *, row_number() OVER (PARTITION BY day, hour
    ORDER BY md5(concat_ws('|', day, hour, session_id, 42)), session_id) AS rn
  FROM keyed WHERE key >= '0ccccccc') WHERE rn <= 4""")
def sample_items(spark, sf):
    hourly = _hourly(spark, sf)
    drawn = smp.sample_stratified(hourly, RATIO)
    chosen = smp.sample_items(hourly, smp.HOUR, "session_id", 4, exclude=drawn)
    return chosen.select(*smp.KEYS)


@check("session_sample_detail", "detail",
       "SELECT session_id, day, hour, action_time, page_id, user_id FROM detail")
def session_sample_detail(spark, sf):
    return _detail(spark, sf).select(
        "session_id", "day", "hour", "action_time", "page_id", "user_id")


@check("join_session_sample", "detail",
       "SELECT session_id, day, hour, action_time, page_id, user_id FROM detail")
def join_session_sample(spark, sf):
    detail = smp.session_sample_detail(views.actions(spark, sf), _sample(spark, sf))
    return detail.select("session_id", "day", "hour", "action_time", "page_id", "user_id")


@check("filter_hour_slice", "detail",
       "SELECT day, hour, count(*) AS n_actions, min(action_time) AS first_time, "
       "max(action_time) AS last_time FROM detail GROUP BY day, hour")
def filter_hour_slice(spark, sf):
    return _detail(spark, sf).groupBy("day", "hour").agg(
        F.count(F.lit(1)).alias("n_actions"),
        F.date_format(F.min("ts"), TIME_FORMAT).alias("first_time"),
        F.date_format(F.max("ts"), TIME_FORMAT).alias("last_time"),
    )


_TOP5 = """
SELECT session_id, day, hour, n_actions FROM (
  SELECT *, row_number() OVER (PARTITION BY day, hour ORDER BY n_actions DESC, session_id) AS rn
  FROM (SELECT session_id, day, hour, count(*) AS n_actions FROM detail
        GROUP BY session_id, day, hour)) WHERE rn <= 5"""


@check("hour_top5_sessions", "detail", _TOP5)
def hour_top5_sessions(spark, sf):
    return smp.hour_top_sessions(_detail(spark, sf))


@check("sample_record_json", "detail", f"""
SELECT '{{"session_id":"' || session_id || '","day":"' || day || '","hour":' || hour
  || ',"record":' || {_RECORD} || '}}' AS document FROM detail""")
def sample_record_json(spark, sf):
    return doc.sample_record_json(_detail(spark, sf))


_SESSION_ROWS = f"""
SELECT CAST(7 AS BIGINT) AS task_id, session_id, day, hour, {_RECORD} AS record
FROM detail JOIN ({_TOP5}) USING (session_id, day, hour)"""


@check("sample_session_rows", "detail", _SESSION_ROWS)
def sample_session_rows(spark, sf):
    actions = views.actions(spark, sf)
    hourly = ses.hours_to_hourly(ses.session_hours(actions))
    sample = smp.sample_sessions(hourly, RATIO, extra=("n_actions",))
    return doc.sample_session_rows(smp.with_hour(actions), smp.rank_hour_sessions(sample), 7)


# The whole job for some users and days, a query for each of its results.
_TASK = ("sex = 'male' AND professional IN ('BUILDING', 'MACHINERY', 'FURNITURE') "
         "AND date BETWEEN '2024-01-03' AND '2024-01-25'")
_PARAMS = {"startDate": "2024-01-03", "endDate": "2024-01-25", "sex": "male",
           "professionals": "BUILDING,MACHINERY,FURNITURE", "sessionRatio": RATIO}


def job_result(name: str, views_used: str, sql: str) -> None:
    def run(spark, sf):
        params = TaskParams.from_document(_PARAMS)
        job = analyse_sessions(views.actions(spark, sf), views.users(spark, sf), params, 7)
        job.release()
        return getattr(job, name)

    key = "job_session_analysis" if name == "metrics" else f"job_session_{name}"
    check(key, views_used, sql, only=_TASK)(run)


_SAMPLED_JSON = f"""
SELECT '{{"session_id":"' || session_id || '","day":"' || day || '","hour":' || hour
  || ',"record":' || {_RECORD} || '}}' AS document FROM detail"""

job_result("metrics", "sessions hourly", _METRICS)
job_result("sampled_records", "detail", _SAMPLED_JSON)
job_result("sampled_rows", "detail", _SESSION_ROWS)


# A table with unreadable times: the rows are listed, and counted among categories all the same.
@check("scan_rejected_actions", "actions", """
SELECT session_id, page_id, action_time || ' at noon' AS action_time, 'time:action_time' AS reason
FROM actions WHERE page_id % 7 = 0""")
def scan_rejected_actions(spark, sf):
    odd = F.when(F.col("page_id") % 7 == 0, F.concat("action_time", F.lit(" at noon"))).otherwise(F.col("action_time"))
    actions = views.actions(spark, sf).drop("ts").withColumn("action_time", odd)
    rejected = analyse_sessions(actions, None, TaskParams(), 7, keep=False).rejected
    return rejected.select("session_id", "page_id", "action_time", "reason")
