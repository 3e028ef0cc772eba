"""Stored tables, parametrised SQL, SQL table functions, variants, observed counts and state read as a table."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks import views
from checks.registry import check
from checks.source_checks import _ACTION_LIST, _action_lines
from visitlens.functions import variants
from visitlens.functions.sql_names import create_area_product_function
from visitlens.operators import sampling
from visitlens.params import TaskParams
from visitlens.session import scratch_path, write_shared
from visitlens.sinks.action_table import join_by_session, write_action_table, write_session_table
from visitlens.sources import tables as src
from visitlens.sources.clicks import file_lines, parse_ad_click
from visitlens.sources.observed import StreamTotals, observed_actions, observed_clicks
from visitlens.sources.schemas import ACTION_COLUMNS
from visitlens.streaming import ad_realtime as rt

BUCKETS = 4


def _name(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


def stored_actions(spark, sf, label="actions", buckets=BUCKETS):
    """Name of a catalog table of the actions, with ``ts``; its files lie in the shared folder."""
    path = scratch_path(spark, label)
    write_action_table(views.actions(spark, sf), _name(path), path, buckets)
    return _name(path)


def _stored(spark, df, label):
    path = scratch_path(spark, label)
    df.write.option("path", path).saveAsTable(_name(path))
    return _name(path)


# Actions stored by date and session, then scanned for a range of dates.
@check("stored_action_scan", "actions", """
SELECT date, session_id, page_id, action_time FROM actions
WHERE date >= '2024-01-10' AND date <= '2024-01-12' AND city_id = 3""")
def stored_action_scan(spark, sf):
    return src.scan_catalog_table(
        spark, stored_actions(spark, sf), ["date", "session_id", "page_id", "action_time"],
        F.col("date") >= "2024-01-10", F.col("date") <= "2024-01-12", F.col("city_id") == 3)


# Both sides of the sample's join stored in the same buckets.
@check("stored_session_join", "actions hourly need", """
SELECT a.session_id, a.day, CAST(a.hour AS INTEGER) AS hour, page_id, action_time
FROM actions a JOIN hourly h ON a.session_id = h.session_id AND a.day = h.day AND a.hour = h.hour
WHERE md5(concat_ws('|', h.session_id, h.day, h.hour, 42)) < '20'""")
def stored_session_join(spark, sf):
    actions, sessions = (scratch_path(spark, label) for label in ("hours", "sessions"))
    detail = sampling.with_hour(views.actions(spark, sf))
    write_action_table(detail, _name(actions), actions, BUCKETS)
    chosen = detail.select("session_id", "day", "hour").distinct().where(
        F.md5(F.concat_ws("|", "session_id", "day", "hour", F.lit(42))) < "20")
    write_session_table(chosen, _name(sessions), sessions, BUCKETS)
    joined = join_by_session(spark.table(_name(actions)), spark.table(_name(sessions)), "day", "hour")
    return joined.select("session_id", "day", "hour", "page_id", "action_time")


# Dates chosen in another table: the Mondays of a calendar made of the dates that occur.
@check("stored_chosen_dates", "actions", """
SELECT date, session_id, action_time FROM actions WHERE dayofweek(CAST(date AS DATE)) = 1""")
def stored_chosen_dates(spark, sf):
    calendar = views.actions(spark, sf).select("date").distinct().withColumn("weekday", F.dayofweek(F.to_date("date")))
    days = spark.table(_stored(spark, calendar, "calendar")).where("weekday = 2")
    return src.scan_chosen_dates(spark, stored_actions(spark, sf), days, ["date", "session_id", "action_time"])


# All filters of a task as one statement; odd values are plain values.
@check("filter_actions_sql", "actions user_info", f"""
SELECT {_ACTION_LIST} FROM actions
WHERE date >= '2024-01-05' AND date <= '2024-01-20' AND search_keyword IN ('kw_3', 'it''s, ''odd''', 'kw_7')
  AND user_id IN (SELECT user_id FROM user_info WHERE sex = 'male' AND age >= 20
    AND professional IN ('BUILDING', 'MACHINERY', '''; --'))""")
def filter_actions_sql(spark, sf):
    params = TaskParams(start_date="2024-01-05", end_date="2024-01-20", sex="male", start_age=20,
                        keywords=("kw_3", "it's, 'odd'", "kw_7"), professionals=("BUILDING", "MACHINERY", "'; --"))
    users = _stored(spark, views.users(spark, sf), "users")
    return src.filter_actions_sql(spark, stored_actions(spark, sf), users, params).select(*ACTION_COLUMNS)


# The report per area and product under one SQL name, called from another session.
@check("sql_area_product_count", "actions city_info", """
SELECT area, click_product_id AS product_id, CAST(sum(n) AS BIGINT) AS click_count,
  string_agg(concat_ws(':', city_id, city_name, n), ',' ORDER BY city_id) AS city_infos
FROM (SELECT area, click_product_id, city_id, city_name, count(*) AS n
      FROM (SELECT * FROM actions WHERE click_product_id <> '' AND date >= '2024-01-05' AND date <= '2024-01-20')
      JOIN city_info USING (city_id) GROUP BY ALL)
GROUP BY area, click_product_id""")
def sql_area_product_count(spark, sf):
    actions = stored_actions(spark, sf, "area_product_count")
    name = f"f_{actions}"
    create_area_product_function(spark, actions, _stored(spark, views.cities(spark, sf), "cities"), name)
    return spark.newSession().sql(f"SELECT * FROM {name}('2024-01-05', '2024-01-20')")


# Product documents with nested fields, numbers beside texts and, for each seventh, no JSON; stored as variants.
_DOCUMENT = """concat('{"product_type":', CASE WHEN p_size % 3 = 0 THEN '0' ELSE concat('"', p_size % 2, '"') END,
  ',"size":{"cm":', p_size, ',"unit":"cm"},"tags":["', p_type, '","', p_brand, '"]', CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '}' END)"""


@check("variant_product_fields", "", f"""
SELECT p_partkey AS product_id, CASE WHEN json_extract_string(d, '$.product_type') = '0' THEN '自营商品'
    ELSE '第三方商品' END AS product_type,
  CAST(json_extract_string(d, '$.size.cm') AS BIGINT) AS cm, json_extract_string(d, '$.tags[1]') AS brand,
  json_extract_string(d, '$.none') AS absent, d IS NULL AS malformed
FROM (SELECT p_partkey, CASE WHEN json_valid(d) THEN d END AS d FROM (SELECT p_partkey, {_DOCUMENT} AS d FROM part))""")
def variant_product_fields(spark, sf):
    parts = views.table(spark, sf, "part").selectExpr("p_partkey AS product_id", f"{_DOCUMENT} AS extend_info")
    stored, _ = write_shared(variants.with_variant(parts, "extend_info", "info").drop("extend_info"), "variants")
    info = F.col("info")
    return stored.select(
        "product_id", variants.product_type_of(info).alias("product_type"), variants.field(info, "$.size.cm", "bigint").alias("cm"),
        variants.field(info, "$.tags[1]").alias("brand"), variants.field(info, "$.none").alias("absent"),
        info.isNull().alias("malformed"))


# The sampled record as a variant object: typed fields instead of text in text.
@check("variant_sample_record", "actions", "SELECT session_id, page_id, city_id, search_keyword FROM actions WHERE city_id = 7")
def variant_sample_record(spark, sf):
    rows = views.actions(spark, sf).where("city_id = 7").select(
        "session_id", variants.record_variant(*ACTION_COLUMNS).alias("record"))
    stored, _ = write_shared(rows, "records")
    record = F.col("record")
    return stored.select(
        "session_id", variants.field(record, "$.page_id", "bigint").alias("page_id"),
        variants.field(record, "$.city_id", "int").alias("city_id"), variants.field(record, "$.search_keyword").alias("search_keyword"))


# Prose and action lines in one log, counted by the pass that writes the good ones.
@check("observed_action_lines", "actions", """
WITH lines AS (SELECT text AS value FROM documents
  UNION ALL SELECT concat_ws(',', """ + _ACTION_LIST + """) FROM actions),
judged AS (
  SELECT CASE WHEN len(tokens) <> 13 THEN 'width' WHEN TRY_CAST(tokens[2] AS BIGINT) IS NULL THEN 'number:user_id'
    WHEN TRY_CAST(tokens[4] AS BIGINT) IS NULL THEN 'number:page_id'
    WHEN try_strptime(tokens[5], '%Y-%m-%d %H:%M:%S') IS NULL THEN 'time:action_time'
    WHEN TRY_CAST(tokens[13] AS BIGINT) IS NULL THEN 'number:city_id' ELSE 'accepted' END AS reason
  FROM (SELECT string_split(rtrim(value, ','), ',') AS tokens FROM lines WHERE value IS NOT NULL))
SELECT reason, count(*) AS n FROM judged GROUP BY reason
UNION ALL SELECT 'written', count(*) FROM actions""")
def observed_action_lines(spark, sf):
    prose = views.table(spark, sf, "documents").select(F.col("text").alias("value")).where("value IS NOT NULL")
    observation = Observation("lines")
    written, _ = write_shared(observed_actions(prose.unionByName(_action_lines(spark, sf)), observation), "accepted")
    counts = [(reason, n) for reason, n in observation.get.items() if n]
    return spark.createDataFrame(counts, "reason string, n bigint").unionByName(
        written.agg(F.count(F.lit(1)).alias("n")).select(F.lit("written").alias("reason"), "n"))


# The same on a stream of clicks and prose, from the progress of its batches.
@check("observed_click_stream", "clicks", """
SELECT CASE WHEN len(tokens) <> 5 THEN 'width'
    WHEN TRY_CAST(tokens[1] AS BIGINT) IS NULL THEN 'number:timestamp'
    WHEN TRY_CAST(tokens[4] AS INTEGER) IS NULL THEN 'number:user_id'
    WHEN TRY_CAST(tokens[5] AS INTEGER) IS NULL THEN 'number:ad_id' ELSE 'accepted' END AS reason, count(*) AS n
FROM (SELECT string_split(value, ' ') AS tokens FROM (
  SELECT concat_ws(' ', timestamp, province, city, user_id, ad_id) AS value FROM clicks
  UNION ALL SELECT concat_ws(' ', c_custkey, c_name, c_mktsegment, c_nationkey, 'x') FROM customer
  UNION ALL SELECT concat_ws(' ', c_custkey, c_nationkey) FROM customer)) GROUP BY reason""")
def observed_click_stream(spark, sf):
    root = scratch_path(spark, "observed")
    customer = views.table(spark, sf, "customer")
    parts = (views.click_lines(views.clicks(spark, sf)),
             customer.select(F.concat_ws(" ", "c_custkey", "c_name", "c_mktsegment", "c_nationkey", F.lit("x")).alias("value")),
             customer.select(F.concat_ws(" ", "c_custkey", "c_nationkey").alias("value")))
    totals = StreamTotals()
    spark.streams.addListener(totals)
    try:
        for part in parts:
            part.write.mode("append").text(f"{root}/lines")
            query = (observed_clicks(file_lines(spark, f"{root}/lines"), "clicks").writeStream.format("parquet")
                     .option("path", f"{root}/clicks").option("checkpointLocation", f"{root}/checkpoint")
                     .trigger(availableNow=True).start())
            query.awaitTermination()
            totals.wait_for(query)
    finally:
        spark.streams.removeListener(totals)
    return spark.createDataFrame(sorted(totals.counts("clicks").items()), "reason string, n bigint")


# Totals read from the state after a restart, and the table rebuilt from it after its files are lost.
@check("stream_state_totals", "daily", """
SELECT 'state' AS origin, date, province, city, ad_id, click_count FROM daily
UNION ALL SELECT 'rebuilt', date, province, city, ad_id, click_count FROM daily""")
def stream_state_totals(spark, sf):
    root = scratch_path(spark, "state")
    tables, clicks, checkpoint = rt.AdTables(f"{root}/tables"), views.clicks(spark, sf), f"{root}/checkpoint"
    for condition in ("ts < TIMESTAMP '2024-01-16'", "ts >= TIMESTAMP '2024-01-16'"):
        views.click_lines(clicks.where(condition)).write.mode("append").text(f"{root}/lines")
        rt.start_totals(parse_ad_click(file_lines(spark, f"{root}/lines")), tables, checkpoint, top=None,
                        watermark="100 days", trigger={"availableNow": True},
                        state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    lost = rt.AdTables(f"{root}/rebuilt")
    rt.rebuild_totals(spark, lost, checkpoint)
    return rt.state_totals(spark, checkpoint).withColumn("origin", F.lit("state")).unionByName(
        rt.read_totals(spark, lost).withColumn("origin", F.lit("rebuilt")))
