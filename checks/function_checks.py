"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import check
from visitlens.functions import business, numbers, text, times


def _events(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return views.table(spark, sf, "events").select(
        "event_id", "event_type", "value", "props", ts.alias("ts"), F.unix_millis(ts).alias("millis"),
        F.date_format(ts, times.TIME_FORMAT).alias("t"))


# Times are compared with a fixed one.
_FIXED = "2024-01-15 12:00:00"
_T = "strftime(ts, '%Y-%m-%d %H:%M:%S')"


@check("fn_format_millis", "", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, strftime(ts, '%Y-%m-%d') AS date,
  strftime(ts, '%Y%m%d') AS date_key, strftime(ts, '%Y%m%d%H%M%S') AS stamp FROM events""")
def fn_format_millis(spark, sf):
    m = F.col("millis")
    return _events(spark, sf).select(
        "event_id", times.format_millis(m).alias("time"),
        times.format_millis(m, times.DATE_FORMAT).alias("date"),
        times.format_millis(m, times.DATE_KEY_FORMAT).alias("date_key"),
        times.format_millis(m, times.BATCH_STAMP_FORMAT).alias("stamp"))


@check("fn_parse_time", "", """
SELECT event_id, epoch_ms(date_trunc('second', ts)) AS millis,
  epoch_ms(date_trunc('day', ts)) AS day_millis, CAST(NULL AS BIGINT) AS bad FROM events""")
def fn_parse_time(spark, sf):
    return _events(spark, sf).select(
        "event_id", times.parse_millis(F.col("t")).alias("millis"),
        times.parse_millis(F.substring("t", 1, 10), times.DATE_FORMAT).alias("day_millis"),
        times.parse_millis(F.col("event_type")).alias("bad"))


@check("fn_date_part", "", "SELECT event_id, " + ", ".join(
    f"CAST(date_part('{part}', ts) AS INTEGER)"
    + (" % 1000" if part == "millisecond" else "") + f" AS {part}"
    for part in times.DATE_PARTS) + " FROM events")
def fn_date_part(spark, sf):
    return _events(spark, sf).select(
        "event_id", *[times.date_part(F.col("millis"), p).alias(p) for p in times.DATE_PARTS])


@check("fn_time_before_after", "", f"""
SELECT event_id, {_T} < '{_FIXED}' AS before, {_T} > '{_FIXED}' AS after, false AS bad FROM events""")
def fn_time_before_after(spark, sf):
    t, fixed = F.col("t"), F.lit(_FIXED)
    return _events(spark, sf).select(
        "event_id", times.is_before(t, fixed).alias("before"), times.is_after(t, fixed).alias("after"),
        times.is_before(F.col("event_type"), fixed).alias("bad"))


@check("fn_seconds_between", "", f"""
SELECT event_id, CAST(epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '{_FIXED}') AS INTEGER) AS seconds,
  0 AS bad FROM events""")
def fn_seconds_between(spark, sf):
    fixed = F.lit(_FIXED)
    return _events(spark, sf).select(
        "event_id", times.seconds_between(F.col("t"), fixed).alias("seconds"),
        times.seconds_between(F.col("event_type"), fixed).alias("bad"))


@check("fn_date_hour", "", "SELECT event_id, strftime(ts, '%Y-%m-%d_%H') AS date_hour FROM events")
def fn_date_hour(spark, sf):
    return _events(spark, sf).select("event_id", times.date_hour(F.col("t")).alias("date_hour"))


@check("fn_today_yesterday", "", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS today, strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS yesterday,
  CAST(1 AS BIGINT) AS days FROM events""")
def fn_today_yesterday(spark, sf):
    day = F.to_date("ts")
    # Without a date it is the session's: the two are a day apart.
    days = F.datediff(times.today().cast("date"), times.yesterday().cast("date")).cast("bigint")
    return _events(spark, sf).select(
        "event_id", times.today(day).alias("today"), times.yesterday(day).alias("yesterday"), days.alias("days"))


@check("fn_minute_key", "", "SELECT event_id, strftime(ts, '%Y%m%d%H%M') AS minute_key FROM events")
def fn_minute_key(spark, sf):
    return _events(spark, sf).select("event_id", times.minute_key(F.col("ts")).alias("minute_key"))


# 1.115 cents style halves are decided on the decimal rendering, so the SQL rounds a decimal.
@check("fn_round_half_up", "", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
  CAST(round(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(18, 4)), 1) AS DOUBLE) AS rounded,
  CAST(round(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(18, 4)) * 0.125, 2) AS DOUBLE) AS eighth
FROM lineitem""")
def fn_round_half_up(spark, sf):
    return views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        numbers.round_half_up(F.col("l_extendedprice"), 1).alias("rounded"),
        numbers.round_half_up(F.col("l_extendedprice") / 8).alias("eighth"))


@check("fn_plain_number", "", r"""
SELECT l_orderkey, l_linenumber, l_extendedprice,
  regexp_replace(CAST(CAST(l_extendedprice AS DECIMAL(38, 3)) AS VARCHAR), '\.?0+$', '') AS plain
FROM lineitem""")
def fn_plain_number(spark, sf):
    return views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        numbers.plain_number(F.col("l_extendedprice")).alias("plain"))


@check("fn_is_empty", "", """
SELECT doc_id, coalesce(trim(text), '') = '' AS is_empty,
  length(text) > 0 AND split_part(text, ' ', 2) = '' AS one_word FROM documents""")
def fn_is_empty(spark, sf):
    second = F.split_part("text", F.lit(" "), F.lit(2))
    return views.table(spark, sf, "documents").select(
        "doc_id", text.is_empty(F.col("text")).alias("is_empty"),
        ((F.length("text") > 0) & text.is_empty(second)).alias("one_word"))


@check("fn_trim_comma", "", """
SELECT doc_id, CASE WHEN text = ',' THEN '' ELSE regexp_replace(regexp_replace(text, '^,', ''), ',$', '') END AS plain,
  text AS restored FROM documents""")
def fn_trim_comma(spark, sf):
    wrapped = F.concat(F.lit(","), "text", F.lit(","))
    return views.table(spark, sf, "documents").select(
        "doc_id", text.trim_comma(F.col("text")).alias("plain"),
        text.trim_comma(wrapped).alias("restored"))


@check("fn_pad2", "", """
SELECT event_id, CASE WHEN length(k) = 2 THEN k ELSE '0' || k END AS padded,
  CASE WHEN length(event_type) = 2 THEN event_type ELSE '0' || event_type END AS padded_type
FROM (SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events)""")
def fn_pad2(spark, sf):
    return _events(spark, sf).select(
        "event_id", text.pad2(text.json_string(F.col("props"), "k")).alias("padded"),
        text.pad2(F.col("event_type")).alias("padded_type"))


def _fields(spark, sf):
    data = F.concat(F.lit("id="), "event_id", F.lit("|kind="), "event_type", F.lit("|none=|id=again"))
    return _events(spark, sf).select("event_id", "event_type", data.alias("data"))


@check("fn_get_field", "", """
SELECT event_id, CAST(event_id AS VARCHAR) AS id, event_type AS kind, CAST(NULL AS VARCHAR) AS none,
  CAST(NULL AS VARCHAR) AS unknown FROM events""")
def fn_get_field(spark, sf):
    data = F.col("data")
    return _fields(spark, sf).select(
        "event_id", *[text.get_field(data, f).alias(f) for f in ("id", "kind", "none", "unknown")])


@check("fn_set_field", "", """
SELECT event_id, concat('id=7|kind=', event_type, '|none=|id=again') AS id_set,
  concat('id=', event_id, '|kind=', event_type, '|none=x|id=again') AS none_set,
  concat('id=', event_id, '|kind=', event_type, '|none=|id=again') AS unknown_set FROM events""")
def fn_set_field(spark, sf):
    data = F.col("data")
    return _fields(spark, sf).select(
        "event_id", text.set_field(data, "id", "7").alias("id_set"),
        text.set_field(data, "none", "x").alias("none_set"),
        text.set_field(data, "unknown", "x").alias("unknown_set"))


@check("fn_json_string", "", """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS absent FROM events""")
def fn_json_string(spark, sf):
    props = F.col("props")
    return _events(spark, sf).select(
        "event_id", text.json_string(props, "k").alias("k"), text.json_string(props, "q").alias("absent"))


_AREAS = ("华东", "华南", "华北", "东北", "华中", "西南", "西北", "其它")


@check("fn_area_level", "", """
SELECT c_custkey, name AS area, CASE WHEN name IN ('华东', '华南', '华北') THEN 'A' WHEN name = '东北' THEN 'B'
  WHEN name IN ('华中', '西南') THEN 'C' WHEN name = '西北' THEN 'D' ELSE 'E' END AS level
FROM (SELECT c_custkey,
  ['华东', '华南', '华北', '东北', '华中', '西南', '西北', '其它'][c_nationkey % 8 + 1] AS name FROM customer)""")
def fn_area_level(spark, sf):
    names = F.array(*[F.lit(a) for a in _AREAS])
    area = F.get(names, F.col("c_nationkey") % 8)
    return views.table(spark, sf, "customer").select("c_custkey", area.alias("area")).withColumn(
        "level", business.area_level(F.col("area")))


@check("fn_product_type", "product_info", """
SELECT product_id, CASE WHEN json_extract_string(extend_info, '$.product_type') = '0' THEN '自营商品'
  ELSE '第三方商品' END AS product_type FROM product_info""")
def fn_product_type(spark, sf):
    return views.products(spark, sf).select(
        "product_id", business.product_type(F.col("extend_info")).alias("product_type"))
