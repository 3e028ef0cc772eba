"""Sources, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import check
from visitlens.functions.text import is_not_empty
from visitlens.operators import filters as flt
from visitlens.params import TaskParams
from visitlens.sources import tables as src
from visitlens.sources import text
from visitlens.sources.schemas import ACTION_COLUMNS, ACTION_SCHEMA, columns_of

_ACTION_LIST = ", ".join(ACTION_COLUMNS)
_USER_LIST = "user_id, user_name, name, age, professional, city, sex"


def _lines(df, sep: str):
    return df.select(F.concat_ws(sep, *df.columns).alias("value"))


def _action_lines(spark, sf):
    return _lines(views.actions(spark, sf).select(*ACTION_COLUMNS), ",")


@check("scan_action_log", "actions", f"SELECT {_ACTION_LIST}, epoch_ms(sec) AS millis FROM actions")
def scan_action_log(spark, sf):
    good, _ = text.parse_actions(_action_lines(spark, sf))
    return good.select(*ACTION_COLUMNS, F.unix_millis("ts").alias("millis"))


@check("scan_user_info", "user_info", f"SELECT {_USER_LIST} FROM user_info")
def scan_user_info(spark, sf):
    return text.parse_users(_lines(views.users(spark, sf), ","))[0]


@check("scan_product_info", "product_info",
       "SELECT product_id, product_name, extend_info FROM product_info")
def scan_product_info(spark, sf):
    return text.parse_products(_lines(views.products(spark, sf), "^"))[0]


# Prose and well-formed action lines in one log: the prose is rejected, with its reason.
_TOKENS = "string_split(rtrim(value, ','), ',')"
_NUMBERS = [(i + 1, name) for i, (name, kind) in enumerate(columns_of(ACTION_SCHEMA)) if kind != "string"]


@check("scan_rejected_lines", "actions", f"""
SELECT reason, count(*) AS n, CAST(sum(length(value)) AS BIGINT) AS characters FROM (
  SELECT value, CASE WHEN len(tokens) <> 13 THEN 'width' """ + " ".join(
    f"WHEN TRY_CAST(tokens[{i}] AS BIGINT) IS NULL THEN 'number:{name}'" for i, name in _NUMBERS
    if name in ("user_id", "page_id")) + f"""
    WHEN try_strptime(tokens[5], '%Y-%m-%d %H:%M:%S') IS NULL THEN 'time:action_time'
    WHEN TRY_CAST(tokens[13] AS BIGINT) IS NULL THEN 'number:city_id' END AS reason
  FROM (SELECT value, {_TOKENS} AS tokens FROM (
    SELECT text AS value FROM documents
    UNION ALL SELECT concat_ws(',', {_ACTION_LIST}) FROM actions)))
WHERE reason IS NOT NULL GROUP BY reason""")
def scan_rejected_lines(spark, sf):
    prose = views.table(spark, sf, "documents").select(F.col("text").alias("value"))
    _, rejected = text.parse_actions(prose.unionByName(_action_lines(spark, sf)))
    return rejected.groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("characters"))


@check("scan_catalog_table", "actions", """
SELECT session_id, page_id, action_time FROM actions WHERE date >= '2024-01-10' AND city_id = 3""")
def scan_catalog_table(spark, sf):
    views.actions(spark, sf).createOrReplaceTempView("user_visit_action")
    return src.scan_catalog_table(
        spark, "user_visit_action", ["session_id", "page_id", "action_time"],
        F.col("date") >= "2024-01-10", F.col("city_id") == 3)


@check("project_action_record", "actions", f"SELECT {_ACTION_LIST} FROM actions")
def project_action_record(spark, sf):
    return src.project_action_record(views.actions(spark, sf))


@check("filter_date_range", "actions",
       f"SELECT {_ACTION_LIST} FROM actions WHERE date >= '2024-01-05' AND date <= '2024-01-20'")
def filter_date_range(spark, sf):
    kept = flt.filter_date_range(views.actions(spark, sf), "2024-01-05", "2024-01-20")
    return kept.select(*ACTION_COLUMNS)


@check("filter_sex", "user_info", f"SELECT {_USER_LIST} FROM user_info WHERE sex = 'female'")
def filter_sex(spark, sf):
    return flt.filter_sex(views.users(spark, sf), "female")


@check("filter_professionals", "user_info",
       f"SELECT {_USER_LIST} FROM user_info WHERE professional IN ('BUILDING', 'MACHINERY')")
def filter_professionals(spark, sf):
    params = TaskParams.from_document({"professionals": " BUILDING ,, MACHINERY,"})
    return flt.filter_professionals(views.users(spark, sf), params.professionals)


@check("filter_actions_by_task", "actions user_info", f"""
SELECT {_ACTION_LIST} FROM actions JOIN (
  SELECT user_id FROM user_info WHERE sex = 'male' AND professional IN ('BUILDING', 'MACHINERY'))
USING (user_id) WHERE date >= '2024-01-05' AND date <= '2024-01-20'""")
def filter_actions_by_task(spark, sf):
    params = TaskParams.from_document(
        '{"startDate": "2024-01-05", "endDate": "2024-01-20", "sex": "male",'
        ' "professionals": "BUILDING,MACHINERY", "cities": " "}')
    kept = flt.filter_actions_by_task(views.actions(spark, sf), views.users(spark, sf), params)
    return kept.select(*ACTION_COLUMNS)


@check("filter_age_city_keyword_category", "actions user_info", f"""
SELECT {_ACTION_LIST} FROM actions JOIN (
  SELECT user_id FROM user_info
  WHERE age BETWEEN 20 AND 40 AND city IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_19'))
USING (user_id) WHERE click_category_id IN ('10', '11', '12', '13')
  OR list_has_any(string_split(order_category_ids, '|'), ['10', '11', '12', '13'])
  OR list_has_any(string_split(pay_category_ids, '|'), ['10', '11', '12', '13'])""")
def filter_age_city_keyword_category(spark, sf):
    params = TaskParams.from_document({
        "startAge": 20, "endAge": 40, "cities": "NATION_1,NATION_2,NATION_3,NATION_19",
        "categoryIds": "10,11,12,13"})
    kept = flt.filter_actions_by_task(views.actions(spark, sf), views.users(spark, sf), params)
    return kept.select(*ACTION_COLUMNS)


@check("filter_keywords", "actions",
       f"SELECT {_ACTION_LIST} FROM actions WHERE search_keyword IN ('kw_3', 'kw_7')")
def filter_keywords(spark, sf):
    return flt.filter_keywords(views.actions(spark, sf), ("kw_3", "kw_7")).select(*ACTION_COLUMNS)


@check("join_action_user", "actions user_info", """
SELECT session_id, action_time, page_id, user_id, sex, professional
FROM actions JOIN user_info USING (user_id)""")
def join_action_user(spark, sf):
    joined = flt.join_action_user(views.actions(spark, sf), views.users(spark, sf))
    return joined.select("session_id", "action_time", "page_id", "user_id", "sex", "professional")


@check("filter_is_not_empty", "", """
SELECT doc_id, text FROM documents WHERE trim(text) <> '' AND lower(trim(text)) <> 'null'""")
def filter_is_not_empty(spark, sf):
    return views.table(spark, sf, "documents").where(is_not_empty(F.col("text"))).select("doc_id", "text")


# Sessions as k=v|k=v text, as the parameter filters expect them.
_CONCAT = """(SELECT user_id, concat('sex=', sex, '|age=', age, '|job=', professional, ',', city, '|empty=')
  AS data, age, sex, professional, city FROM user_info)"""


def _concat(spark, sf):
    users = views.users(spark, sf)
    data = F.concat(F.lit("sex="), "sex", F.lit("|age="), "age", F.lit("|job="), "professional",
                    F.lit(","), "city", F.lit("|empty="))
    return users.select("user_id", data.alias("data"))


@check("filter_between_param", "user_info",
       f"SELECT user_id, data FROM {_CONCAT} WHERE age BETWEEN 20 AND 30")
def filter_between_param(spark, sf):
    return flt.filter_between_param(_concat(spark, sf), "data", "age", "from=20|to=30", "from", "to")


@check("filter_in_param", "user_info", f"""
SELECT user_id, data FROM {_CONCAT}
WHERE professional IN ('BUILDING', 'NATION_4') OR city IN ('BUILDING', 'NATION_4')""")
def filter_in_param(spark, sf):
    return flt.filter_in_param(_concat(spark, sf), "data", "job", "jobs=BUILDING,NATION_4", "jobs")


@check("filter_equal_param", "user_info", f"SELECT user_id, data FROM {_CONCAT} WHERE sex = 'male'")
def filter_equal_param(spark, sf):
    return flt.filter_equal_param(_concat(spark, sf), "data", "sex", "who=male", "who")
