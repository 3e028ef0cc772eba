"""Products per area."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import check
from visitlens.functions.text import concat_id_name
from visitlens.operators import products as prod
from visitlens.params import TaskParams
from visitlens.plans.area_products import analyse_area_products

_COUNTS = """
  SELECT area, click_product_id AS product_id, CAST(sum(n) AS BIGINT) AS click_count,
    string_agg(concat_ws(':', city_id, city_name, n), ',' ORDER BY city_id) AS city_infos
  FROM (SELECT area, click_product_id, city_id, city_name, count(*) AS n
        FROM {clicks} JOIN city_info USING (city_id) GROUP BY ALL)
  GROUP BY area, click_product_id"""

_RANKED = """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY area
    ORDER BY click_count DESC, CAST(product_id AS BIGINT)) AS rn FROM ({counts})) WHERE rn <= 10"""

_REPORT = """
SELECT area,
  CASE WHEN area IN ('华东', '华南', '华北') THEN 'A' WHEN area = '东北' THEN 'B'
    WHEN area IN ('华中', '西南') THEN 'C' WHEN area = '西北' THEN 'D' ELSE 'E' END AS area_level,
  r.product_id, city_infos, click_count, product_name,
  CASE WHEN json_extract_string(extend_info, '$.product_type') = '0' THEN '自营商品'
    ELSE '第三方商品' END AS product_type
FROM ({ranked}) r JOIN product_info p ON CAST(r.product_id AS BIGINT) = p.product_id"""

_CLICKED = "(SELECT * FROM actions WHERE click_product_id <> '')"
_BIG = _COUNTS.format(clicks="order_clicks")
_SMALL = _COUNTS.format(clicks=_CLICKED)


def _clicks(spark, sf):
    return prod.product_clicks(views.actions(spark, sf))


@check("area_top10_products", "order_clicks city_info product_info",
       _REPORT.format(ranked=_RANKED.format(counts=_BIG)))
def area_top10_products(spark, sf):
    return prod.area_top_products_of_clicks(
        views.order_clicks(spark, sf), views.cities(spark, sf), views.products(spark, sf))


@check("job_area_top_products", "actions city_info product_info", _REPORT.format(
    ranked=_RANKED.format(counts=_COUNTS.format(
        clicks="(SELECT * FROM actions WHERE click_product_id <> '' "
               "AND date >= '2024-01-05' AND date <= '2024-01-20')"))))
def job_area_top_products(spark, sf):
    params = TaskParams.from_document({"startDate": "2024-01-05", "endDate": "2024-01-20"})
    return analyse_area_products(
        views.actions(spark, sf), views.cities(spark, sf), views.products(spark, sf), params)


@check("join_action_city", "actions city_info", f"""
SELECT city_id, click_product_id, city_name, area FROM {_CLICKED} JOIN city_info USING (city_id)""")
def join_action_city(spark, sf):
    return prod.product_basic(_clicks(spark, sf), views.cities(spark, sf))


@check("project_product_basic", "order_clicks city_info", """
SELECT city_id, click_product_id, city_name, area FROM order_clicks JOIN city_info USING (city_id)""")
def project_product_basic(spark, sf):
    return prod.product_basic(views.order_clicks(spark, sf), views.cities(spark, sf))


@check("area_product_count", "actions city_info",
       f"SELECT area, product_id, click_count FROM ({_SMALL})")
def area_product_count(spark, sf):
    counts = prod.area_product_count(_clicks(spark, sf), views.cities(spark, sf))
    return counts.select("area", "product_id", "click_count")


@check("group_concat_distinct_count", "order_clicks city_info", _BIG)
def group_concat_distinct_count(spark, sf):
    return prod.area_product_count(views.order_clicks(spark, sf), views.cities(spark, sf))


@check("join_top_product", "actions city_info product_info", f"""
SELECT area, r.product_id, click_count, product_name, extend_info
FROM ({_RANKED.format(counts=_SMALL)}) r JOIN product_info p
ON CAST(r.product_id AS BIGINT) = p.product_id""")
def join_top_product(spark, sf):
    counts = prod.area_product_count(_clicks(spark, sf), views.cities(spark, sf))
    joined = prod.join_top_product(prod.rank_area_products(counts), views.products(spark, sf))
    return joined.select("area", "product_id", "click_count", "product_name", "extend_info")


# The SQL names, with blanks of all kinds and the word null among the ids, as one report per area and product.
@check("sql_functions", "actions city_info", """
WITH odd AS (
  SELECT *, CASE WHEN page_id % 5 = 0 THEN chr(9) || click_product_id || chr(10) WHEN page_id % 5 = 1 THEN chr(9) || chr(10)
    WHEN page_id % 5 = 2 THEN chr(9) || 'Null' || chr(13) ELSE click_product_id END AS id FROM actions),
counted AS (
  SELECT area, trim(id, chr(9) || chr(10)) AS product_id, city_id, city_name, count(*) AS n
  FROM odd JOIN city_info USING (city_id)
  WHERE trim(id, chr(9) || chr(10) || chr(13)) <> '' AND lower(trim(id, chr(9) || chr(10) || chr(13))) <> 'null'
  GROUP BY ALL)
SELECT area, product_id, CAST(sum(n) AS BIGINT) AS click_count,
  string_agg(concat_ws(':', city_id, city_name, n), ',' ORDER BY city_id) AS city_infos,
  string_agg(concat_ws(':', city_id, city_name), ',' ORDER BY city_id) AS cities, '7' AS field
FROM counted GROUP BY area, product_id""")
def sql_functions(spark, sf):
    from visitlens.functions.sql_names import register_sql_functions

    register_sql_functions(spark)
    page = F.col("page_id") % 5
    odd = (F.when(page == 0, F.concat(F.lit("\t"), "click_product_id", F.lit("\n"))).when(page == 1, "\t\n")
           .when(page == 2, "\tNull\r").otherwise(F.col("click_product_id")))
    joined = views.actions(spark, sf).withColumn("id", odd).join(views.cities(spark, sf), "city_id")
    joined.createOrReplaceTempView("sql_functions_clicks")
    return spark.sql("""
      SELECT area, product_id, sum(n) AS click_count,
        listagg(id_name_count(city_id, city_name, n), ',') WITHIN GROUP (ORDER BY city_id) AS city_infos,
        listagg(concat_id_name(city_id, city_name), ',') WITHIN GROUP (ORDER BY city_id) AS cities,
        json_string('{"a":"7"}', 'a') AS field
      FROM (SELECT area, btrim(id, concat(chr(9), chr(10))) AS product_id, city_id, city_name, count(*) AS n
            FROM sql_functions_clicks WHERE is_not_empty(id) GROUP BY ALL)
      GROUP BY area, product_id""")


@check("fn_concat_id_name", "", """
SELECT c_custkey, concat(c_custkey, ':', c_name) AS id_name FROM customer""")
def fn_concat_id_name(spark, sf):
    return views.table(spark, sf, "customer").select(
        "c_custkey", concat_id_name(F.col("c_custkey"), F.col("c_name")).alias("id_name"))
