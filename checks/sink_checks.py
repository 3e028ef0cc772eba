"""Sinks, read back from the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import check
from checks.session_checks import RATIO
from visitlens.operators import products as prod
from visitlens.operators import sampling as smp
from visitlens.operators import sessions as ses
from visitlens.plans.area_products import REPORT_KEYS, REPORT_SCHEMA, write_report
from visitlens.session import scratch_path
from visitlens.sinks.files import write_json_lines
from visitlens.sinks.upsert import compact, read_latest, upsert
from visitlens.sources.schemas import ACTION_COLUMNS, ACTION_SCHEMA


@check("sink_json_lines", "detail", f"SELECT {', '.join(ACTION_COLUMNS)} FROM detail")
def sink_json_lines(spark, sf):
    actions = views.actions(spark, sf)
    detail = smp.sampled_actions(actions, ses.session_hour_lengths(actions), RATIO)
    path = scratch_path(spark, "sample-json")
    write_json_lines(detail.select(*ACTION_COLUMNS), path)
    return spark.read.schema(ACTION_SCHEMA).json(path).select(*ACTION_COLUMNS)


# Clicks per product first, then orders per product: the later batch wins where both have a key.
@check("sink_upsert", "actions", """
SELECT product_id, coalesce(o.n, c.n) AS n, CASE WHEN o.n IS NULL THEN 'click' ELSE 'order' END AS kind
FROM (SELECT click_product_id AS product_id, count(*) AS n FROM actions
      WHERE click_product_id <> '' GROUP BY 1) c
FULL JOIN (SELECT product_id, count(*) AS n FROM (
        SELECT unnest(string_split(order_product_ids, '|')) AS product_id FROM actions
        WHERE order_product_ids <> '') GROUP BY 1) o USING (product_id)""")
def sink_upsert(spark, sf):
    actions, path = views.actions(spark, sf), scratch_path(spark, "upsert")
    keys, schema = ["product_id"], "product_id string, n bigint, kind string"
    ordered = actions.where("order_product_ids <> ''").select(
        F.explode(F.split("order_product_ids", r"\|")).alias("product_id"))
    for version, (kind, rows) in enumerate((
        ("click", prod.product_clicks(actions).select(F.col("click_product_id").alias("product_id"))),
        ("order", ordered),
    )):
        counts = rows.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"), F.lit(kind).alias("kind"))
        upsert(counts, path, keys, version)
    compact(spark, path, keys, schema)
    return read_latest(spark, path, keys, schema)


# The report of two tasks, the first of them written twice.
@check("area_report_table", "actions city_info", """
SELECT task_id, area, product_id, count FROM (
  SELECT *, row_number() OVER (PARTITION BY task_id, area ORDER BY count DESC, product_id) AS rn
  FROM (SELECT task_id, area, CAST(click_product_id AS BIGINT) AS product_id, count(*) AS count
        FROM actions JOIN city_info USING (city_id), (SELECT unnest([1, 2]) AS task_id)
        WHERE click_product_id <> '' AND (task_id = 1 OR date >= '2024-01-16')
        GROUP BY ALL)) WHERE rn <= 10""")
def area_report_table(spark, sf):
    path = scratch_path(spark, "report")
    for task, start in ((1, None), (2, "2024-01-16"), (1, None)):
        report = prod.area_top_products_of_clicks(
            prod.product_clicks(views.actions(spark, sf), start),
            views.cities(spark, sf), views.products(spark, sf))
        write_report(report, path, task)
    rows = read_latest(spark, path, REPORT_KEYS, REPORT_SCHEMA)
    return rows.select(F.col("task_id").cast("int").alias("task_id"), "area", "product_id", "count")
