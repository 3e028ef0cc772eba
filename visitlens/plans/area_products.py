"""Most clicked products per area, upserted into a report table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from visitlens.operators.documents import area_product_rows
from visitlens.operators.products import area_top_products_of_clicks, product_clicks
from visitlens.params import TaskParams
from visitlens.sinks.upsert import compact, next_version, upsert

TOP_PRODUCTS = 10
FOLD_EVERY = 20
REPORT_KEYS = ["task_id", "area", "product_id"]
REPORT_SCHEMA = (
    "task_id bigint, area string, product_id bigint, area_level string, count bigint, "
    "city_infos string, product_name string, product_type string"
)


def analyse_area_products(
    actions: DataFrame, cities: DataFrame, products: DataFrame, p: TaskParams, n: int = TOP_PRODUCTS
) -> DataFrame:
    """Only ``city_id``, ``click_product_id`` and the date are read from the actions."""
    clicks = product_clicks(actions, p.start_date, p.end_date)
    return area_top_products_of_clicks(clicks, cities, products, n)


def write_report(report: DataFrame, path: str, task_id: int) -> None:
    """Store the report of a task. Tasks write under their own name, so none replaces another's rows."""
    spark = report.sparkSession
    version = next_version(spark, path)
    upsert(area_product_rows(report, task_id), path, REPORT_KEYS, version, writer=f"task-{task_id}")
    if version and version % FOLD_EVERY == 0:
        compact(spark, path, REPORT_KEYS, REPORT_SCHEMA)
