"""Most clicked products per area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.business import area_level, product_type
from visitlens.functions.text import concat_id_name
from visitlens.operators.filters import filter_date_range, filter_is_not_empty
from visitlens.operators.ranking import top_n

# The columns of the result table.
AREA_PRODUCT_COLUMNS = ("area", "area_level", "product_id", "city_infos", "click_count",
                        "product_name", "product_type")


def product_clicks(actions: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """city_id, click_product_id of the clicks in a date range."""
    kept = filter_is_not_empty(filter_date_range(actions, start, end), "click_product_id")
    return kept.select("city_id", "click_product_id")


def product_basic(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """One row per click, with its city and area."""
    return clicks.join(cities, "city_id").select("city_id", "click_product_id", "city_name", "area")


def _city_counts(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """area, product_id, city_id, city_name, n.

    Clicks are counted per city and product before the city join: only the counts are
    shuffled and joined, and a hot product or city is one number per map task. A city listed
    twice counts twice, as it would when joining the clicks.
    """
    counts = clicks.groupBy("city_id", "click_product_id").agg(F.count(F.lit(1)).alias("clicks"))
    listed = cities.groupBy("city_id", "city_name", "area").agg(F.count(F.lit(1)).alias("listed"))
    return counts.join(listed, "city_id").select(
        "area", F.col("click_product_id").alias("product_id"), "city_id", "city_name",
        (F.col("clicks") * F.col("listed")).alias("n"),
    )


def _with_cities(city_counts: DataFrame) -> DataFrame:
    """Totals per area and product, with the counted cities (at most one entry per city)."""
    city = F.struct("city_id", "city_name", "n")
    return city_counts.groupBy("area", "product_id").agg(
        F.sum("n").alias("click_count"), F.array_sort(F.collect_list(city)).alias("city_counts")
    )


def _render_cities(counts: DataFrame) -> DataFrame:
    entries = F.transform("city_counts", lambda c: F.concat_ws(
        ":", concat_id_name(c.city_id, c.city_name), c.n.cast("string")))
    return counts.withColumn("city_infos", F.array_join(entries, ",")).drop("city_counts")


def rank_area_products(counts: DataFrame, n: int = 10) -> DataFrame:
    return top_n(counts, ["area"], [F.col("click_count").desc(), _product_number(), F.col("product_id")], n)


def _product_number():
    """Product ids are text; ties go to the smaller number."""
    return F.col("product_id").try_cast("bigint").asc_nulls_last()


def area_product_count(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """area, product_id, click_count, city_infos (``id:name:n,...`` ordered by city id)."""
    return _render_cities(_with_cities(_city_counts(clicks, cities)))


def join_top_product(ranked: DataFrame, products: DataFrame) -> DataFrame:
    """Add the product columns; a product that is not listed, or whose id is no number, goes."""
    key = ranked["product_id"].try_cast("bigint")
    return ranked.join(products.withColumnRenamed("product_id", "_id"), key == F.col("_id")).drop("_id")


def area_product_report(ranked: DataFrame, products: DataFrame) -> DataFrame:
    """The columns of the report for rows that are ranked already."""
    full = join_top_product(ranked, products)
    full = full.withColumn("area_level", area_level(F.col("area")))
    full = full.withColumn("product_type", product_type(F.col("extend_info")))
    return full.select(*AREA_PRODUCT_COLUMNS)


def area_top_products(counts: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The report: the ``n`` most clicked products of each area. Ranking comes before the product
    join, so an unlisted product leaves fewer than ``n`` rows."""
    return area_product_report(rank_area_products(counts, n), products)


def area_top_products_of_clicks(clicks: DataFrame, cities: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Both steps together. Products are ranked by their sums, and cities are gathered for the ranked
    ones only: at most ``n`` per area, which the city counts are joined with."""
    counts = _city_counts(clicks, cities)
    totals = counts.groupBy("area", "product_id").agg(F.sum("n").alias("click_count"))
    ranked = rank_area_products(totals, n).select("area", "product_id")
    chosen = counts.join(ranked, ["area", "product_id"], "left_semi")
    return area_product_report(_render_cities(_with_cities(chosen)), products)

