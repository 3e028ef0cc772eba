"""The same helpers under SQL names, as SQL functions that Catalyst inlines (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The blanks of ``visitlens.functions.text``, as an expression.
_BLANKS = "concat(" + ", ".join(f"chr({code})" for code in range(33)) + ")"

_DEFINITIONS = (
    f"""CREATE OR REPLACE TEMPORARY FUNCTION is_not_empty(c STRING) RETURNS BOOLEAN
       RETURN coalesce(btrim(c, {_BLANKS}), '') <> '' AND lower(btrim(c, {_BLANKS})) <> 'null'""",
    """CREATE OR REPLACE TEMPORARY FUNCTION concat_id_name(id BIGINT, name STRING) RETURNS STRING
       RETURN concat_ws(':', id, name)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION json_string(c STRING, field STRING) RETURNS STRING
       RETURN get_json_object(c, concat('$.', field))""",
    # One entry of the per-city breakdown. As an aggregate: count per city in a subquery, then
    # listagg(id_name_count(id, name, n), ',') WITHIN GROUP (ORDER BY id).
    """CREATE OR REPLACE TEMPORARY FUNCTION id_name_count(id BIGINT, name STRING, n BIGINT) RETURNS STRING
       RETURN concat_ws(':', id, name, n)""",
)


def register_sql_functions(spark: SparkSession) -> None:
    for definition in _DEFINITIONS:
        spark.sql(definition)


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def create_area_product_function(spark: SparkSession, actions: str, cities: str, name: str = "area_product_count") -> None:
    """The report per area and product under one SQL name: ``SELECT * FROM area_product_count(from_date, to_date)``.

    A function of the catalog over catalog tables, so other sessions have it too. Null dates are open ends. Clicks are
    counted per city and product before the city join, as in ``operators.products``; the text of a product's cities
    holds one entry per city. No Python runs.
    """
    spark.sql(f"""
      CREATE OR REPLACE FUNCTION {_quoted(name)}(from_date STRING, to_date STRING)
      RETURNS TABLE(area STRING, product_id STRING, click_count BIGINT, city_infos STRING)
      RETURN
        SELECT area, product_id, sum(n), listagg(concat_ws(':', city_id, city_name, n), ',') WITHIN GROUP (ORDER BY city_id)
        FROM (
          SELECT c.area, k.product_id, k.city_id, c.city_name, sum(k.n) AS n
          FROM (
            SELECT city_id, click_product_id AS product_id, count(*) AS n FROM {_quoted(actions)}
            WHERE coalesce(date >= from_date, from_date IS NULL) AND coalesce(date <= to_date, to_date IS NULL)
              AND coalesce(btrim(click_product_id, {_BLANKS}), '') <> ''
              AND lower(btrim(click_product_id, {_BLANKS})) <> 'null'
            GROUP BY city_id, click_product_id) AS k
          JOIN {_quoted(cities)} AS c ON k.city_id = c.city_id
          GROUP BY c.area, k.product_id, k.city_id, c.city_name)
        GROUP BY area, product_id""")
