"""The given tables seen as the inputs of the operators. Times are UTC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13 action columns and ``ts``; a session is one user and day."""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type", "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
        "date_trunc('second', CAST(ts AS TIMESTAMP)) AS ts",
    ).selectExpr("*", "CAST(CAST(ts AS DATE) AS STRING) AS date")
    return events.selectExpr(
        "date", "user_id", "concat_ws('_', user_id, date) AS session_id", "event_id % 302 AS page_id",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS action_time",
        "CASE WHEN event_type = 'view' THEN concat('kw_', k % 10) ELSE '' END AS search_keyword",
        "CASE WHEN event_type = 'click' THEN CAST(k AS STRING) ELSE '' END AS click_category_id",
        "CASE WHEN event_type = 'click' THEN CAST(2 * k AS STRING) ELSE '' END AS click_product_id",
        "CASE WHEN event_type = 'purchase' THEN concat_ws('|', k, (k + 7) % 100) ELSE '' END AS order_category_ids",
        "CASE WHEN event_type = 'purchase' THEN concat_ws('|', 2 * k, 2 * ((k + 7) % 100)) ELSE '' END AS order_product_ids",
        "CASE WHEN event_type = 'signup' THEN CAST(k AS STRING) ELSE '' END AS pay_category_ids",
        "CASE WHEN event_type = 'signup' THEN CAST(2 * k AS STRING) ELSE '' END AS pay_product_ids",
        "CAST(user_id % 25 AS INT) AS city_id", "ts",
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    joined = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr(
        "c_custkey AS user_id", "concat('user_', c_custkey) AS user_name", "c_name AS name",
        "CAST(15 + c_custkey % 45 AS INT) AS age", "c_mktsegment AS professional", "n_name AS city",
        "CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'unknown' END AS sex",
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    joined = table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.selectExpr("n_nationkey AS city_id", "n_name AS city_name", "r_name AS area")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "p_name AS product_name",
        """concat('{"product_type":"', p_size % 2, '"}') AS extend_info""")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad clicks in milliseconds."""
    events = table(spark, sf_dir, "events").selectExpr(
        "unix_millis(CAST(ts AS TIMESTAMP)) AS timestamp", "user_id", "props")
    return events.selectExpr(
        "timestamp_millis(timestamp) AS ts", "timestamp", "concat('province_', user_id % 5) AS province",
        "concat('city_', user_id % 25) AS city", "CAST(user_id AS INT) AS user_id",
        "CAST(get_json_object(props, '$.k') AS INT) AS ad_id",
    )


def click_lines(clicks: DataFrame) -> DataFrame:
    """Clicks as messages."""
    return clicks.select(
        F.concat_ws(" ", "timestamp", "province", "city", "user_id", "ad_id").alias("value"))


def order_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large click fact: one click per order line, from the city of the customer."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_nationkey").alias("city_id"),
                F.col("l_partkey").cast("string").alias("click_product_id"))
    )
