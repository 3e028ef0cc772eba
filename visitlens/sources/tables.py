"""Catalog and JDBC tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.times import to_time
from visitlens.params import TaskParams
from visitlens.sources.schemas import ACTION_SCHEMA, columns_of


def scan_catalog_table(
    spark: SparkSession, name: str, columns: list[str] | None = None, *conditions: Column
) -> DataFrame:
    """A table or view with typed conditions; filters and column choice reach the source."""
    df = spark.table(name)
    for condition in conditions:
        df = df.where(condition)
    return df.select(*columns) if columns else df


def scan_chosen_dates(spark: SparkSession, name: str, chosen: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows of a table partitioned by ``date`` for the dates in another table. The dates are found first and their
    folders are the only ones read (dynamic partition pruning); nothing passes through the driver's code."""
    df = spark.table(name).join(chosen.select("date").distinct(), "date", "left_semi")
    return df.select(*columns) if columns else df


# One statement for all task parameters. Values are markers, tables identifiers: no text is put into it.
_TASK_FILTER = """
SELECT a.* FROM IDENTIFIER(:actions) AS a
WHERE (:start_date IS NULL OR a.date >= :start_date) AND (:end_date IS NULL OR a.date <= :end_date)
  AND (size(:keywords) = 0 OR array_contains(CAST(:keywords AS ARRAY<STRING>), a.search_keyword))
  AND (NOT :needs_users OR EXISTS (
    SELECT 1 FROM IDENTIFIER(:users) AS u
    WHERE u.user_id = a.user_id AND (:sex IS NULL OR u.sex = :sex)
      AND (:start_age IS NULL OR u.age >= :start_age) AND (:end_age IS NULL OR u.age <= :end_age)
      AND (size(:professionals) = 0 OR array_contains(CAST(:professionals AS ARRAY<STRING>), u.professional))
      AND (size(:cities) = 0 OR array_contains(CAST(:cities AS ARRAY<STRING>), u.city))))"""


def filter_actions_sql(spark: SparkSession, actions: str, users: str, params: TaskParams) -> DataFrame:
    """The filters of a task over named tables, as one parametrised statement. Absent values and empty lists fold away
    before planning, so users are read only if one of their columns is filtered. A row appears once for each of its
    actions, however often its user is listed."""

    def texts(values):
        return F.array(*map(F.lit, values))

    return spark.sql(_TASK_FILTER, args={
        "actions": actions, "users": users, "start_date": params.start_date, "end_date": params.end_date,
        "sex": params.sex, "start_age": params.start_age, "end_age": params.end_age,
        "keywords": texts(params.keywords), "professionals": texts(params.professionals), "cities": texts(params.cities),
        "needs_users": params.needs_users})


def jdbc_slices(column: str, lower: int, upper: int, slices: int) -> dict:
    """Reader arguments that split a table scan over ``slices`` parallel range queries."""
    if slices < 1 or upper <= lower:
        raise ValueError("need at least one slice and a non-empty range")
    return {"column": column, "lowerBound": lower, "upperBound": upper, "numPartitions": slices}


def scan_jdbc_table(
    spark: SparkSession, url: str, table: str, properties: dict | None = None,
    slices: dict | None = None,
) -> DataFrame:
    """A database table; without ``slices`` (see ``jdbc_slices``) it is read by one task."""
    return spark.read.jdbc(url, table, properties=properties or {}, **(slices or {}))


def _timed(actions: DataFrame) -> DataFrame:
    return actions if "ts" in actions.columns else actions.withColumn("ts", to_time(F.col("action_time")))


def with_time(actions: DataFrame) -> DataFrame:
    """Add ``ts`` from ``action_time`` where the source did not deliver it; ``without_time`` has the rest."""
    return _timed(actions).where("ts IS NOT NULL")


def without_time(actions: DataFrame) -> DataFrame:
    """The actions that ``with_time`` leaves out, with the reason."""
    return _timed(actions).where("ts IS NULL").drop("ts").withColumn("reason", F.lit("time:action_time"))


def project_action_record(actions: DataFrame) -> DataFrame:
    """The 13 action columns in their types and order."""
    return actions.select(*[
        F.col(name).cast(kind).alias(name) for name, kind in columns_of(ACTION_SCHEMA)
    ])
