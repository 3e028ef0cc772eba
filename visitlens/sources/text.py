"""Delimited text to typed rows, with the rejected lines kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.times import to_time
from visitlens.sources.schemas import ACTION_SCHEMA, PRODUCT_SCHEMA, USER_SCHEMA, columns_of


def parse_tokens(
    lines: DataFrame, tokens: Column, schema: str, time_column: str | None = None
) -> DataFrame:
    """``value``, the typed columns, ``ts`` if there is a time column, and ``reason``.

    ``reason`` is null for good lines. Tokens and fields pass through one-element generators, so
    that the filters that follow use the finished values: pushed below a plain projection they
    would split the line again for every field they test.
    """
    columns = columns_of(schema)
    split = lines.select("value", F.explode(F.array(tokens)).alias("tokens"))

    fields = [F.size("tokens").alias("_width")]
    problems = [F.when(F.col("_width") != len(columns), F.lit("width"))]
    for position, (name, kind) in enumerate(columns):
        token = F.get("tokens", F.lit(position))
        fields.append((token if kind == "string" else token.try_cast(kind)).alias(name))
        if kind != "string":
            problems.append(F.when(F.col(name).isNull(), F.lit(f"number:{name}")))
        if name == time_column:
            fields.append(to_time(token).alias("ts"))
            problems.append(F.when(F.col("ts").isNull(), F.lit(f"time:{name}")))

    typed = split.select("value", F.inline(F.array(F.struct(*fields))))
    return typed.withColumn("reason", F.coalesce(*problems)).drop("_width")


def _split_lines(lines: DataFrame, schema: str, sep: str, time_column: str | None = None) -> DataFrame:
    tokens = F.split(F.rtrim("value", F.lit(sep)), r"\Q" + sep + r"\E")
    return parse_tokens(lines, tokens, schema, time_column)


def parse_delimited(
    lines: DataFrame, schema: str, sep: str, time_column: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split the ``value`` column of ``lines``; returns (good rows, rejected lines with reason).

    Separators at the end of a line do not count towards its width, so a line whose last field
    is empty is too short. ``time_column`` must hold a time; it is also returned as ``ts``.
    """
    parsed = _split_lines(lines, schema, sep, time_column)
    good = parsed.where("reason IS NULL").drop("value", "reason")
    rejected = parsed.where("reason IS NOT NULL").select("value", "reason")
    return good, rejected


def parse_action_lines(lines: DataFrame) -> DataFrame:
    """All lines with their action columns, ``ts``, and the ``reason`` of those that do not parse."""
    return _split_lines(lines, ACTION_SCHEMA, ",", time_column="action_time")


def parse_actions(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parse_delimited(lines, ACTION_SCHEMA, ",", time_column="action_time")


def parse_users(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parse_delimited(lines, USER_SCHEMA, ",")


def parse_products(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Products are separated by ``^``, because their JSON field holds commas."""
    return parse_delimited(lines, PRODUCT_SCHEMA, "^")


def scan_action_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_actions(spark.read.text(path))


def scan_user_info(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_users(spark.read.text(path))


def scan_product_info(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_products(spark.read.text(path))
