"""Results rendered as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.functions.numbers import plain_number
from visitlens.operators.categories import FLAG_NAMES
from visitlens.operators.sampling import KEYS
from visitlens.operators.sessions import INVALID_LEVEL, hour_metrics, level_metrics
from visitlens.sources.schemas import ACTION_COLUMNS


def _record() -> Column:
    return F.struct(*ACTION_COLUMNS)


def session_aggr_json(sessions: DataFrame, hourly: DataFrame) -> DataFrame:
    """One row, column ``document``, with the seven session metrics.

    The arrays hold at most eight levels and one entry per hour of the analysed period. Both
    inputs are read once: sessions are counted per level, hours per hour, and the totals follow
    from those counts.
    """
    count = F.col("session_count")
    levels = level_metrics(sessions).agg(
        F.coalesce(F.sum(count), F.lit(0)).alias("total_session_count"),
        (F.coalesce(F.sum("length_ms"), F.lit(0)) / 1000).alias("total_session_length"),
        F.coalesce(F.sum(F.when(F.col("level") == INVALID_LEVEL, count)), F.lit(0))
        .alias("invalid_session_count"),
        F.array_sort(F.collect_list(
            F.struct(F.col("level").alias("type"), count.alias("count")))).alias("levels"),
    )
    hours = hour_metrics(hourly).agg(F.array_sort(F.collect_list(
        F.struct("day", "hour", "session_count", "length_s", "invalid_count")
    )).alias("hours"))
    both = levels.unionByName(hours, allowMissingColumns=True)
    one_row = both.agg(*[F.first(name, ignorenulls=True).alias(name) for name in both.columns])

    def per_hour(source: str, name: str, keep_zero: bool = True) -> Column:
        entries = F.col("hours")
        if not keep_zero:
            entries = F.filter(entries, lambda h: h[source] > 0)
        return F.transform(entries, lambda h: F.struct(
            h["day"].alias("day"), h["hour"].alias("hour"), h[source].alias(name)))

    document = F.to_json(F.struct(
        "total_session_count",
        plain_number(F.col("total_session_length")).alias("total_session_length"),
        "invalid_session_count",
        F.col("levels").alias("pre_session_type_of_count"),
        per_hour("session_count", "count").alias("pre_hour_of_session_count"),
        per_hour("length_s", "length").alias("pre_hour_of_session_length"),
        per_hour("invalid_count", "invalid", False).alias("pre_hour_of_invalid_session_count"),
    ))
    return one_row.select(document.alias("document"))


def sample_record_json(detail: DataFrame) -> DataFrame:
    """``document``: one JSON object per sampled action."""
    document = F.to_json(F.struct("session_id", "day", "hour", _record().alias("record")))
    return detail.select(document.alias("document"))


def action_json(actions: DataFrame) -> DataFrame:
    return actions.select(F.to_json(_record()).alias("document"))


def category_sessions_json(top_sessions: DataFrame) -> DataFrame:
    """category_id and three JSON arrays of its top sessions, least active first; ``''`` where a
    flag has none. Groups hold at most three times the top N."""
    entry = F.struct(F.col("cnt").alias("_order"), F.col("session_id").alias("sessionid"),
                     F.col("cnt").alias("count"))

    def column(flag: int, name: str) -> Column:
        entries = F.array_sort(F.collect_list(F.when(F.col("flag") == flag, entry)))
        plain = F.transform(entries, lambda e: F.struct(e["sessionid"].alias("sessionid"),
                                                        e["count"].alias("count")))
        text = F.when(F.size(plain) > 0, F.to_json(plain)).otherwise(F.lit(""))
        return text.alias(f"{name}_sessions")

    return top_sessions.groupBy("category_id").agg(
        *[column(flag, name) for flag, name in FLAG_NAMES.items()]
    )


def sample_session_rows(detail: DataFrame, top_sessions: DataFrame, task_id: int) -> DataFrame:
    """task_id, session_id, day, hour, record: a row per action of the sampled sessions with most actions.

    ``record`` is the action as JSON. Nothing is gathered, so sessions of any size have the same form.
    """
    chosen = detail.join(top_sessions.select(*KEYS), KEYS)
    return chosen.select(F.lit(task_id).cast("bigint").alias("task_id"), *KEYS, F.to_json(_record()).alias("record"))


def top_category_rows(categories: DataFrame, task_id: int) -> DataFrame:
    return categories.select(
        F.lit(task_id).cast("bigint").alias("task_id"),
        "category_id", "click_count", "order_count", "pay_count",
    )


def area_product_rows(report: DataFrame, task_id: int) -> DataFrame:
    """Rows of the area report table, keyed by (task_id, area, product_id)."""
    return report.select(
        F.lit(task_id).cast("bigint").alias("task_id"), "area",
        F.col("product_id").try_cast("bigint").alias("product_id"), "area_level",
        F.col("click_count").alias("count"), "city_infos", "product_name", "product_type",
    )
