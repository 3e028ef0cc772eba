"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.functions.text import get_field, is_not_empty, split_ids
from visitlens.params import TaskParams


def filter_date_range(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive comparison of the ``date`` text; prunes partitions if the table has them by date."""
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end))
    return df


def filter_sex(users: DataFrame, sex: str | None) -> DataFrame:
    return users if sex is None else users.where(F.col("sex") == F.lit(sex))


def filter_values(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Membership in a list; an empty list is no filter."""
    return df.where(F.col(column).isin(*values)) if values else df


def filter_professionals(users: DataFrame, professionals: tuple[str, ...]) -> DataFrame:
    return filter_values(users, "professional", professionals)


def filter_age(users: DataFrame, start: int | None, end: int | None) -> DataFrame:
    if start is not None:
        users = users.where(F.col("age") >= start)
    if end is not None:
        users = users.where(F.col("age") <= end)
    return users


def filter_keywords(actions: DataFrame, keywords: tuple[str, ...]) -> DataFrame:
    return filter_values(actions, "search_keyword", keywords)


def filter_category_ids(actions: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """Actions that click, order or pay for one of the categories."""
    if not categories:
        return actions
    wanted = F.array(*[F.lit(category) for category in categories])
    touched = F.col("click_category_id").isin(*categories)
    for column in ("order_category_ids", "pay_category_ids"):
        ids = F.coalesce(split_ids(F.col(column)), F.array().cast("array<string>"))
        touched = F.coalesce(touched, F.lit(False)) | F.arrays_overlap(ids, wanted)
    return actions.where(touched)


def join_action_user(actions: DataFrame, users: DataFrame) -> DataFrame:
    return actions.join(users, "user_id")


def filter_actions_by_task(actions: DataFrame, users: DataFrame | None, p: TaskParams) -> DataFrame:
    """All filters of a task. Users are joined only if one of their columns is filtered.

    The user side is filtered and cut to its key first. Spark broadcasts it while it is small;
    beyond that it is a shuffle join, where AQE splits the partition of a hot user.
    """
    columns = actions.columns
    kept = filter_date_range(actions, p.start_date, p.end_date)
    kept = filter_category_ids(filter_keywords(kept, p.keywords), p.category_ids)
    if not p.needs_users:
        return kept
    if users is None:
        raise ValueError("these parameters need the user table")
    users = filter_professionals(filter_sex(users, p.sex), p.professionals)
    users = filter_values(filter_age(users, p.start_age, p.end_age), "city", p.cities)
    return join_action_user(kept, users.select("user_id")).select(*columns)


def filter_is_not_empty(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_not_empty(F.col(column)))


def filter_invalid_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions shorter than a second."""
    return sessions.where(F.col("length_s") < 1)


def filter_count_threshold(counts: DataFrame, threshold: int = 100, column: str = "click_count") -> DataFrame:
    return counts.where(F.col(column) > threshold)


def _parameter(parameter: str, field: str) -> Column:
    return get_field(F.lit(parameter), field)


def filter_between_param(
    df: DataFrame, data_column: str, field: str, parameter: str, start_field: str, end_field: str
) -> DataFrame:
    """Number ``field`` of ``k=v|k=v`` data within the bounds given in ``parameter``.

    A missing bound accepts every row; with both bounds, a row without the field is dropped.
    """
    start, end = _parameter(parameter, start_field), _parameter(parameter, end_field)
    value = get_field(F.col(data_column), field).try_cast("int")
    inside = value.between(start.try_cast("int"), end.try_cast("int"))
    return df.where(start.isNull() | end.isNull() | F.coalesce(inside, F.lit(False)))


def filter_in_param(
    df: DataFrame, data_column: str, field: str, parameter: str, parameter_field: str
) -> DataFrame:
    """One of the comma values of ``field`` is among those of the parameter; none given accepts all."""
    wanted = _parameter(parameter, parameter_field)
    value = get_field(F.col(data_column), field)
    overlap = F.arrays_overlap(F.split(value, ","), F.split(wanted, ","))
    return df.where(wanted.isNull() | F.coalesce(overlap, F.lit(False)))


def filter_equal_param(
    df: DataFrame, data_column: str, field: str, parameter: str, parameter_field: str
) -> DataFrame:
    wanted = _parameter(parameter, parameter_field)
    same = get_field(F.col(data_column), field) == wanted
    return df.where(wanted.isNull() | F.coalesce(same, F.lit(False)))
