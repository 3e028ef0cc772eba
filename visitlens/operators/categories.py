"""Clicked, ordered and paid categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.text import has_text
from visitlens.operators.ranking import DIRECT_RANKS, top_n

# Action flags.
CLICK, ORDER, PAY = 0, 1, 2
FLAG_NAMES = {CLICK: "click", ORDER: "order", PAY: "pay"}

TOP = 10


def explode_category_actions(actions: DataFrame) -> DataFrame:
    """session_id, category_id, flag: one row per category an action touches.

    An action counts as a click if it has a click category, else as an order, else as a pay.
    A click names one category; order and pay list several, of which blank ones are dropped.
    """
    click, order, pay = (F.col(c) for c in
                         ("click_category_id", "order_category_ids", "pay_category_ids"))
    flag = (F.when(has_text(click), F.lit(CLICK))
            .when(has_text(order), F.lit(ORDER))
            .when(has_text(pay), F.lit(PAY)))
    ids = (F.when(F.col("flag") == CLICK, F.array(click))
           .when(F.col("flag") == ORDER, F.split(order, r"\|"))
           .when(F.col("flag") == PAY, F.split(pay, r"\|")))
    # An action without a flag has no array and gives no row.
    exploded = actions.withColumn("flag", flag).select(
        "session_id", F.explode(ids).alias("category_id"), "flag")
    return exploded.where(has_text(F.col("category_id")))


def category_action_counts(exploded: DataFrame) -> DataFrame:
    return exploded.groupBy("category_id", "flag").agg(F.count(F.lit(1)).alias("cnt"))


def top_per_flag(counts: DataFrame, n: int = TOP) -> DataFrame:
    return top_n(counts, ["flag"], [F.col("cnt").desc(), F.col("category_id")], n)


def category_pivot(counts: DataFrame) -> DataFrame:
    """category_id, click_count, order_count, pay_count; 0 where a flag has no row."""
    return counts.groupBy("category_id").agg(*[
        F.coalesce(F.max(F.when(F.col("flag") == flag, F.col("cnt"))), F.lit(0))
        .cast("bigint").alias(f"{name}_count")
        for flag, name in FLAG_NAMES.items()
    ])


def top_categories(exploded: DataFrame, n: int = TOP, full_counts: bool = False) -> DataFrame:
    """The ``n`` categories with most events of each flag, at most three times ``n`` rows.

    A count is 0 where the category is not among the first ``n`` of that flag, unless
    ``full_counts`` asks for its real count.
    """
    counts = category_action_counts(exploded)
    top = top_per_flag(counts, n)
    if full_counts:
        chosen = top.select("category_id").distinct()
        # At most three times n rows, from the ranking above.
        top = counts.join(F.broadcast(chosen) if n <= DIRECT_RANKS else chosen, "category_id", "left_semi")
    return category_pivot(top)


def only_categories(exploded: DataFrame, categories: DataFrame) -> DataFrame:
    """Rows of the given categories."""
    return exploded.join(categories.select("category_id"), "category_id", "left_semi")


def session_category_counts(exploded: DataFrame, categories: DataFrame) -> DataFrame:
    """category_id, flag, session_id, cnt for the given categories, filtered before the shuffle."""
    return (
        only_categories(exploded, categories)
        .groupBy("category_id", "flag", "session_id").agg(F.count(F.lit(1)).alias("cnt"))
    )


def top_category_sessions(exploded: DataFrame, categories: DataFrame, n: int = TOP) -> DataFrame:
    """category_id, flag, session_id, cnt: the ``n`` sessions with most events per category and
    flag, for every flag of a category that is top in any of them."""
    counts = session_category_counts(exploded, categories)
    order = [F.col("cnt").desc(), F.col("session_id")]
    return top_n(counts, ["category_id", "flag"], order, n)


def top_session_details(actions: DataFrame, top_sessions: DataFrame) -> DataFrame:
    """All actions of the given sessions."""
    return actions.join(top_sessions.select("session_id").distinct(), "session_id", "left_semi")
