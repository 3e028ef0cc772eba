"""Small hand-written inputs."""

from visitlens.sources.schemas import ACTION_COLUMNS, ACTION_SCHEMA

EMPTY_ACTION = dict(
    date="2024-01-01", user_id=1, session_id="s", page_id=1, action_time="2024-01-01 08:00:00",
    search_keyword="", click_category_id="", click_product_id="", order_category_ids="",
    order_product_ids="", pay_category_ids="", pay_product_ids="", city_id=1,
)


def actions(spark, *rows):
    """One action per dict; fields left out are empty."""
    filled = [{**EMPTY_ACTION, **row} for row in rows]
    return spark.createDataFrame([tuple(r[c] for c in ACTION_COLUMNS) for r in filled], ACTION_SCHEMA)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def rows(df, *columns):
    """Sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)
