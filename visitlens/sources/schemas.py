"""Input schemas."""

from __future__ import annotations

# Column order of the text files.
ACTION_SCHEMA = (
    "date string, user_id bigint, session_id string, page_id bigint, action_time string, "
    "search_keyword string, click_category_id string, click_product_id string, "
    "order_category_ids string, order_product_ids string, pay_category_ids string, "
    "pay_product_ids string, city_id int"
)
USER_SCHEMA = (
    "user_id bigint, user_name string, name string, age int, professional string, "
    "city string, sex string"
)
PRODUCT_SCHEMA = "product_id bigint, product_name string, extend_info string"
CITY_SCHEMA = "city_id int, city_name string, area string"
CLICK_SCHEMA = "timestamp bigint, province string, city string, user_id int, ad_id int"

ACTION_COLUMNS = [field.split()[0] for field in ACTION_SCHEMA.split(", ")]


def columns_of(schema: str) -> list[tuple[str, str]]:
    """``name type, ...`` as pairs."""
    return [tuple(field.split()) for field in schema.split(", ")]
