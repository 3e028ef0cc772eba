"""Domain labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlens.functions.text import json_string

# Level of each area, any other area is level E.
AREA_LEVELS = {
    "A": ("华东", "华南", "华北"),
    "B": ("东北",),
    "C": ("华中", "西南"),
    "D": ("西北",),
}
OTHER_LEVEL = "E"

# Labels of the product types.
OWN_PRODUCT = "自营商品"
THIRD_PARTY_PRODUCT = "第三方商品"


def area_level(area: Column) -> Column:
    level = F
    for name, areas in AREA_LEVELS.items():
        level = level.when(area.isin(*areas), F.lit(name))
    return level.otherwise(F.lit(OTHER_LEVEL))


def product_type(extend_info: Column) -> Column:
    own = json_string(extend_info, "product_type") == "0"
    return F.when(own, F.lit(OWN_PRODUCT)).otherwise(F.lit(THIRD_PARTY_PRODUCT))
