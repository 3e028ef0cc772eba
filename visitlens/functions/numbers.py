"""Number helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, places: int = 2) -> Column:
    """Halves go up, judged on the decimal rendering of the double (1.005 gives 1.01)."""
    return F.round(c, places)


def plain_number(c: Column) -> Column:
    """Text without grouping, exponent or trailing zeros, at most three decimals."""
    fixed = F.bround(c, 3).cast("decimal(38,3)").cast("string")
    return F.regexp_replace(fixed, r"\.?0+$", "")
