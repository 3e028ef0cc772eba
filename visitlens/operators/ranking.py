"""Top-N per group, the one ranking form everything here uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to this rank Spark limits a group within each map task (its default threshold).
DIRECT_RANKS = 1_000
SLICES = 64


def _ranked(df: DataFrame, group: list[str], order: list[Column], limit: Column, name: str) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= limit)


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int | Column, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of every group; ``n`` may be a column.

    Up to ``DIRECT_RANKS`` each map task keeps at most ``n`` rows of a group before the shuffle
    (window group limit), so a group of any size reaches its task small. Beyond, and for a column, groups
    are ranked in ``SLICES`` slices by hash first, and the first ``n`` of each slice again: no task sees more
    than a slice, or the slices' remainders.
    """
    name = rank or "_rank"
    direct = isinstance(n, int) and n <= DIRECT_RANKS
    limit = F.lit(n) if isinstance(n, int) else n
    if not direct:
        sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(SLICES)))
        df = _ranked(sliced, [*group, "_slice"], order, limit, name).drop("_slice", name)
    ranked = _ranked(df, group, order, limit, name)
    return ranked if rank else ranked.drop(name)
