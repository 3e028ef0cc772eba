"""What several operators share: tables, words, scratch tables and sums of arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.session import write_shared

# Upper and lower case of the ASCII letters: the only letters that "lower-cased" means here.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    return write_shared(df, label)[0]


def saved_in_small_batches(df: DataFrame, label: str, rows: int = 512) -> DataFrame:
    """``saved`` for wide rows (texts, sets) that pass to Python: ``rows`` of them at a time, and not Spark's 10,000,
    of which a batch of two columns takes over 100 MB outside the heap, and as much in Python, for each task."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, str(rows))
    try:
        return saved(df, label)
    finally:
        conf.set(name, before)


def mixed(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def summed(parts: DataFrame, fan_in: int = 64) -> np.ndarray | None:
    """Sum of equally long float64 arrays, one per row in column ``part`` (binary), or None.

    The rows meet in two steps: dealt over ``fan_in`` tasks, then one per task. A task adds row by row.
    The arrays' length must not depend on the data.
    """
    schema = "part binary"

    def add(batches):
        total = None
        for batch in batches:
            for value in batch["part"]:
                array = np.frombuffer(value, dtype=np.float64)
                total = array.copy() if total is None else total + array
        if total is not None:
            yield pd.DataFrame({"part": [total.tobytes()]})

    met = parts.select("part").repartition(fan_in).mapInPandas(add, schema)
    rows = met.repartition(1).mapInPandas(add, schema).collect()
    return np.frombuffer(rows[0]["part"], dtype=np.float64) if rows else None
