"""JDBC sinks. Both are plain uses of Spark's JDBC writer."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: rows per insert batch.
BATCH_ROWS = 500


def append_to_table(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """Insert the rows in batches of 500."""
    df.write.option("batchsize", BATCH_ROWS).jdbc(
        url, table, mode="append", properties=properties or {}
    )


def _quoted(name: str) -> str:
    """A standard SQL identifier."""
    return '"' + name.replace('"', '""') + '"'


def _table(name: str) -> str:
    return ".".join(map(_quoted, name.split(".")))


def merge_statement(table: str, staging: str, keys: list[str], values: list[str]) -> str:
    """Standard MERGE from a staging table, for databases that support it.

    Write the batch to ``staging`` with ``append_to_table``, then run this once in the database.
    """
    match = " AND ".join(f"t.{_quoted(key)} = s.{_quoted(key)}" for key in keys)
    update = ", ".join(f"{_quoted(value)} = s.{_quoted(value)}" for value in values)
    names = ", ".join(map(_quoted, keys + values))
    inserted = ", ".join(f"s.{_quoted(name)}" for name in keys + values)
    changed = f" WHEN MATCHED THEN UPDATE SET {update}" if values else ""
    return (
        f"MERGE INTO {_table(table)} t USING {_table(staging)} s ON {match}{changed}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({inserted})"
    )
