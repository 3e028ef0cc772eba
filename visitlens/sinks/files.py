"""File and console sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per row and line, replacing what is at ``path``."""
    df.write.mode("overwrite").json(path)


def write_document_lines(df: DataFrame, column: str, path: str) -> None:
    """One already rendered document per line, replacing what is at ``path``."""
    df.select(column).write.mode("overwrite").text(path)


def console_writer(df: DataFrame, rows: int = 5) -> DataStreamWriter:
    """Shows the first rows of every batch of a streaming result."""
    return df.writeStream.format("console").option("numRows", rows)
