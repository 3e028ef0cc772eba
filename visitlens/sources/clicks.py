"""Ad click messages: ``<millis> <province> <city> <user_id> <ad_id>``, one per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.text import strip
from visitlens.sources.schemas import CLICK_SCHEMA, columns_of
from visitlens.sources.text import parse_tokens


def topic_names(setting: str) -> list[str]:
    """Topics of a ``name:threads,name:threads`` setting; malformed entries are skipped.

    The thread counts only steered receivers, which Structured Streaming does not have.
    """
    names = []
    for entry in setting.split(","):
        parts = [part.strip() for part in entry.split(":")]
        if len(parts) >= 2 and parts[0] and parts[1].lstrip("+-").isdigit():
            names.append(parts[0])
    return names


def kafka_lines(spark: SparkSession, servers: str, topics: str, options: dict | None = None) -> DataFrame:
    """Message values of Kafka topics; needs the public Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    messages = reader.option("subscribe", ",".join(topic_names(topics))).load()
    return messages.select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Text files as they arrive; the same one-column shape as ``kafka_lines``."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


# A space and all blanks around it; blanks without a space do not separate.
_SEPARATOR = r"[\x00-\x1f]* [\x00-\x20]*"


def parse_click_lines(lines: DataFrame) -> DataFrame:
    """All lines with their click columns, and the ``reason`` of those that do not parse."""
    return parse_tokens(lines, F.split(strip(F.col("value")), _SEPARATOR), CLICK_SCHEMA)


def parse_ad_click(lines: DataFrame) -> DataFrame:
    """Clicks with the event time ``ts``; lines that do not parse are left out."""
    return (
        parse_click_lines(lines)
        .where("reason IS NULL")
        .select(F.timestamp_millis("timestamp").alias("ts"),
                *[name for name, _ in columns_of(CLICK_SCHEMA)])
    )


def rejected_ad_clicks(lines: DataFrame) -> DataFrame:
    return parse_click_lines(lines).where("reason IS NOT NULL").select("value", "reason")
