"""A catalog table of actions laid out for its readers: partitioned by date, bucketed by session.

A date filter, or a join with chosen dates, reads only the folders of those dates; joins and groupings by session
need no shuffle, against other tables with the same buckets too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 32


def _buckets_together(df: DataFrame, columns: list[str], key: str, buckets: int) -> DataFrame:
    """The rows of a bucket (and partition) in one task, so that it has one file, but in several tasks if they are
    many: a hot date or session is split by AQE."""
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    return df.withColumn("_bucket", bucket).hint("rebalance", *columns, "_bucket").drop("_bucket")


def write_action_table(actions: DataFrame, name: str, path: str | None = None, buckets: int = BUCKETS) -> None:
    """Create or replace the table ``name``; with ``path`` its files lie there and stay when the name is dropped."""
    writer = _buckets_together(actions, ["date"], "session_id", buckets).write.mode("overwrite").partitionBy("date")
    writer = writer.bucketBy(buckets, "session_id")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_session_table(sessions: DataFrame, name: str, path: str | None = None, buckets: int = BUCKETS) -> None:
    """A table keyed by session with the buckets of the action table: a sample, or results per session."""
    writer = _buckets_together(sessions, [], "session_id", buckets).write.mode("overwrite").bucketBy(buckets, "session_id")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def join_by_session(actions: DataFrame, sessions: DataFrame, *others: str) -> DataFrame:
    """Inner join on session_id and ``others``, in the buckets both tables have: only session_id is a key of the join,
    so that the buckets suffice, and the rest is a condition on its pairs."""
    left, right = actions.alias("a"), sessions.select("session_id", *others).alias("s")
    on = F.col("a.session_id") == F.col("s.session_id")
    for column in others:
        # Not an equality for the planner, which would ask for rows dealt by all keys.
        mine, other = F.col(f"a.{column}"), F.col(f"s.{column}")
        on = on & (mine <= other) & (mine >= other)
    return left.join(right, on).select("a.*")
