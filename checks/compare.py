"""Compare a query with its SQL in DuckDB: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duckdb_over(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        if name in TABLES:
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.10g}")
    if hasattr(value, "as_integer_ratio") and not isinstance(value, (int, bool)):
        return float(value)
    return value


def _rows(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, sf_dir: str, name: str, connection=None) -> str | None:
    """None if rows, column names and types of values agree, else what differs."""
    from checks.queries import QUERIES, SQL

    return held_against(spark, sf_dir, QUERIES[name], SQL.get(name), connection)


def held_against(spark, sf_dir: str, query, sql: str | None, connection=None) -> str | None:
    """The same for a query and its SQL."""
    df = query(spark, sf_dir)
    mine = _rows(df.columns, df.collect())
    if sql is None:
        return None
    connection = connection or duckdb_over(sf_dir)
    result = connection.execute(sql)
    other = _rows([d[0] for d in result.description], result.fetchall())
    if mine[0] != other[0]:
        return f"columns {mine[0]} and {other[0]}"
    if mine[1] != other[1]:
        only, missing = mine[1] - other[1], other[1] - mine[1]
        return (f"{sum(mine[1].values())} and {sum(other[1].values())} rows; "
                f"only in Spark {list(only)[:2]}; only in SQL {list(missing)[:2]}")
    return None


def main() -> int:
    from visitlens.session import build_session

    from checks.queries import QUERIES, SQL
    from checks.shared import ensure_shared_folder

    arguments = sys.argv[1:]
    sf_dir = arguments.pop(0) if arguments and os.path.isdir(arguments[0]) else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    ensure_shared_folder(spark)
    connection, bad = duckdb_over(sf_dir), 0
    for name in arguments or QUERIES:
        start = time.time()
        try:
            problem = differences(spark, sf_dir, name, connection)
        except Exception as error:  # the report goes on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        note = "ok" if name in SQL else "ok (no SQL)"
        print(f"{name:34s} {time.time() - start:6.2f}s {problem or note}", flush=True)
    print(f"{bad} differences")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
