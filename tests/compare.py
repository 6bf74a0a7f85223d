"""Run queries on Spark and their SQL on DuckDB over the same tables and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("sparecost").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    return connection


def plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (1, repr(value + 0.0))
    return (1, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, sql: str, connection) -> str:
    """'' when equal, else what differs."""
    result = connection.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want_columns != got_columns:
        return f"columns {set(got_columns) ^ set(want_columns)}"
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}"
    different = [(g, w) for g, w in zip(got, want) if g != w]
    if different:
        g, w = different[0]
        first = {c: (a[1], b[1]) for c, a, b in zip(got_columns, g, w) if a != b}
        return f"{len(different)} of {len(got)} rows differ, first {g[0]}{g[-1]} {first}"
    return ""


if __name__ == "__main__":
    import __spark_entry__ as entry_points

    directory = sys.argv[1]
    names = sys.argv[2:]
    spark, connection = session(), database(directory)
    failed = 0
    for name, run in entry_points.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, directory)
            problem = compare(df, entry_points.oracle_sql()[name], connection)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += bool(problem)
        print(f"{name}: {'ok' if not problem else problem} ({time.time() - start:.1f}s)", flush=True)
    print("failed", failed)
