"""Writing tables: full refresh, replaceable periods, rolling windows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost.operators import merge_update
from sparecost.sources.published import Published, counted


def full_refresh(df: DataFrame, table: Published) -> int:
    """Replace a whole table by rows that may be read from it; readers see the old one until the new one is complete."""
    return table.refresh(df)


def stamp_period(df: DataFrame, period: str, column: str = "data_period") -> DataFrame:
    """Set the period where it is missing."""
    if column in df.columns:
        return df.withColumn(column, F.coalesce(F.col(column), F.lit(period)))
    return df.withColumn(column, F.lit(period))


def overwrite_period(df: DataFrame, path: str, period: str, column: str = "data_period") -> int:
    """Replace one period of a table partitioned by period; the other periods stay. Returns the number of rows.

    The plan runs once: rows are counted while they are written. The new files are committed before the old partition
    goes; only a period without any rows takes a second, empty write. Files are rebalanced so that no task writes a huge
    or tiny one. For readers that must never meet a half-replaced table there is `Published.replace`.
    """
    rows, count = counted(df.withColumn(column, F.lit(period)))
    rows.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    if not count():
        df.drop(column).limit(0).write.mode("overwrite").parquet(f"{path}/{column}={period}")
    return count()


def replace_window(existing: DataFrame, incoming: DataFrame, time: str, first: Column, last: Column) -> DataFrame:
    """Rows of `existing` outside the days first..last, and the distinct incoming rows inside them."""
    day = F.to_date(F.col(time))
    inside = day.between(first, last)
    outside = existing.filter(day.isNull() | ~inside)
    return outside.unionByName(incoming.filter(inside).distinct())


def reload_window(incoming: DataFrame, table: Published, time: str, first: str, last: str) -> int:
    """Replace the days first..last of a table published by day with the distinct incoming rows, in one commit.

    All days of the window change together: days without incoming rows become empty, days outside are not touched, and a
    job that fails leaves the old window. Returns the number of rows.
    """
    day = F.to_date(F.col(time))
    start, end = date.fromisoformat(first), date.fromisoformat(last)
    fresh = incoming.filter(day.between(F.lit(start), F.lit(end))).distinct().withColumn(table.column, day.cast("string"))
    return table.replace(fresh, [str(start + timedelta(n)) for n in range((end - start).days + 1)])


def backfill(history: DataFrame, staging: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Fill later-added columns of history from staging by key; unmatched rows keep theirs."""
    values = {c: c for c in columns}
    return merge_update(history, staging.select(key, *columns), [key], values)
