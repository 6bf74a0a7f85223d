"""Joins whose hot keys are dealt over many partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecost.operators.merge import LINE_KEY

SALT = "__salt"


def hot_keys(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Keys with at least `rows` rows; there are at most count / rows of them, so their number is bounded by the choice of rows."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= rows).select(key)


def salted(df: DataFrame, key: str, hot: DataFrame, slots: int, by: str = LINE_KEY) -> DataFrame:
    """Add a salt: for hot keys one of `slots` numbers that depends on the row only, 0 for the others."""
    marked = df.join(hot.select(F.col(key), F.lit(True).alias("__hot")), key, "left")
    slot = F.pmod(F.xxhash64(F.col(by)), F.lit(slots)).cast("int")
    return marked.withColumn(SALT, F.when(F.col("__hot"), slot).otherwise(F.lit(0))).drop("__hot")


def replicated(df: DataFrame, key: str, hot: DataFrame, slots: int) -> DataFrame:
    """The rows of hot keys once for every salt, the others once."""
    marked = df.join(hot.select(F.col(key), F.lit(True).alias("__hot")), key, "left")
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(slots - 1))).otherwise(F.array(F.lit(0)))
    return marked.withColumn(SALT, F.explode(copies)).drop("__hot")
