"""Reading tables: Parquet, remote databases, month files, typed and renamed loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparecost.functions import semantics as S


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def read_remote(
    spark: SparkSession, url: str, *, query: str | None = None, table: str | None = None,
    partition: tuple[str, object, object, int] | None = None, options: dict | None = None,
) -> DataFrame:
    """A remote table, or a query run at the remote side.

    partition: (column, lower, upper, number of parts) reads the table in parallel ranges; without
    it one task reads everything, which suits masters only.
    """
    if (query is None) == (table is None):
        raise ValueError("give a query or a table")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", "10000")
    source = table if table is not None else f"({query}) remote_query"
    reader = reader.option("dbtable", source)
    if partition is not None:
        column, lower, upper, parts = partition
        reader = (
            reader.option("partitionColumn", column).option("lowerBound", str(lower))
            .option("upperBound", str(upper)).option("numPartitions", str(parts))
        )
    return reader.options(**(options or {})).load()


def read_months(spark: SparkSession, directory: str, stem: str) -> DataFrame:
    """All Parquet tables named <stem>_20YYMM in one, with the month taken from the name."""
    pattern = f"{directory}/{stem}_20[0-9][0-9][0-9][0-9].parquet"
    month = F.regexp_extract(F.col("_metadata.file_path"), rf"{stem}_(20[0-9]{{4}})\.parquet", 1)
    return spark.read.parquet(pattern).withColumn("month", month)


def append_tables(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def column_map(df: DataFrame, names: dict) -> DataFrame:
    """Select and rename in one step: {source column: target column}."""
    return df.select(*[F.col(f"`{source}`").alias(target) for source, target in names.items()])


def recode_regions(df: DataFrame, column: str = "region") -> DataFrame:
    return df.withColumn(column, S.recode_region(column))


def strict_load(df: DataFrame, schema: T.StructType, lengths: dict[str, int] | None = None) -> DataFrame:
    """Cast every column to the declared type; a value that does not fit fails the job.

    lengths: longest text allowed per column.
    """
    lengths = lengths or {}
    checked = []
    for f in schema.fields:
        value: Column = F.col(f.name)
        given = value.cast("string")
        cast = value.try_cast(f.dataType)
        bad = given.isNotNull() & cast.isNull()
        if f.name in lengths:
            bad = bad | (F.length(given) > lengths[f.name])
        failed = F.raise_error(F.concat(F.lit(f"{f.name}: value does not fit: "), given))
        checked.append(F.when(bad, failed).otherwise(cast).alias(f.name))
    return df.select(*checked)
