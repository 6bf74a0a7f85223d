import pytest
from pyspark.sql import types as T

from sparecost import sources


def read(spark, path):
    return sorted(tuple(r) for r in spark.read.schema("v int, data_period string").parquet(path).collect())


def test_period_is_replaced_and_rerun_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "history")
    for values, period in (([1, 2], "2016Q4"), ([3], "2017Q1"), ([4, 5], "2017Q1"), ([4, 5], "2017Q1")):
        sources.overwrite_period(spark.createDataFrame([(v,) for v in values], "v int"), path, period)
    assert read(spark, path) == [(1, "2016Q4"), (2, "2016Q4"), (4, "2017Q1"), (5, "2017Q1")]
    sources.overwrite_period(spark.createDataFrame([], "v int"), path, "2017Q1")
    assert read(spark, path) == [(1, "2016Q4"), (2, "2016Q4")]


def test_stamp_period_fills_only_gaps(spark):
    df = spark.createDataFrame([(1, None), (2, "2016Q4")], "v int, data_period string")
    assert [r["data_period"] for r in sources.stamp_period(df, "2017Q1").collect()] == ["2017Q1", "2016Q4"]


def test_strict_load_fails_on_bad_or_long_values(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType())])
    good = spark.createDataFrame([("1", "ab"), (None, None)], "n string, s string")
    assert [tuple(r) for r in sources.strict_load(good, schema, {"s": 2}).collect()] == [(1, "ab"), (None, None)]
    for bad in (("x", "ab"), ("1", "abc")):
        with pytest.raises(Exception, match="value does not fit"):
            sources.strict_load(spark.createDataFrame([bad], "n string, s string"), schema, {"s": 2}).collect()


def test_remote_needs_one_source(spark):
    with pytest.raises(ValueError):
        sources.read_remote(spark, "jdbc:none", query="SELECT 1", table="t")
