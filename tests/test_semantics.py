import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparecost.functions import semantics as S


def value(spark, expression, **columns):
    row = spark.range(1).select(*[F.lit(v).cast(t).alias(k) for k, (v, t) in columns.items()])
    return row.select(expression.alias("v")).collect()[0]["v"]


@pytest.mark.parametrize("text, blank", [(None, True), ("", True), ("  ", True), ("x", False)])
def test_blank(spark, text, blank):
    assert value(spark, S.is_blank("c"), c=(text, "string")) is blank


@pytest.mark.parametrize("number, missing, negative", [(None, True, True), (0.0, True, False), (-1.0, False, True), (2.0, False, False)])
def test_number_tests(spark, number, missing, negative):
    assert value(spark, S.is_null_or_zero("c"), c=(number, "double")) is missing
    assert value(spark, S.is_null_or_negative("c"), c=(number, "double")) is negative


@pytest.mark.parametrize("tag, normal, usable", [
    ("FT1", "FT1", True), ("XXFT1", "FT1", True), ("$T1", "FT1", True), ("0T1", "FT1", True), ("", "", False), (None, None, None),
    ("AB1", "AB1", False), ("XFTFT2", "FTFT2", True),
])
def test_tags(spark, tag, normal, usable):
    assert value(spark, S.normalise_tag("c"), c=(tag, "string")) == normal
    assert value(spark, S.is_repair_tag("c"), c=(tag, "string")) is usable


@pytest.mark.parametrize("start, end, days, months", [
    ("2016-12-31 23:59:00", "2017-01-01 00:01:00", 1, 1), ("2017-01-01 00:00:00", "2017-01-31 23:00:00", 30, 0),
    ("2017-03-15 00:00:00", "2016-12-15 00:00:00", -90, -3),
])
def test_boundaries(spark, start, end, days, months):
    columns = {"a": (start, "timestamp"), "b": (end, "timestamp")}
    assert value(spark, S.days_between("a", "b"), **columns) == days
    assert value(spark, S.month_boundaries("a", "b"), **columns) == months


@pytest.mark.parametrize("day, period", [("2016-10-31", "2016Q4"), ("2016-11-01", "2017Q1"), ("2017-01-31", "2017Q1"), ("2017-02-01", "2017Q2")])
def test_fiscal_period(spark, day, period):
    assert value(spark, S.fiscal_period("d"), d=(day, "date")) == period
    label = period[4:] + period[2:4]
    assert value(spark, S.fiscal_quarter_label("m"), m=(day.replace("-", "")[:6], "string")) == label


def test_period_arithmetic(spark):
    assert [S.previous_period(p) for p in ("2017Q1", "2017Q3")] == ["2016Q4", "2017Q2"]
    assert value(spark, S.previous_period_col("p"), p=("2017Q1", "string")) == "2016Q4"
    assert value(spark, S.add_to_month("m", 2), m=("201611", "string")) == "201701"


@pytest.mark.parametrize("today", ["2024-01-14", "2024-01-17", "2024-01-20"])
def test_last_full_week(spark, today):
    first, last = spark.range(1).select(*S.last_full_week(today)).collect()[0]
    assert (first, last) == (dt.date(2024, 1, 6), dt.date(2024, 1, 12))


def test_division_by_zero_is_null(spark):
    assert value(spark, S.safe_ratio("a", "b"), a=(1.0, "double"), b=(0.0, "double")) is None


def test_region_recode(spark):
    assert value(spark, S.recode_region("r"), r=("AMS", "string")) == "AME"


def test_cutoffs_follow_the_cost_month():
    from sparecost.rules import Period, add_months

    assert [add_months("201611", n) for n in (0, 1, 2, 14, -11)] == ["201611", "201612", "201701", "201801", "201512"]
    period = Period.relative("2017Q1", "201611", "201701", "201611", "2016-12-15")
    assert (period.repair_cutoff, period.return_cutoff_month, period.rma_cutoff_month) == ("2017-02-01 00:00:00", "201701", "201701")
