"""Spark results equal the SQL results, on the smallest tables. ALL_QUERIES=1 checks every query."""

import os

import pytest
from compare import compare, database

import __spark_entry__ as entry_points
from sparecost.testbed.queries import QUERIES, event_base, refresh
from sparecost.testbed import standins
from sparecost.testbed.standins import BASE_TABLES, LANDED, Bed, _listed, pick

DIRECTORY = "/root/testdata/sf0.001"
CHOSEN = (
    "event_base", "refresh_returns", "refresh_all_returns", "repair_link", "latest_repair", "rma_link", "override_patch", "l1_supplier", "vendor_waterfall",
    "l2_supplier_default", "final_disposition", "standard_cost_waterfall", "avg_repair_full_outer", "cons_cost_first", "cons_cost_final",
    "part_age", "scrap_alloc", "per_part_vendor_charge", "three_layer_charge", "country_inventory", "tax_alloc", "virtual_credit",
    "contract_credits", "orphan_credit", "inv_trueup_alloc", "interim_total", "archive_period", "reload_days", "reconcile",
    "duplicate_tags", "event_preview", "archive_quarter", "interim_label", "landing_filtered", "drop_recreate", "refresh_own_target", "stamp_period",
    "union_months", "charge_by_tag", "forecast_credit_older", "kitting_fee_older", "event_line_inventory", "relative_cutoffs", "event_check_filtered",
    "l1_supplier_corrected",
)


@pytest.fixture(scope="module")
def connection():
    return database(DIRECTORY)


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("ALL_QUERIES") == "1" else CHOSEN)
def test_query(spark, connection, name):
    assert compare(entry_points.queries()[name](spark, DIRECTORY), entry_points.oracle_sql()[name], connection) == ""


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql())


def test_two_returns_of_one_key_fail(spark):
    bed = Bed(spark, DIRECTORY)
    with pytest.raises(Exception, match="two source rows for key"):
        refresh(bed, bed["returns"].union(bed["returns"])).collect()


@pytest.mark.parametrize("master", ("part_master", "product_lines"))
def test_a_doubled_master_row_fails(spark, master):
    bed = Bed(spark, DIRECTORY)
    bed._made[master] = bed[master].union(bed[master])
    with pytest.raises(Exception, match="two source rows for key"):
        event_base(bed).collect()


# these store tables while they run
WRITERS = {
    "archive_period", "archive_quarter", "charges_any_spelling", "drop_recreate", "full_quarter", "full_quarter_older", "interim_label",
    "inv_reval_alloc", "inv_trueup_alloc", "landing_filtered", "refresh_own_target", "reload_days", "repair_link", "union_months",
}


def test_no_job_starts_while_a_plan_is_built(spark):
    """Files are opened for their schema by jobs of their own, so tables are read before."""
    bed, tracker = Bed(spark, DIRECTORY), spark.sparkContext.statusTracker()
    for table in BASE_TABLES:
        bed[table]
    started = []
    for name in sorted(set(QUERIES) - WRITERS):
        spark.sparkContext.setJobGroup(name, name)
        try:
            QUERIES[name].run(bed)
            started += [name] if tracker.getJobIdsForGroup(name) else []
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert started == []


def test_listed_values_are_those_of_split_part(spark):
    """Also for rows without an index, and for indexes below zero."""
    rows = spark.range(-7, 8).selectExpr("id", "CASE WHEN id % 3 <> 1 THEN id END AS k").filter("k IS NULL OR k % 3 <> -1")
    sql = f"SELECT id, {pick('k', 'a', '', 'c')} AS v, {pick('k', 'x', 'y')} AS w FROM {{rows}} WHERE k IS NULL OR k % 2 <> -1"
    assert "split_part" not in _listed(sql)
    assert sorted(map(str, spark.sql(_listed(sql), rows=rows).collect())) == sorted(map(str, spark.sql(sql, rows=rows).collect()))


def test_only_what_a_query_needs_is_landed(spark):
    """The join that others are projections of is written once, by the first query that reads it."""
    bed = Bed(spark, DIRECTORY, LANDED)
    bed["supplier_spend"]
    assert bed._stored == set() and bed.stands()
    bed["lines"], bed["returns"]
    assert bed._stored == {"sale"} and bed.stands() and bed["lines"].count() == Bed(spark, DIRECTORY)["lines"].count()


def test_a_landing_in_slices_is_the_whole_join(spark, monkeypatch):
    """Keys, months and numbers are not stored but made again, and lines meet orders slice by slice."""
    plain = Bed(spark, DIRECTORY)["sale"]
    monkeypatch.setattr(standins, "_SLICE_BYTES", 1 << 14)
    bed = Bed(spark, DIRECTORY, LANDED)
    landed = bed["sale"]
    assert landed.dtypes == plain.dtypes and len(bed._landed["sale"]) > 1
    assert landed.exceptAll(plain).count() == plain.exceptAll(landed).count() == 0
    stored = spark.read.parquet(f"{bed._folder.path}/{bed._landed['sale'][0]}").columns
    assert not {"unique_link_key", "h", "g", "sale_month"} & set(stored)
