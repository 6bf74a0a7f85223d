"""Small fixtures for rules that the benchmark tables do not reach one by one."""

import pytest
from pyspark.sql import functions as F

from sparecost.operators import SALT, hot_keys, salted
from sparecost.plans import checks, consumption, credits, disposition, interim, inventory, link, pools, supplier
from sparecost.rules import Period

P = "2017Q1"
LINE = ("unique_link_key string, region string, receipt_type string, flow_tag string, actual_disposition string, dcr_disposition string, "
        "hub_disposition string, l2_supplier string, supplier_type string, repair_disposition string, repair_warranty_status string, "
        "rma_engineer_approval string, data_period string")
DEFAULT = dict(region="APJ", receipt_type="Physical Receipt", flow_tag="FT1", data_period=P)
CASES = [
    (dict(hub_disposition="RP"), "RP"),
    (dict(hub_disposition="RP", l2_supplier="PCG X", repair_warranty_status="Warranty Repair", repair_disposition="NFF"), "NFF"),
    (dict(l2_supplier="PCG X", repair_warranty_status="Warranty Repair", repair_disposition="Repaired"), "IW Credit"),
    (dict(l2_supplier="CONVERGE", repair_warranty_status="Non Warranty Repair", repair_disposition="Repaired"), "OOW Credit"),
    (dict(flow_tag="FT-FLAG", hub_disposition="RP"), "OOW Repair"),
    (dict(flow_tag="FT-BOTH", hub_disposition="RP"), "IW Exch"),
    (dict(hub_disposition="CD11"), "In Transit"),
    (dict(hub_disposition="CD11", dcr_disposition="FG01"), "Good Unused"),
    (dict(hub_disposition="SC23", rma_engineer_approval="Yes"), "Scrap at Supplier"),
    (dict(dcr_disposition="SC23"), "Scrap in Central"),
    (dict(receipt_type="Logical Receipt", dcr_disposition="SC99"), "Logical Receipt"),
    (dict(dcr_disposition="SC01"), "Scrap in Central"),
    (dict(hub_disposition="OLD"), "NEW"),
    (dict(region="AME", receipt_type="Logical Receipt", actual_disposition="SC99"), "Logical Receipt"),
    (dict(region="EMEA", l2_supplier="RRD", repair_disposition="NFF"), "NFF"),
    (dict(region="EMEA", repair_disposition="Process Scrapped"), "Scrap at Supplier"),
    (dict(region="AME", repair_disposition="Process Scrapped", actual_disposition="SC12"), "Scrap in Central"),
    (dict(region="AME", supplier_type="RFC", repair_disposition="Repaired", repair_warranty_status="W", actual_disposition="SC12"), "TYPE RULE"),
    (dict(region="AME", supplier_type="RFC", l2_supplier="SPC", repair_disposition="Repaired", repair_warranty_status="W"), "SUPPLIER RULE"),
    (dict(region="AME", supplier_type="RFC", repair_disposition="Repaired", repair_warranty_status="W", actual_disposition="IT21"), "In Transit"),
    (dict(region="EMEA", actual_disposition="DS01"), "Good Unused"),
    (dict(region="EMEA", actual_disposition="DS01", receipt_type="No Receipt", flow_tag=None), "Non Return"),
    (dict(region="EMEA"), "Part-Level Cost"),
    (dict(region="EMEA", actual_disposition="DS01", flow_tag=None), "Unknown"),
    (dict(region="EMEA", actual_disposition="DS01", flow_tag=""), "Unknown"),
]


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def records(spark, schema, *data):
    names = [c.strip().split()[0] for c in schema.split(",")]
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in data], schema)


def test_disposition_rules_in_order(spark):
    lines = records(spark, LINE, *[{**DEFAULT, **case, "unique_link_key": str(i)} for i, (case, _) in enumerate(CASES)])
    tag_flag = frame(spark, "flow_tag string, disposition string, data_period string", ("FT-FLAG", "OOW Repair", P), ("FT-BOTH", "OOW Repair", P), ("FT1", "X", "2016Q4"))
    tag_vendor = frame(spark, "flow_tag string, final_disposition string, data_period string", ("FT-BOTH", "IW Exch", P))
    remap = frame(spark, "region string, final_disp_flag string, correct_disposition string", ("APJ", "OLD", "NEW"))
    rules = frame(spark, "supplier string, repair_disposition string, repair_warranty_status string, final_disp_flag string",
                  ("RFC", "Repaired", "W", "TYPE RULE"), ("SPC", "Repaired", "W", "SUPPLIER RULE"), ("Other", "Repaired", "W", "NO"))
    got = {r[0]: r[1] for r in disposition.final_disposition(lines, tag_flag, tag_vendor, remap, rules, P).select("unique_link_key", "final_disp_flag").collect()}
    assert [got[str(i)] for i in range(len(CASES))] == [want for _, want in CASES]


def test_tag_shared_by_lines_and_repairs_keeps_one_row(spark):
    lines = frame(spark, "unique_link_key string, flow_tag string, phy_part_no_rec_date timestamp",
                  *[(f"k{i}", "FT1" if i < 4 else None if i < 6 else "FT2", None) for i in range(8)])
    repairs = spark.sql("""SELECT id AS repair_id, 'FT1' AS flow_tag, TIMESTAMP '2017-01-01' + make_interval(0, 0, 0, CAST(id AS INT)) AS upload_date,
      'Valid' AS record_status, 'V' AS vendor_name, 'O' AS oem_name, 'D' AS final_disposition, 'W' AS warranty_vendor FROM range(5)""")
    period = Period(repair_cutoff="2017-01-04 12:00:00")
    kept = link.latest_repair(lines, repairs, period)
    assert sorted((r["unique_link_key"], r["repair_tag_used"]) for r in kept.collect()) == [
        ("k0", "Y"), ("k4", None), ("k5", None), ("k6", None), ("k7", None)]
    everything = link.repair_link(lines, repairs, period)
    assert everything.filter("repair_tag_used = 'N'").count() == 4 * 4 - 1
    used = everything.filter("repair_tag_used = 'Y'").collect()
    assert [(r["unique_link_key"], r["repair_id"]) for r in used] == [("k0", 3)]


@pytest.mark.parametrize("strict, kind", [(True, "Repair"), (False, "RFC")])
def test_first_supplier_type_quirk(spark, strict, kind):
    lines = frame(spark, "region string, rma_vendor_name string, repair_vendor string, dcr_vendor_name string, received_plant string, "
                  "dcr_disposition string, actual_disposition string", ("APJ", None, "V1", "V2", None, None, None))
    masters = frame(spark, "received_plant string, region string, l1_supplier_name string, supplier_type string", ("P", "AME", "S", "RFC"))
    codes = masters.withColumnRenamed("received_plant", "disposition")
    rfc = frame(spark, "l1_supplier_name string, supplier_type string", ("V1", "RFC"))
    out = supplier.first_assignment(supplier.add_supplier_columns(lines), masters, codes, rfc, strict).collect()[0]
    assert (out["l1_supplier"], out["l1_supplier_source"], out["supplier_type"]) == ("V1", "RWT", kind)


def test_null_in_a_not_in_list(spark):
    df = frame(spark, "v string", ("a",), ("b",), (None,))
    listed = frame(spark, "n string", ("a",), (None,))
    assert [r["v"] for r in checks.not_in(df, "v", listed, "n").collect()] == ["b"]


def test_second_pass_later_rules_win(spark):
    schema = ("final_disp_flag string, l2_supplier string, credits double, event_pn_rvs double, physical_pn_rvs double, physical_pn_nbs double, cons_cost double")
    lines = frame(spark, schema, ("NFF", "RRD", -1.0, 10.0, 8.0, 9.0, 5.0), ("NFF", "PCG", -1.0, 10.0, 8.0, 9.0, 5.0),
                  ("Non Return", None, None, 10.0, 8.0, 9.0, 5.0), ("Scrap in Central", None, -1.0, 10.0, 8.0, 9.0, 5.0),
                  ("Scrap at Supplier", None, -1.0, 10.0, 8.0, 9.0, 5.0), ("IW Credit", None, -1.0, 10.0, None, 9.0, 5.0), ("Other", None, -1.0, 1.0, 1.0, 1.0, 5.0))
    got = [r["cons_cost"] for r in consumption.second_pass(lines).collect()]
    assert got == [0.0, 7.0, 10.0, 8.0, 7.0, -1.0, 5.0]


def test_relabel_comments(spark):
    lines = frame(spark, "event_pn_rvs double, kit_pn_rvs double, physical_pn_rvs double", (5.0, 5.0, 5.0), (0.0, 5.0, 4.0), (6.0, 5.0, None))
    got = [tuple(r) for r in consumption.relabel_and_dekit(lines).select("relabel_cost", "dekit_cost", "relabel_cost_comment", "dekit_cost_comment").collect()]
    assert got == [(0.0, 0.0, "Same Kit Part Number", "Same Physical Part Number"), (0.0, 1.0, "Missing RVS", None), (1.0, 0.0, None, "Missing RVS")]


def test_variance_total_equals_pool(spark):
    lines = spark.range(1000).select(
        F.col("id").cast("string").alias("unique_link_key"), F.when(F.col("id") % 3 == 0, "APJ").otherwise("AME").alias("region"),
        F.lit("US").alias("event_country_iso_cd"), F.lit("07").alias("event_spl"), (F.col("id") % 7).cast("int").alias("part_qty_consumed"))
    pool = frame(spark, "region string, l06_ba_code string, actuals_usd double, data_period string", ("APJ", "07XX", 1234.5, P), ("AME", "07YY", -99.25, P))
    total = {r[0]: r[1] for r in pools.variance(lines, pool, P).groupBy("region").agg(F.sum("esc_variance")).collect()}
    assert total["APJ"] == pytest.approx(1234.5) and total["AME"] == pytest.approx(-99.25)


def test_interim_labels_and_null_keys(spark):
    assert interim.interim_label("2017Q1") == "2016Q4-2017Q1"
    schema = ("unique_link_key string, region string, part_number string, warranty_flag string, dmr_status string, part_qty_consumed int, "
              "part_qty_demanded int, event_pn_nrs double, event_spl string, cons_cost double, nppo_cost double, relabel_cost double, "
              "dekit_cost double, taxes double, total_matl_cost double, data_period string")
    def row(key, warranty, consumed, demanded, period, spl="07"):
        return (key, "APJ", "P1", warranty, "No DMR", consumed, demanded, 4.0, spl, 3.0, None, 1.0, 0.0, 0.0, 10.0, period)
    history = frame(spark, schema, row("a", "IW", 2, 2, "2016Q4"), row("b", "IW", 4, 4, "2016Q4"), row("c", "IW", 0, 5, "2016Q4"),
                    row("d", "IW", 1, 1, "2017Q1"), row("e", None, 1, 1, "2017Q1"), row("f", "IW", 0, 3, "2017Q1"), row("g", None, 2, 2, "2017Q1", None))
    adders = frame(spark, "region string, event_spl string, non_nrs_rate double, data_period string", ("APJ", "07", 0.5, "2017Q1"), ("APJ", "All Others", 2.0, "2016Q4"))
    got = {r["unique_link_key"]: (r["interim_option"], float(r["interim_total"]), r["interim_cons_cost"]) for r in interim.interim_costs(history, adders, "2017Q1").collect()}
    assert got["d"][:2] == ("Option 1 - PART CONS", 30.0) and float(got["d"][2]) == 9.0
    assert got["f"][:2] == ("Option 1 - DEMAND BUT NO CONS", 50.0) and float(got["f"][2]) == 0.0
    assert got["e"][:2] == ("Option 2", 4.5) and got["g"][:2] == ("Option 2", 12.0)


def test_a_tag_of_a_third_of_the_lines_is_dealt_over_many_parts(spark):
    """The same rows with and without salt; no pair of tag and salt holds a large share of the hot tag's lines."""
    lines = spark.sql("""SELECT CAST(id AS STRING) AS unique_link_key, 'APJ' AS region, CASE WHEN id % 3 = 0 THEN 'FT1' WHEN id % 3 = 1 THEN 'FT' || id END AS flow_tag,
      CAST(NULL AS TIMESTAMP) AS phy_part_no_rec_date FROM range(3000)""")
    repairs = spark.sql("""SELECT id AS repair_id, CASE WHEN id < 6 THEN 'FT1' ELSE 'FT' || id END AS flow_tag, TIMESTAMP '2017-01-01' + make_interval(0, 0, 0, CAST(id % 100 AS INT)) AS upload_date,
      'Valid' AS record_status, 'V' AS vendor_name, 'O' AS oem_name, 'D' AS final_disposition, 'W' AS warranty_vendor FROM range(400)""")
    period = Period(repair_cutoff="2018-01-01 00:00:00")
    plain, dealt = (link.repair_link(lines, repairs, period, hot_rows=n) for n in (10_000, 100))
    def key(df):
        return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))
    assert key(plain) == key(dealt) and dealt.filter("repair_tag_used = 'Y'").count() == plain.filter("repair_tag_used = 'Y'").count()
    hot = hot_keys(lines, "flow_tag", 100)
    assert [r[0] for r in hot.collect()] == ["FT1"]
    sizes = [r["count"] for r in salted(lines, "flow_tag", hot, 64).filter("flow_tag = 'FT1'").groupBy(SALT).count().collect()]
    assert len(sizes) > 50 and max(sizes) < 50
    counted = {r["region"]: r["duplicate_records"] for r in checks.duplicate_tags(lines, repairs, period).collect()}
    assert counted == {"APJ": 6 * 1001}


def test_lines_without_an_item_do_not_share_a_key(spark):
    lines = spark.range(2000).select(F.col("id").cast("string").alias("unique_link_key"), F.lit("APJ").alias("region"), F.lit(None).cast("string").alias("so_item"))
    flags = frame(spark, "region string, so_item string, dmr_flag string", ("APJ", "S1", "DMR"))
    found = credits.dmr_status(lines, flags)
    assert {r[0] for r in found.select("dmr_status").distinct().collect()} == {"No DMR"} and "__item" not in found.columns


def reads(df, path):
    """How often the final plan of a DataFrame reads files, of a folder if its name is short."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return sum(path in line for line in plan.splitlines() if "FileScan" in line)


def test_interim_reads_each_quarter_once(spark, tmp_path):
    schema = ("unique_link_key string, region string, part_number string, warranty_flag string, dmr_status string, part_qty_consumed int, "
              "part_qty_demanded int, event_pn_nrs double, event_spl string, cons_cost double, nppo_cost double, relabel_cost double, "
              "dekit_cost double, taxes double, total_matl_cost double, data_period string")
    lines = [(f"{p}{i}", "APJ", "P1", "IW", "No DMR", i, 2, 4.0, "07", 3.0, None, 1.0, 0.0, 0.0, 10.0, p) for p in ("2016Q4", "2017Q1", "2017Q2") for i in range(3)]
    frame(spark, schema, *lines).write.partitionBy("data_period").parquet(str(tmp_path / "history"))
    history = spark.read.schema(schema).parquet(str(tmp_path / "history"))
    found = interim.interim_costs(history, None, "2017Q1")
    assert reads(found, "parquet") == 2 and found.count() == 3


def test_stock_is_read_once(spark, tmp_path):
    schema = ("region string, support_product_line string, subregion string, type string, country string, plant string, location string, condition string, "
              "source string, value_current double, reserve_current double")
    stock = frame(spark, schema, *[("APJ", "07", "S", "T", "JP", "P1", f"L{i % 3}", "Good", "X", 1.0 + i, 0.5) for i in range(30)])
    for name in ("start", "end"):
        stock.write.parquet(str(tmp_path / name))
    keys = frame(spark, "inv_plant_location string, special_alloc_key string", ("P1L0", "K"))
    cube = frame(spark, "region_l2 string, spl string, type string, adj_cube double", ("APJeC", "07", "Std Rev Costs", 100.0), ("APJeC", "07", "E&O Costs", 10.0))
    start, end = (spark.read.schema(schema).parquet(str(tmp_path / name)) for name in ("start", "end"))
    places = inventory.allocation_key(inventory.snapshot(start), inventory.end_reserve(end), keys)
    assert (reads(places, "/start"), reads(places, "/end")) == (1, 1)
    model = inventory.inventory_model(start, end, keys, cube)
    assert reads(model, "/start") == 0 and reads(model, "/end") == 0
    assert sum(r["std_rev_usd"] for r in model.collect()) == pytest.approx(100.0)


def _largest(df, name):
    """Rows of the fullest partition of a joined stage, shuffled by 8."""
    return max(r[0] for r in df.groupBy(F.spark_partition_id().alias(name)).count().select("count").collect())


def _lines_without_tags(spark, n=4000):
    columns = {"region": F.lit("EMEA"), "repair_disposition": F.lit("a"), "repair_warranty_status": F.lit("b"), "l1_supplier": F.lit("c"), "l2_supplier": F.lit("d"),
               "nppo_cost": F.lit(0.0), "flow_tag": F.lit(None).cast("string"), "part_number": F.lit("P"), "repair_tag_used": F.lit(None).cast("string"),
               "part_qty_consumed": F.lit(1), "part_commodity": F.lit("Hard Drive")}
    return spark.range(n).select(F.col("id").cast("string").alias("unique_link_key"), *[c.alias(name) for name, c in columns.items()])


@pytest.fixture
def shuffled(spark):
    """Only shuffle joins, as with large masters."""
    given = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for key, value in given.items():
        spark.conf.set(key, value)


def test_lines_without_a_tag_or_vendor_are_spread(spark, shuffled):
    lines = _lines_without_tags(spark)
    patch = frame(spark, "flow_tag string, repair_disposition string, repair_warranty_status string", ("FT1", "x", "y"))
    charges = frame(spark, "vendor string, part_number string, charge double, data_period string", ("SPC", "P", 1.0, P), ("SPC", "Total Credit", -1.0, P))
    named = frame(spark, "flow_tag string, final_vendor string, data_period string", ("FT1", "x", P))
    second = frame(spark, "flow_tag string, l1_supplier string, data_period string", ("FT1", "x", P))
    for done in (link.override_repairs(lines, {"EMEA": [patch]}), supplier.override_by_tag(lines, named, second, P), pools.part_charges(lines, charges, P)):
        assert done.columns == lines.columns and done.count() == 4000
        assert _largest(done, "part") < 2000


def test_lines_of_a_region_stay_apart(spark, shuffled):
    """A pool by region does not bring the lines of the region together."""
    lines = _lines_without_tags(spark).withColumns({"part_qty_demanded": F.lit(2), "event_pn_rvs": F.lit(1.0)})
    costs = frame(spark, "region string, cost_value double, data_period string", ("EMEA", 8000.0, P))
    done = pools.non_event(lines, costs, P)
    assert {r[0] for r in done.select("non_event_cost").collect()} == {2.0}
    assert _largest(done, "part") < 2000


def _exchanges(df, *of):
    """Shuffles of a plan by these columns or of anything."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and all(c in line for c in of)]


def test_pools_of_closed_lists_do_not_shuffle_lines(spark, shuffled):
    lines = _lines_without_tags(spark).withColumns({
        "part_qty_demanded": F.lit(2), "event_spl": F.lit("01"), "l2_supplier": F.lit("PCG"), "country_inv_costs": F.lit(None).cast("double"),
        "event_country_iso_cd": F.lit("US"), "region": F.lit("APJ")})
    by_country = frame(spark, "spl string, iso_country_code string, sub_region string, total_inv_cost double, data_period string", ("01", "US", "S", 8000.0, P))
    spend = frame(spark, "supplier string, spend double, data_period string", ("PCG", 8000.0, P))
    for done in (pools.country_inventory(lines, by_country, by_country.drop("sub_region"), P), pools.charge_by_supplier(lines, spend, P)):
        assert done.count() == 4000 and not [x for x in _exchanges(done) if "l2_supplier#" in x and "sum" not in x]
        assert "unique_link_key" not in "".join(_exchanges(done)) and _largest(done, "part") < 2000
