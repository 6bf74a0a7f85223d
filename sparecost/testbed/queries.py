"""Every operator of the model as a query over the benchmark tables, with its check in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparecost import rules as R
from sparecost import sources
from sparecost.functions import semantics as S
from sparecost.operators import latest_per_key, merge_update
from sparecost.plans import archive, base, checks, consumption, credits, disposition, interim, inventory, link, pools, quarter, standards, supplier
from sparecost.plans.archive import ARCHIVE_COLUMNS
from sparecost.session import Stages, checkpoint_dir, stage_end
from sparecost.testbed import oracle as O
from sparecost.testbed.standins import COST_MONTH, PERIOD, PREVIOUS, Bed, ctes

RUN = R.Period(
    period=PERIOD, start_month="199501", end_month="200112", cost_month=COST_MONTH, mid_quarter="1996-12-15",
    repair_cutoff="2024-01-25 00:00:00", return_cutoff_month="200103", rma_cutoff_month="200104",
)
KEY = "unique_link_key"


@dataclass
class Query:
    run: Callable[[Bed], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def show(df: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns in comparable types: amounts rounded to four decimals, shares and unit rates to ten, counts as long."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in columns or df.columns:
        kind = kinds[c]
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            unit = 1e10 if c in O.FINE else 1e4
            scaled = F.floor(F.col(c).cast("double") * unit + 0.5).cast("double")
            out.append((scaled / unit).alias(c))
        elif isinstance(kind, T.IntegralType):
            out.append(F.col(c).cast("long").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def num(c: str) -> str:
    name = c.split('.')[-1]
    return f"{O.rounded(c, name in O.FINE)} AS {name}"


def whole(c: str) -> str:
    return f"CAST({c} AS BIGINT) AS {c.split('.')[-1]}"


def on_lines(name: str, run: Callable[[DataFrame, Bed], DataFrame], columns: tuple[str, ...], inputs: tuple[str, ...], *steps,
             without: tuple[str, ...] = ()) -> None:
    """A step over the mid-run lines; `without` are the columns that the step creates itself."""
    first = f"SELECT * EXCLUDE ({', '.join(without)}) FROM lines" if without else "SELECT * FROM lines"
    QUERIES[name] = Query(
        lambda bed: show(run(bed["lines"].drop(*without), bed), KEY, *columns),
        O.chain(("lines", *inputs), (KEY, *columns), *steps, first=first),
    )


def plain(name: str, run: Callable[[Bed], DataFrame], inputs: tuple[str, ...], select: str, parts: list | None = None) -> None:
    QUERIES[name] = Query(lambda bed: show(run(bed)), O.statement(inputs, parts or [], select))


# ---- event base and links ---------------------------------------------------------------------

BASE_INPUTS = ("service_events", "part_master", "product_lines", "returns", "activity")
BASE_COLUMNS = (
    "master_event_activity_month", "source_system", "region", "event_country_iso_cd", "part_number", "part_qty_demanded",
    "part_qty_consumed", "event_spl", "sc_spl", "part_spl", "part_commodity", "part_description", "l2_reverse_unique_link_key",
    "received_month", "flow_tag", "actual_disposition", "receipt_type", "ct_code_label", "received_plant", "part_qty_received",
)


def event_base(bed: Bed) -> DataFrame:
    return base.event_base(*[bed[n] for n in BASE_INPUTS], RUN)


def on_base(name, run, columns, inputs, *steps, first_steps=()) -> None:
    """A step of the link stage, over the real event base and the link steps before it."""
    QUERIES[name] = Query(
        lambda bed: show(run(bed), *((KEY,) if KEY not in columns else ()), *columns),
        O.chain((*BASE_INPUTS, *inputs), (KEY, *columns), *first_steps, *steps, first=O.BASE),
    )


on_base("event_base", event_base, BASE_COLUMNS, ())
plain("receipt_type", lambda bed: base.return_columns(bed["returns"]).select(KEY, "receipt_type", "flow_tag"), ("returns",),
      f"SELECT unique_link_key, {O.RECEIPT} AS receipt_type, {O.b_over_a('flow_tag_number')} AS flow_tag FROM returns r")
plain("pick_b_over_a",
      lambda bed: base.return_columns(bed["returns"]).select(KEY, "received_month", "actual_disposition", "ct_code_label", "received_plant"),
      ("returns",),
      f"""SELECT unique_link_key, {O.b_over_a('received_month')} AS received_month, {O.b_over_a('actual_disposition')} AS actual_disposition,
      {O.b_over_a('received_part_serial_number')} AS ct_code_label, {O.b_over_a('received_plant_id')} AS received_plant FROM returns r""")

RETURN_OUT = ("l2_reverse_unique_link_key", "received_month", "flow_tag", "actual_disposition", "ct_code_label", "received_plant", "receipt_type")


def refresh(bed: Bed, returns: DataFrame) -> DataFrame:
    """Lines of one period get their return columns again; the other lines keep them."""
    lines = event_base(bed).withColumn("data_period", F.when(F.col("part_qty_demanded") > 25, F.lit(PERIOD)).otherwise(F.lit(PREVIOUS)))
    return show(base.refresh_returns(lines, returns, PERIOD), KEY, *RETURN_OUT)


def refresh_sql(where: str) -> str:
    new = dict(zip(RETURN_OUT, (
        "r.unique_link_key", *map(O.b_over_a, ("received_month", "flow_tag_number", "actual_disposition", "received_part_serial_number",
                                               "received_plant_id")), O.RECEIPT)))
    picked = ", ".join(f"CASE WHEN b.part_qty_demanded > 25 THEN {new[c]} ELSE b.{c} END AS {c}" for c in RETURN_OUT)
    return O.statement(BASE_INPUTS, [("b", O.BASE)], f"""
SELECT b.unique_link_key, {picked} FROM b LEFT JOIN (SELECT * FROM returns WHERE {where}) r ON b.unique_link_key = r.unique_link_key""")


QUERIES["refresh_returns"] = Query(lambda bed: refresh(bed, bed["returns"].filter("match_fl = 'M'")), refresh_sql("match_fl = 'M'"))
QUERIES["refresh_all_returns"] = Query(lambda bed: refresh(bed, bed["returns"]), refresh_sql("TRUE"))

REPAIR_OUT = ("repair_vendor", "repair_flow_tag", "repair_oem_name", "repair_disposition", "repair_warranty_status",
              "repair_upload_month", "repair_upload_date", "repair_tag_used", "repair_tat")
# the lines of the base with what the link reads, and what shows that each of its joins was made
LINK_READS = (KEY, "flow_tag", "phy_part_no_rec_date", "sc_spl", "part_spl", "event_spl", "part_commodity", "receipt_type")
on_base("repair_link", lambda bed: link.repair_link(stage_end(event_base(bed).select(*LINK_READS)), bed["repairs"], RUN), ("repair_id", *REPAIR_OUT), ("repairs",), O.repair_link)
on_base("latest_repair", lambda bed: link.latest_repair(event_base(bed), bed["repairs"], RUN), REPAIR_OUT, ("repairs",), O.latest_repair)
plain("clean_repairs", lambda bed: link.clean_repairs(bed["repairs"], RUN, ("202401", "202412")), ("repairs",),
      f"""SELECT flow_tag, repair_id, {O.REPAIR_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY flow_tag ORDER BY upload_date DESC,
      repair_id DESC) rn FROM repairs WHERE upload_month BETWEEN '202401' AND '202412' AND record_status IN ('Valid','Warning') AND
      (flow_tag LIKE '%FT%' OR flow_tag LIKE '$T%' OR flow_tag LIKE '0T%')) r WHERE rn = 1""")
plain("tag_normalise",
      lambda bed: bed["repairs"].select("repair_id", "flow_tag", S.normalise_tag("flow_tag").alias("normal_tag"),
                                        S.is_repair_tag("flow_tag").alias("is_tag")), ("repairs",),
      f"""SELECT repair_id, flow_tag, {O.normal_tag('flow_tag')} AS normal_tag,
      (flow_tag LIKE '%FT%' OR flow_tag LIKE '$T%' OR flow_tag LIKE '0T%') AS is_tag FROM repairs""")
plain("turnaround_days",
      lambda bed: bed["sale"].join(bed["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey").select(
          KEY, S.days_between("o_orderdate", "l_shipdate").alias("days"), S.month_boundaries("o_orderdate", "l_shipdate").alias("months")),
      ("sale",), """SELECT unique_link_key, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS BIGINT) AS days,
      CAST((year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS BIGINT) AS months
      FROM sale JOIN orders ON l_orderkey = o_orderkey""")


def cleaned(bed: Bed) -> DataFrame:
    return link.clean_part_numbers(link.latest_repair(event_base(bed), bed["repairs"], RUN))


LINKED = (O.latest_repair, O.clean_parts)
on_base("part_number_clean", cleaned, ("received_part_kit_part_number", "physical_part_number"), ("repairs",), *LINKED)
plain("latest_return", lambda bed: link.latest_return(bed["dc_returns"], RUN), ("dc_returns",), f"SELECT * EXCLUDE (rn) FROM {O.DCR} b WHERE rn = 1")
on_base("two_pass_link", lambda bed: link.link_returns(cleaned(bed), bed["dc_returns"], RUN), O.DCR_COLUMNS, ("repairs", "dc_returns"),
        *LINKED, O.link_returns)
FOLLOWING = R.Period.relative(PERIOD, "199501", "200112", COST_MONTH, "1996-12-15")
UPLOADED = R.Period.relative(PERIOD, "199501", "200112", "202311", "2023-12-15")


def relative_cutoffs(bed: Bed) -> DataFrame:
    """Tags of returns, RMA rows and repairs in use where the cut-offs follow the cost month; repairs have a later one of their own."""
    found = {"return": link.latest_return(bed["dc_returns"], FOLLOWING), "rma": link.latest_rma(bed["rma"], FOLLOWING),
             "repair": link.usable_repairs(bed["repairs"], UPLOADED)}
    return sources.append_tables(*[df.select(F.lit(name).alias("source"), "flow_tag") for name, df in found.items()])


plain("relative_cutoffs", relative_cutoffs, ("dc_returns", "rma", "repairs"), """
SELECT DISTINCT 'return' AS source, flow_tag FROM dc_returns WHERE disp_location <> 'XXXX' AND report_month <= '199703' AND flow_tag IS NOT NULL
UNION ALL SELECT DISTINCT 'rma', flow_tag FROM rma WHERE strftime(container_release, '%Y%m') <= '199703' AND flow_tag IS NOT NULL
UNION ALL SELECT 'repair', flow_tag FROM repairs WHERE record_status IN ('Valid','Warning') AND strftime(upload_date, '%Y%m') <= '202401'
AND (flow_tag LIKE '%FT%' OR flow_tag LIKE '$T%' OR flow_tag LIKE '0T%')""")
plain("latest_rma", lambda bed: link.latest_rma(bed["rma"], RUN), ("rma",),
      f"SELECT * EXCLUDE (rn, actual_credit), {num('actual_credit')} FROM {O.RMA} b WHERE rn = 1")
on_base("rma_link", lambda bed: link.link_rma(link.link_returns(cleaned(bed), bed["dc_returns"], RUN), bed["rma"], RUN),
        tuple(O.RMA_COLUMNS), ("repairs", "dc_returns", "rma"), *LINKED, O.link_returns, O.link_rma)
on_lines("region_pick", lambda lines, bed: link.pick_hub_values(lines), ("hub_received_plant", "hub_disposition"), (), O.pick_hub,
         without=("hub_disposition",))
PATCHES = ("patches_ame", "patches_ame_b", "patches_emea", "patches_emea_b")
on_lines("override_patch",
         lambda lines, bed: link.override_repairs(lines, {"AME": [bed[PATCHES[0]], bed[PATCHES[1]]], "EMEA": [bed[PATCHES[2]], bed[PATCHES[3]]]}),
         ("repair_disposition", "repair_warranty_status"), PATCHES, O.override)

# ---- suppliers and disposition --------------------------------------------------------------------

SUPPLIER_OUT = ("l1_supplier", "l1_supplier_source", "l2_supplier", "supplier_type")
on_lines("l1_supplier", lambda lines, bed: supplier.first_assignment(
    supplier.add_supplier_columns(lines), bed["plant_supplier"], bed["disposition_supplier"]), SUPPLIER_OUT,
    ("plant_supplier", "disposition_supplier"), O.empty_suppliers, O.first_assignment, without=SUPPLIER_OUT)
on_lines("l1_supplier_corrected", lambda lines, bed: supplier.first_assignment(
    supplier.add_supplier_columns(lines), bed["plant_supplier"], bed["disposition_supplier"], bed["rfc_suppliers"], False), SUPPLIER_OUT,
    ("plant_supplier", "disposition_supplier", "rfc_suppliers"), O.empty_suppliers, O.corrected_assignment, without=SUPPLIER_OUT)
plain("latest_vendor_per_part", lambda bed: supplier.contract_vendors(bed["contract_vendor"], PERIOD), ("contract_vendor",),
      f"SELECT * FROM {O.vendors_of('contract_vendor')} b")
on_lines("vendor_waterfall", lambda lines, bed: supplier.contract_fallback(lines, bed["contract_vendor"], bed["new_buy_vendor"], PERIOD),
         SUPPLIER_OUT, ("contract_vendor", "new_buy_vendor"), O.contract_fallback)
on_lines("supplier_override", lambda lines, bed: supplier.override_by_tag(lines, bed["tag_vendor"], bed["tag_supplier"], PERIOD),
         SUPPLIER_OUT, ("tag_vendor", "tag_supplier"), O.override_by_tag)
on_lines("l2_supplier_default", lambda lines, bed: supplier.second_level(lines, bed["l2_supplier_map"], PERIOD), SUPPLIER_OUT,
         ("l2_supplier_map",), O.second_level)
on_lines("last_vendor_fallback", lambda lines, bed: supplier.last_fallback(lines, bed["contract_vendor"], PERIOD), SUPPLIER_OUT,
         ("contract_vendor",), O.last_fallback)
FLAG_INPUTS = ("tag_flag", "tag_vendor", "code_remap", "flag_rules")
on_lines("final_disposition", lambda lines, bed: disposition.final_disposition(lines, *[bed[n] for n in FLAG_INPUTS], PERIOD),
         ("final_disp_flag",), FLAG_INPUTS, O.final_disposition, without=("final_disp_flag",))

# ---- standards and consumption ----------------------------------------------------------------------

COST_INPUTS = ("regional_cost", "sap_cost", "cost_adjustment", "service_standard")
on_lines("standard_cost_waterfall", lambda lines, bed: standards.standard_costs(lines, *[bed[n] for n in COST_INPUTS], RUN), O.COSTS,
         COST_INPUTS, O.standard_costs, without=tuple(c for c in O.COSTS if c != "physical_pn_nrs"))
plain("avg_repair_full_outer", lambda bed: standards.repair_averages(bed["repair_orders"], "1997", "Q1"), ("repair_orders",), f"""
SELECT CASE WHEN COALESCE(a.region, b.region) = 'AMS' THEN 'AME' ELSE COALESCE(a.region, b.region) END AS region,
  COALESCE(a.material, b.material) AS material, floor((a.cost) * 10000.0e0 + 0.5e0) / 10000.0e0 AS oow_avg_repair_cost, floor((b.cost) * 10000.0e0 + 0.5e0) / 10000.0e0 AS oow_iw_avg_repair_cost,
  '1997Q1' AS data_period
FROM (SELECT region, material, {O.dec('abs(spend)')} / NULLIF({O.dec('abs(qty)')}, 0) AS cost FROM repair_orders WHERE sub_order_type IN
  ('YI1P','ZSR','ZSRA') AND fiscal_quarter = 'Q1' GROUP BY region, material) a
FULL JOIN (SELECT region, material, {O.dec('abs(spend)')} / NULLIF({O.dec('abs(qty)')}, 0) AS cost FROM repair_orders WHERE sub_order_type IN
  ('YI1P','ZSR','ZSRA','ZSX') AND fiscal_quarter = 'Q1' GROUP BY region, material) b ON a.region = b.region AND a.material = b.material""")
plain("repair_order_detail", lambda bed: standards.repair_order_detail(bed["repair_orders"], "1997", "Q1"), ("repair_orders",), f"""
SELECT region, vendor_id, vendor_name, sub_order_type, po_number, material, CAST(SUM(qty) AS BIGINT) AS total_qty,
  floor(({O.dec('spend')}) * 10000.0e0 + 0.5e0) / 10000.0e0 AS total_spend, '1997Q1' AS data_period FROM repair_orders WHERE sub_order_type IN ('YI1P','ZSR','ZSRA','ZSX')
  AND fiscal_year = '1997' AND fiscal_quarter = 'Q1' GROUP BY ALL""")
on_lines("avg_gt_standard", lambda lines, bed: standards.link_repair_average(lines, bed["repair_average"], PERIOD),
         ("oow_avg_repair_cost", "oow_iw_avg_repair_cost", "avg_above_standard"), ("repair_average",), O.repair_average,
         without=("oow_avg_repair_cost", "oow_iw_avg_repair_cost"))
on_lines("cons_cost_first", lambda lines, bed: consumption.first_pass(lines, bed["service_standard"]), ("cons_cost", "cons_cost_notes"),
         ("service_standard",), O.first_pass, without=("cons_cost",))
on_lines("relabel_dekit", lambda lines, bed: consumption.relabel_and_dekit(lines),
         ("relabel_cost", "dekit_cost", "relabel_cost_comment", "dekit_cost_comment"), (), O.relabel, without=("relabel_cost", "dekit_cost"))
on_lines("part_age", lambda lines, bed: standards.part_age(lines, bed["week_codes"], RUN.mid_quarter), ("mfg_date", "part_age"),
         ("week_codes",), O.part_age, without=("part_age",))
on_lines("cons_cost_final", lambda lines, bed: consumption.second_pass(lines), ("cons_cost", "di_cost", "di_credit"), (), O.second_pass)
on_lines("cons_at_std", lambda lines, bed: consumption.at_standard(lines), ("cons_cost_at_std",), (), O.at_standard)
on_lines("e2e_total", lambda lines, bed: consumption.totals(lines), ("total_inv_costs", "total_matl_cost", "total_matl_inv_cost"), (), O.totals,
         without=("total_matl_cost",))
on_lines("spl_group", lambda lines, bed: consumption.product_line_group(lines, bed["spl_by_region"]), ("part_spl_desc",), ("spl_by_region",),
         O.spl_group)

# ---- pools ---------------------------------------------------------------------------------------------


def pool(name, run, columns, inputs, *steps, without=()) -> None:
    on_lines(name, lambda lines, bed: run(lines, *[bed[n] for n in inputs]), columns, inputs, *steps, without=without)


NPPO = ("nppo_cost",)
pool("variance_alloc", lambda lines, a: pools.variance(lines, a, PERIOD), ("esc_variance",), ("variance_actuals",), O.variance)
plain("scrap_valuation", lambda bed: pools.scrap_valuation(bed["defective_scrap"], bed["regional_cost"], RUN), ("defective_scrap", "regional_cost"),
      f"SELECT region, material, CAST(quantity AS BIGINT) AS quantity, data_period, {num('gross_scrap')}, {num('ctr_release')}, {num('net_scrap')} FROM ({O.VALUED})")
pool("scrap_alloc", lambda lines, s, c: pools.scrap(lines, pools.scrap_valuation(s, c, RUN), PERIOD), ("def_scrap_cost",),
     ("defective_scrap", "regional_cost"), O.scrap)
plain("scrap_audit", lambda bed: pools.scrap_audit(bed["lines"], pools.scrap_valuation(bed["defective_scrap"], bed["regional_cost"], RUN), PERIOD),
      ("lines", "defective_scrap", "regional_cost"), f"""SELECT d.region, d.part_number, d.total AS total_cons_qty, {num('v.net_scrap')},
      {O.rounded('CASE WHEN d.total > 0 THEN v.net_scrap / d.total ELSE 0.0 END')} AS def_scrap_cost
      FROM (SELECT region, part_number, {O.dec('part_qty_consumed')} AS total FROM lines a WHERE {O.SCRAP_BASE} GROUP BY region, part_number) d
      JOIN ({O.VALUED}) v ON d.region = v.region AND d.part_number = v.material AND v.data_period = {O.P}""")
pool("pool_by_supplier", lambda lines, s: pools.charge_by_supplier(lines, s, PERIOD), NPPO, ("supplier_spend",), O.by_supplier)
pool("pooled_suppliers", lambda lines, s: pools.pooled_suppliers(lines, s, PERIOD), NPPO, ("supplier_spend",), O.pooled)
def charge_by_tag(lines: DataFrame, charges: DataFrame) -> DataFrame:
    for region in ("AME", "EMEA"):
        lines = pools.charge_by_tag(lines, charges.filter(F.col("region") == region).drop("region"), region, PERIOD)
    return lines


pool("charge_by_tag", charge_by_tag, NPPO, ("tag_charges",), O.by_tag("AME"), O.by_tag("EMEA"))
pool("semi_join_pool", lambda lines, v: pools.top_vendors(lines, v, PERIOD), NPPO, ("top_vendors",), O.top_vendors)
pool("restricted_pool", lambda lines, v: pools.restricted_vendor(lines, v, PERIOD), NPPO, ("top_vendors",), O.restricted)
pool("per_part_vendor_charge", lambda lines, c: pools.part_charges(lines, c, PERIOD), NPPO, ("part_charges",), O.part_charges)
pool("credit_pool", lambda lines, c: pools.part_charges(lines, c, PERIOD), ("region", "l2_supplier", *NPPO), ("part_charges",), O.part_charges)
pool("three_layer_charge", lambda lines, t, p, a: pools.three_layers(lines, t, p, a, PERIOD), NPPO, ("tag_rates", "part_level", "activity_cost"),
     O.three_layers)
pool("unit_charge_by_country", lambda lines, v: pools.same_day_charge(lines, v, PERIOD), NPPO, ("top_vendors",), O.same_day)
pool("region_inventory", lambda lines, i, c: pools.region_inventory(lines, i, c, PERIOD), ("region", "region_inv_costs"),
     ("region_inventory", "country_region"), O.region_inventory, without=("region_inv_costs",))
pool("split_region_inventory", lambda lines, i, c: pools.region_inventory(lines, i, c, PERIOD), ("region_inv_costs",),
     ("region_inventory", "country_region"), O.region_inventory, without=("region_inv_costs",))
pool("event_line_inventory", lambda lines, i: pools.event_line_inventory(lines, i, PERIOD), ("region_inv_costs",), ("region_inventory",),
     O.event_line_inventory, without=("region_inv_costs",))
pool("country_inventory", lambda lines, s, c: pools.country_inventory(lines, s, c, PERIOD), ("country_inv_costs",),
     ("subregion_inventory", "country_inventory_cost"), O.country_inventory)
pool("tax_alloc", lambda lines, t: pools.taxes(lines, t, PERIOD), ("taxes",), ("country_taxes",), O.taxes, without=("taxes",))
pool("non_event", lambda lines, c: pools.non_event(lines, c, PERIOD), ("non_event_cost",), ("non_event_costs",), O.non_event)

# ---- credits ---------------------------------------------------------------------------------------------

CREDIT = ("credits", "credit_comments")
pool("flag_default", lambda lines, d: credits.dmr_status(lines, d), ("dmr_status",), ("dmr_flags",), O.dmr, without=("dmr_status",))
pool("virtual_credit", lambda lines, r: credits.virtual_credit(lines, r, PERIOD), CREDIT, ("credit_rates",), O.virtual_credit)
pool("priced_credit", lambda lines, p: credits.priced_credit(lines, p, PERIOD), CREDIT, ("price_list",), O.priced_credit)
pool("priced_credit_by_consumed", lambda lines, p: credits.priced_credit(lines, p, PERIOD, True), CREDIT, ("price_list",),
     lambda src: O.priced_credit(src, "part_qty_consumed", ""))
AVERAGE_INPUTS = ("contract_cost", "contract_cost_iw", "named_vendors")


def averages(bed: Bed) -> DataFrame:
    return credits.contract_averages(*[bed[n] for n in AVERAGE_INPUTS], PERIOD)


def credit_rules(name, rules, step) -> None:
    on_lines(name, lambda lines, bed: credits.apply_average_rules(lines, averages(bed), rules()), CREDIT, AVERAGE_INPUTS, step)


def _average_sql() -> str:
    named = {"oow": O.OOW, "nb_named": O.NB_NAMED, "nb_org": O.NB_ORG, "iw": O.IW, "iw_named": O.IW_NAMED, "iw_org": O.IW_ORG}
    rows = " UNION ALL ".join(f"SELECT region, month, part_no, '{k}' AS kind, cost FROM {v} x" for k, v in named.items())
    return f"SELECT region, month, part_no, kind, {num('cost')} FROM ({rows}) WHERE cost IS NOT NULL"


def _average_rows(bed: Bed) -> DataFrame:
    kinds = ("oow", "nb_named", "nb_org", "iw", "iw_named", "iw_org")
    pairs = ", ".join(f"'{k}', {k}_avg" for k in kinds)
    return averages(bed).select("region", "month", "part_no", F.expr(f"stack({len(kinds)}, {pairs}) AS (kind, cost)")).filter("cost IS NOT NULL")


plain("contract_averages", _average_rows, AVERAGE_INPUTS, _average_sql())
credit_rules("contract_credit_fallback", credits.contract_fallback_rules, O.contract_fallback_credit)
credit_rules("age_credit", credits.age_credit_rules, O.age_credit)
credit_rules("other_maker_credit", credits.other_maker_rules, O.other_makers)
credit_rules("all_other_credit", credits.all_other_rules, O.all_others)
credit_rules("forecast_credit_older", credits.forecast_rules, O.forecast_older)
credit_rules("all_other_credit_older", lambda: credits.all_other_rules(False), O.all_others_older)
pool("kitting_fee_older", lambda lines, f: credits.kitting_fee(lines, f, PERIOD, False), CREDIT, ("kitting_fees",), O.kitting_older)
pool("kitting_fee", lambda lines, f: credits.kitting_fee(lines, f, PERIOD), CREDIT, ("kitting_fees",), O.kitting)
CONTRACT_STEPS = (O.contract_fallback_credit, O.age_credit, O.kitting, O.other_makers, O.all_others)
on_lines("contract_credits", lambda lines, bed: credits.contract_credits(lines, averages(bed), bed["kitting_fees"], PERIOD), CREDIT,
         (*AVERAGE_INPUTS, "kitting_fees"), *CONTRACT_STEPS)
pool("orphan_credit", lambda lines, o: credits.orphan_credit(lines, o, PERIOD), CREDIT, ("orphan_receipts",), O.orphan)
on_lines("cid_credit", lambda lines, bed: credits.cid_credit(lines), CREDIT, (), O.cid)

# ---- names in other spellings ----------------------------------------------------------------------------------


def respelled(df: DataFrame, *columns: str, by: str | None = None) -> DataFrame:
    """Names in upper or lower case and with trailing blanks; they still name the same supplier."""
    case = F.pmod(F.xxhash64(by), F.lit(3)) if by else F.lit(1)
    return df.withColumns({c: F.when(case == 0, F.col(c)).when(case == 1, F.concat(F.lower(c), F.lit("  "))).otherwise(F.upper(c)) for c in columns})


# what the charges and the costs behind them read of the lines
CHARGE_READS = (
    KEY, "region", "event_country_iso_cd", "part_number", "part_actual_sl", "part_commodity", "part_qty_consumed", "flow_tag",
    "repair_tag_used", "repair_disposition", "l1_supplier", "l2_supplier", "final_disp_flag", "nppo_cost", "cons_cost", "credits",
    "event_pn_rvs", "physical_pn_rvs", "physical_pn_nbs",
)


def charges_of_any_spelling(lines: DataFrame, bed: Bed) -> DataFrame:
    """All supplier charges, with names spelled otherwise in lines and masters: the amounts are those of the plain names."""
    stored = lines = stage_end(respelled(lines.select(*CHARGE_READS), "l1_supplier", "l2_supplier", by=KEY))
    spend, vendors = respelled(bed["supplier_spend"], "supplier"), respelled(bed["top_vendors"], "vendor")
    lines = pools.pooled_suppliers(pools.charge_by_supplier(lines, spend, PERIOD, stored), spend, PERIOD, stored)
    lines = pools.restricted_vendor(pools.top_vendors(lines, vendors, PERIOD, stored), vendors, PERIOD, stored)
    lines = stage_end(pools.part_charges(lines, bed["part_charges"], PERIOD, stored))  # its shuffle goes before the next
    lines = pools.three_layers(lines, bed["tag_rates"], bed["part_level"], bed["activity_cost"], PERIOD, stored)
    return consumption.second_pass(pools.same_day_charge(lines, vendors, PERIOD, stored))


on_lines("charges_any_spelling", charges_of_any_spelling, ("nppo_cost", "cons_cost"),
         ("supplier_spend", "top_vendors", "part_charges", "tag_rates", "part_level", "activity_cost"),
         O.by_supplier, O.pooled, O.top_vendors, O.restricted, O.part_charges, O.three_layers, O.same_day, O.second_pass)
on_lines("credits_any_spelling", lambda lines, bed: credits.contract_credits(
    respelled(lines, "l2_supplier", "repair_oem_name", by=KEY), averages(bed), bed["kitting_fees"], PERIOD), CREDIT,
    (*AVERAGE_INPUTS, "kitting_fees"), *CONTRACT_STEPS)
on_lines("suppliers_any_spelling", lambda lines, bed: disposition.final_disposition(
    supplier.second_level(respelled(lines, "l1_supplier", by=KEY), respelled(bed["l2_supplier_map"], "l1_supplier", "l2_supplier"), PERIOD),
    bed["tag_flag"], bed["tag_vendor"], bed["code_remap"], respelled(bed["flag_rules"], "supplier"), PERIOD).withColumn(
        "l2_supplier", S.name_key("l2_supplier")), ("final_disp_flag", "supplier_type", "l2_supplier"), ("l2_supplier_map", *FLAG_INPUTS),
    O.second_level, O.final_disposition, lambda src: f"SELECT * REPLACE (lower(rtrim(l2_supplier)) AS l2_supplier) FROM {src}", without=("final_disp_flag",))

# ---- the whole quarter --------------------------------------------------------------------------------------

RUN_OUT = tuple(c for c in ARCHIVE_COLUMNS if c != KEY)
LINK_STEPS = (*LINKED, O.link_returns, O.link_rma, O.pick_hub, O.override)
SUPPLIER_STEPS = (O.empty_suppliers, O.first_assignment, O.contract_fallback, O.override_by_tag, O.second_level, O.last_fallback)
COST_STEPS = (O.standard_costs, O.repair_average, O.first_pass, O.relabel, O.part_age, O.dmr)
CHARGE_STEPS = (O.variance, O.scrap, O.empty_nppo, O.by_supplier, O.pooled, O.by_tag("AME"), O.top_vendors, O.restricted, O.by_tag("EMEA"),
                O.part_charges, O.three_layers)
CREDIT_STEPS = (O.empty_credits, O.virtual_credit, O.priced_credit, *CONTRACT_STEPS, O.orphan, O.cid, O.second_pass, O.at_standard)
OLDER_CREDITS = (O.contract_fallback_credit, O.forecast_older, O.kitting_older, O.all_others_older)
OLDER_CREDIT_STEPS = (O.empty_credits, O.virtual_credit, lambda src: O.priced_credit(src, "part_qty_consumed", ""), *OLDER_CREDITS, O.orphan, O.cid,
                      O.second_pass, O.at_standard)
OLDER_TOTAL_STEPS = (O.same_day, lambda s: f"SELECT *, CAST(NULL AS DOUBLE) AS country_inv_costs FROM {s}", O.country_inventory, O.event_line_inventory,
                     O.taxes, O.totals, O.non_event, O.spl_group)
TOTAL_STEPS = (O.same_day, lambda s: f"SELECT *, CAST(NULL AS DOUBLE) AS country_inv_costs FROM {s}", O.region_inventory, O.taxes, O.totals,
               O.non_event, O.spl_group)


def inputs_of(bed: Bed) -> dict[str, DataFrame]:
    bed.store("sale")
    return {n: bed[n] for n in (*quarter.INPUTS, *quarter.OPTIONAL_INPUTS)}


on_base("full_quarter", lambda bed: quarter.run_quarter(inputs_of(bed), RUN), RUN_OUT, quarter.INPUTS, *LINK_STEPS, *SUPPLIER_STEPS,
        O.final_disposition, *COST_STEPS, *CHARGE_STEPS, *CREDIT_STEPS, *TOTAL_STEPS)


on_base("full_quarter_older", lambda bed: quarter.run_quarter(inputs_of(bed), RUN, R.OLDER), RUN_OUT, (*quarter.INPUTS, *quarter.OPTIONAL_INPUTS),
        *LINK_STEPS, *SUPPLIER_STEPS, O.final_disposition, *COST_STEPS, *CHARGE_STEPS, *OLDER_CREDIT_STEPS, *OLDER_TOTAL_STEPS)


def archive_quarter(bed: Bed) -> DataFrame:
    """A costed quarter archived twice beside an older one that keeps all but text columns as text; both read as one table."""
    history = sources.Published(bed.spark, scratch(bed, "history"), "data_period")
    with Stages(bed.spark) as stages:
        lines = stages.end("costed-lines", lambda: quarter.run_quarter(inputs_of(bed), RUN, stages=stages), instead_of="credited")
        as_text = [f.name for f in lines.schema.fields if not isinstance(f.dataType, T.StringType)]
        archive.archive_period(lines, history, PREVIOUS, as_text)
        archive.archive_period(lines.withColumn("taxes", F.lit(0).cast(S.MONEY)), history, PERIOD)
        archive.archive_period(lines, history, PERIOD)
        history.vacuum(1)  # nobody reads the version that was replaced
    return show(archive.read_history(history), *ARCHIVE_COLUMNS, "data_period")


_QUARTER = QUERIES["full_quarter"].sql
QUERIES["archive_quarter"] = Query(archive_quarter, f"""
WITH run AS ({_QUARTER}) SELECT *, {O.P} AS data_period FROM run UNION ALL SELECT *, '{PREVIOUS}' AS data_period FROM run""")


def flagship(bed: Bed) -> DataFrame:
    """Event base, receipt type and allocated variance, totalled by region and product line."""
    lines = pools.variance(event_base(bed), bed["variance_actuals"], PERIOD)
    return show(lines.groupBy("region", "event_spl", "receipt_type").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("part_qty_consumed").alias("consumed"), S.exact_sum("esc_variance").alias("variance")))


QUERIES["variance_by_product_line"] = Query(flagship, O.statement((*BASE_INPUTS, "variance_actuals"), [
    ("b", O.BASE), ("v", O.variance("b"))], f"""SELECT region, event_spl, receipt_type, COUNT(*) AS line_count,
    CAST(SUM(part_qty_consumed) AS BIGINT) AS consumed, floor(({O.dec('esc_variance')}) * 10000.0e0 + 0.5e0) / 10000.0e0 AS variance FROM v
    GROUP BY region, event_spl, receipt_type"""))

# ---- periods, windows, sources ----------------------------------------------------------------------------------


def scratch(bed: Bed, name: str) -> str:
    return f"{checkpoint_dir(bed.spark)}/{name}-{uuid.uuid4().hex}"


# neighbouring quarters of the mid-run lines; brand and size stand for the part so that keys recur
HISTORY_SQL = """SELECT * REPLACE (event_spl || '-' || COALESCE(part_spl, '') AS part_number,
  CASE WHEN substr(data_period, 6) IN ('1', '3') THEN '1997Q1' ELSE '1996Q4' END AS data_period) FROM lines"""


def history(bed: Bed) -> DataFrame:
    return bed["lines"].withColumns({
        "part_number": F.concat("event_spl", F.lit("-"), F.coalesce("part_spl", F.lit(""))),
        "data_period": F.when(F.substring("data_period", 6, 1).isin("1", "3"), F.lit(PERIOD)).otherwise(F.lit(PREVIOUS)),
    })


HISTORY = (KEY, "region", "part_number", "part_qty_consumed", "total_matl_cost")


def archive_period(bed: Bed) -> DataFrame:
    """All lines in two quarters: write both, replace one by corrected lines, and read the table back."""
    path = scratch(bed, "archive")
    lines = history(bed).select(*HISTORY, "data_period")
    for period, factor in ((PREVIOUS, 1), (PERIOD, 1), (PERIOD, 2)):
        rows = lines.filter(F.col("data_period") == period).withColumn("total_matl_cost", F.col("total_matl_cost") * factor)
        sources.overwrite_period(rows, path, period)
    return bed.spark.read.schema(lines.schema).parquet(path)


plain("archive_period", archive_period, ("lines",), f"""SELECT unique_link_key, region, part_number, CAST(part_qty_consumed AS BIGINT) AS part_qty_consumed,
floor((total_matl_cost * CASE WHEN data_period = {O.P} THEN 2 ELSE 1 END) * 10000.0e0 + 0.5e0) / 10000.0e0 AS total_matl_cost, data_period FROM history""",
      [("history", HISTORY_SQL)])


def recreated(bed: Bed) -> DataFrame:
    """A table dropped and made anew with other columns; who read the old one still does."""
    table = sources.Published(bed.spark, scratch(bed, "recreated"))
    sources.full_refresh(bed["repairs"].select("repair_id", "flow_tag", "value"), table)
    old = table.read()
    table.drop()
    sources.full_refresh(old.join(bed["repairs"].select("repair_id", "record_status"), "repair_id").drop("value"), table)
    return table.read()


plain("drop_recreate", recreated, ("repairs",), "SELECT repair_id, flow_tag, record_status FROM repairs")


def refreshed(bed: Bed) -> DataFrame:
    """A full refresh that reads its own target: values of valid repairs are doubled twice."""
    table = sources.Published(bed.spark, scratch(bed, "refreshed"))
    sources.full_refresh(bed["repairs"].select("repair_id", "record_status", "value"), table)
    for _ in range(2):
        doubled = F.when(F.col("record_status") == "Valid", F.col("value") * 2).otherwise(F.col("value"))
        sources.full_refresh(table.read().withColumn("value", doubled), table)
    return table.read()


plain("refresh_own_target", refreshed, ("repairs",), f"""SELECT repair_id, record_status,
{O.rounded("CASE WHEN record_status = 'Valid' THEN value * 4 ELSE value END")} AS value FROM repairs""")


def landed(bed: Bed) -> DataFrame:
    """Returns land in two hops: the first landing lacks a month in the middle and some late rows, the second has all."""
    zone, target = (sources.Published(bed.spark, scratch(bed, n), "received_month") for n in ("landing", "filtered"))
    rows = base.return_columns(bed["returns"]).select(KEY, "received_month", "flow_tag", "receipt_type")
    late = (F.col("received_month") == "199703") | ((F.col("received_month") == "199605") & F.col(KEY).endswith("7"))
    sources.land(rows.filter(~late), zone)
    sources.advance(zone, target, "199511")
    sources.land(rows, zone)
    again = [sources.advance(zone, target, "199511") for _ in range(2)]
    if again != [["199605", "199703"], []]:
        raise ValueError(f"months taken: {again}")
    return target.read()


plain("landing_filtered", landed, ("returns",), f"""SELECT * FROM (SELECT unique_link_key, {O.b_over_a('received_month')} AS received_month,
{O.b_over_a('flow_tag_number')} AS flow_tag, {O.RECEIPT} AS receipt_type FROM returns r) WHERE received_month >= '199511'""")


def stamped(bed: Bed) -> DataFrame:
    """A period column added to all lines, then set where a load left it empty."""
    rows = bed["lines"].select(KEY, "region")
    first = sources.stamp_period(rows, PREVIOUS).withColumn("data_period", F.when(F.col("region") != "APJ", F.col("data_period")))
    return sources.stamp_period(first, PERIOD)


plain("stamp_period", stamped, ("lines",), f"""SELECT unique_link_key, region, CASE WHEN region <> 'APJ' THEN '{PREVIOUS}' ELSE {O.P} END AS data_period FROM lines""")


def rolling_reload(bed: Bed) -> DataFrame:
    """The last full week before a day is taken anew from the source; the rest stays as it was."""
    first, last = S.last_full_week("2024-01-18")
    existing = bed["repairs"].withColumn("value", F.lit(0.0))
    incoming = bed["repairs"].unionByName(bed["repairs"]).filter("record_status <> 'Invalid'")
    return sources.replace_window(existing, incoming, "upload_date", first, last).select("repair_id", "upload_date", "value")


plain("rolling_reload", rolling_reload, ("repairs",), """SELECT repair_id, upload_date, floor((CASE WHEN inside THEN value ELSE 0.0 END) * 10000.0e0 + 0.5e0) / 10000.0e0 AS value
FROM (SELECT *, CAST(upload_date AS DATE) BETWEEN DATE '2024-01-06' AND DATE '2024-01-12' AS inside FROM repairs)
WHERE NOT inside OR record_status <> 'Invalid'""")


def reload_days(bed: Bed) -> DataFrame:
    """The same through a table published by day: all days of the window in one commit, one of them empty."""
    table = sources.Published(bed.spark, scratch(bed, "repairs"), "day")
    rows = bed["repairs"].select("repair_id", "upload_date", "value")
    sources.full_refresh(rows.withColumn("value", F.lit(0.0)).withColumn("day", F.to_date("upload_date").cast("string")), table)
    incoming = rows.filter(F.to_date("upload_date") != F.lit("2024-01-08").cast("date"))
    sources.reload_window(incoming.unionByName(incoming), table, "upload_date", "2024-01-06", "2024-01-12")
    return table.read().drop("day")


plain("reload_days", reload_days, ("repairs",), """SELECT repair_id, upload_date, floor((CASE WHEN CAST(upload_date AS DATE) BETWEEN DATE '2024-01-06'
AND DATE '2024-01-12' THEN value ELSE 0.0 END) * 10000.0e0 + 0.5e0) / 10000.0e0 AS value FROM repairs WHERE CAST(upload_date AS DATE) <> DATE '2024-01-08'""")


def union_months(bed: Bed) -> DataFrame:
    """One table per month, as another system leaves them, beside one with another name; all read as one."""
    path = scratch(bed, "months")
    # the names of month tables begin with 20, the benchmark's months with 19
    cost = bed["contract_cost"].select("region", "part_no", "vendor_no", "contract_cost", (F.col("month").cast("int") + 1000).cast("string").alias("month"))
    cost.withColumn("m", F.col("month")).drop("month").hint("rebalance", F.col("m")).write.partitionBy("m").parquet(path)
    folder, jvm = sources.Folder(bed.spark, path), bed.spark.sparkContext._jvm
    for name in folder.names():
        if name.startswith("m="):
            folder._fs().rename(folder._at(name), jvm.org.apache.hadoop.fs.Path(f"{path}/COST_{name[2:]}.parquet"))
    cost.drop("month").limit(5).write.parquet(f"{path}/COST_OLD.parquet")
    return sources.recode_regions(sources.read_months(bed.spark, path, "COST"))


plain("union_months", union_months, ("contract_cost",), f"SELECT region, part_no, vendor_no, {num('contract_cost')}, CAST(CAST(month AS INT) + 1000 AS VARCHAR) AS month FROM contract_cost")


def strict_load(bed: Bed) -> DataFrame:
    raw = sources.column_map(bed["lineitem"], {"l_orderkey": "order_number", "l_quantity": "quantity", "l_shipdate": "shipped", "l_returnflag": "flag"})
    raw = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    schema = T.StructType([T.StructField("order_number", T.LongType()), T.StructField("quantity", T.DoubleType()),
                           T.StructField("shipped", T.TimestampType()), T.StructField("flag", T.StringType())])
    return sources.strict_load(raw, schema, {"flag": 1})


plain("strict_load", strict_load, (), f"SELECT l_orderkey AS order_number, {num('l_quantity').replace('AS l_quantity', 'AS quantity')}, l_shipdate AS shipped, l_returnflag AS flag FROM lineitem")
plain("append_years", lambda bed: sources.append_tables(bed["rma"].filter("year(container_release) < 1997"), bed["rma"].filter("year(container_release) >= 1997"))
      .select("flow_tag", "part_number", "vendor_code", "container_release"), ("rma",),
      "SELECT flow_tag, part_number, vendor_code, container_release FROM rma WHERE container_release IS NOT NULL")


def history_backfill(bed: Bed) -> DataFrame:
    history = bed["lines"].select(KEY, "region", F.lit(None).cast("string").alias("so_item"), "dmr_status")
    staging = bed["service_events"].select(KEY, "so_item")
    return sources.backfill(history, staging, KEY, ["so_item"])


plain("history_backfill", history_backfill, ("lines", "service_events"), """SELECT l.unique_link_key, l.region, e.so_item, l.dmr_status FROM lines l
LEFT JOIN service_events e ON l.unique_link_key = e.unique_link_key""")
plain("adjustment_feed", lambda bed: base.adjustment_feed(bed["service_events"]), ("service_events",), "SELECT unique_link_key, amid2_adj FROM service_events")
plain("doc_type_filter", lambda bed: base.shipment_lines(bed["shipments"], bed["service_events"], RUN), ("shipments", "service_events"), f"""
SELECT s.unique_link_key, s.so_po_document_type, CAST(s.shipped_qty AS BIGINT) AS shipped_qty, e.part_actual_sl FROM shipments s JOIN service_events e
ON s.unique_link_key = e.unique_link_key WHERE e.master_event_activity_month BETWEEN '199501' AND '200112' AND s.so_po_document_type IN
({', '.join(repr(t) for t in R.SHIPMENT_DOCUMENT_TYPES)})""")
plain("prev_quarter", lambda bed: bed["orders"].select("o_orderkey", S.fiscal_period("o_orderdate").alias("period")).withColumn(
    "previous", S.previous_period_col("period")).withColumn("next_month", S.add_to_month(F.concat(F.substring("period", 1, 4), F.lit("11")), 2)), (), """
SELECT o_orderkey, y || 'Q' || q AS period, CASE WHEN q = 1 THEN (y - 1) || 'Q4' ELSE y || 'Q' || (q - 1) END AS previous, (y + 1) || '01' AS next_month
FROM (SELECT o_orderkey, year(o_orderdate) + CASE WHEN month(o_orderdate) >= 11 THEN 1 ELSE 0 END AS y,
CASE WHEN month(o_orderdate) IN (11, 12, 1) THEN 1 WHEN month(o_orderdate) < 5 THEN 2 WHEN month(o_orderdate) < 8 THEN 3 ELSE 4 END AS q FROM orders)""")

# ---- inventory model --------------------------------------------------------------------------------------------------

SCOPE = "source <> 'DWIA LOTS' AND country <> 'China'"
L2 = "CASE WHEN region = 'APJ' THEN 'APJeC' WHEN region = 'EMEA' THEN 'EMEA' WHEN country IN ('Canada','United States') THEN 'NA' ELSE 'LA' END"
SNAPSHOT = f"""SELECT region, support_product_line, subregion, {L2} AS region_l2, type, country, plant, location, condition,
CASE WHEN substr(location, 1, 2) IN ('FG','CU','DS','RF','OR') OR (location = '#' AND condition = 'Good') THEN 'Event' ELSE 'Non Event' END AS inv_type,
{O.dec('value_current')} AS value_current, {O.dec('reserve_current')} AS reserve_start, plant || location AS mrp_area,
substr(location, 1, 2) AS location_type, substr(location, 1, 2) || '-' || condition AS location_type_condition
FROM stock_start WHERE {SCOPE} GROUP BY region, support_product_line, subregion, type, country, plant, location, condition"""
GROUPS = f"SELECT support_product_line, {L2} AS region_l2, {O.dec('value_current')} AS group_value FROM stock_start WHERE {SCOPE} GROUP BY 1, 2"
RESERVES = f"""SELECT plant || location AS mrp_area, support_product_line, condition, {O.dec('reserve_current')} AS reserve_end FROM stock_end
WHERE {SCOPE} GROUP BY 1, 2, 3"""
KEYED = """SELECT s.*, r.reserve_end, k.special_alloc_key, COALESCE(k.special_alloc_key, s.subregion || '-' || s.type) AS allocation_key FROM snap s
LEFT JOIN reserves r ON s.mrp_area = r.mrp_area AND s.support_product_line = r.support_product_line AND s.condition = r.condition
LEFT JOIN special_keys k ON s.mrp_area = k.inv_plant_location"""
REVALUED = """SELECT k.*, g.group_value, CASE WHEN g.group_value <> 0 THEN k.value_current / g.group_value WHEN g.group_value = 0 THEN 0.0 END AS std_rev_share,
c.adj_cube AS cube_std_rev FROM keyed k LEFT JOIN group_values g ON k.support_product_line = g.support_product_line AND k.region_l2 = g.region_l2
LEFT JOIN cube_cost c ON c.type = 'Std Rev Costs' AND c.region_l2 = k.region_l2 AND c.spl = k.support_product_line"""
TRUED = f"""SELECT v.* EXCLUDE (true_up), v.true_up, t.group_true_up, CASE WHEN t.group_true_up <> 0 THEN v.true_up / t.group_true_up WHEN t.group_true_up = 0 THEN 0.0 END
AS true_up_share, c.adj_cube AS cube_reserve FROM (SELECT *, reserve_start - COALESCE(reserve_end, 0) AS true_up FROM revalued) v
LEFT JOIN (SELECT support_product_line, region_l2, {O.dec('reserve_start - COALESCE(reserve_end, 0)')} AS group_true_up FROM revalued GROUP BY 1, 2) t
ON v.support_product_line = t.support_product_line AND v.region_l2 = t.region_l2
LEFT JOIN cube_cost c ON c.type = 'E&O Costs' AND c.region_l2 = v.region_l2 AND c.spl = v.support_product_line"""
INVENTORY = [("snap", SNAPSHOT), ("group_values", GROUPS), ("reserves", RESERVES), ("keyed", KEYED), ("revalued", REVALUED), ("trued", TRUED)]
STOCK = ("stock_start", "stock_end", "special_keys", "cube_cost")
PLACE = ("mrp_area", "support_product_line", "condition", "region", "country", "subregion", "type")


def inventory_model(bed: Bed) -> DataFrame:
    return inventory.inventory_model(*[bed[n] for n in STOCK])


plain("inv_snapshot", lambda bed: inventory.snapshot(bed["stock_start"]), ("stock_start",),
      f"SELECT * REPLACE (floor((value_current) * 10000.0e0 + 0.5e0) / 10000.0e0 AS value_current, floor((reserve_start) * 10000.0e0 + 0.5e0) / 10000.0e0 AS reserve_start) FROM ({SNAPSHOT})")
plain("inv_group_value", lambda bed: inventory.group_value(bed["stock_start"]), ("stock_start",),
      f"SELECT * REPLACE (floor((group_value) * 10000.0e0 + 0.5e0) / 10000.0e0 AS group_value) FROM ({GROUPS})")
plain("inv_end_reserve", lambda bed: inventory.end_reserve(bed["stock_end"]), ("stock_end",),
      f"SELECT * REPLACE (floor((reserve_end) * 10000.0e0 + 0.5e0) / 10000.0e0 AS reserve_end) FROM ({RESERVES})")
plain("inv_alloc_key", lambda bed: inventory.allocation_key(inventory.snapshot(bed["stock_start"]), inventory.end_reserve(bed["stock_end"]), bed["special_keys"])
      .select(*PLACE, "reserve_end", "special_alloc_key", "allocation_key"), STOCK,
      f"SELECT {', '.join(PLACE)}, {num('reserve_end')}, special_alloc_key, allocation_key FROM keyed", INVENTORY)
plain("inv_reval_alloc", lambda bed: inventory_model(bed).select(*PLACE, "group_value", "std_rev_share", "cube_std_rev", "std_rev_usd"), STOCK,
      f"""SELECT {', '.join(PLACE)}, {num('group_value')}, {num('std_rev_share')}, {num('cube_std_rev')},
      floor((std_rev_share * cube_std_rev) * 10000.0e0 + 0.5e0) / 10000.0e0 AS std_rev_usd FROM trued""", INVENTORY)
plain("inv_trueup_alloc", lambda bed: inventory_model(bed).select(*PLACE, "true_up", "group_true_up", "true_up_share", "cube_reserve", "true_up_usd"), STOCK,
      f"""SELECT {', '.join(PLACE)}, {num('true_up')}, {num('group_true_up')}, {num('true_up_share')}, {num('cube_reserve')},
      floor((true_up_share * cube_reserve) * 10000.0e0 + 0.5e0) / 10000.0e0 AS true_up_usd FROM trued""", INVENTORY)

# ---- interim costing ---------------------------------------------------------------------------------------------------

IKEYS = ("region", "part_number", "warranty_flag", "dmr_status")
COMPONENTS = ("cons_cost", "nppo_cost", "relabel_cost", "dekit_cost", "taxes")
def _option_sql(number: int, keys: tuple[str, ...], components: bool = True, guard: bool = True) -> str:
    scope = "part_qty_consumed > 0" if number == 0 else "part_qty_consumed = 0 AND part_qty_demanded > 0"
    qty = "part_qty_consumed" if number == 0 else "part_qty_demanded"
    label = ("Option 1 - PART CONS", "Option 1 - DEMAND BUT NO CONS")[number]

    def mean(c, q):
        cost = f"COALESCE(CAST({c} AS DOUBLE), 0.0)" if guard else f"CAST({c} AS DOUBLE)"
        return f"{O.dec(f'COALESCE({q}, 0) * {cost}')} / COUNT(*)"

    parts = {f"interim_{c}": mean(c, "part_qty_consumed") for c in COMPONENTS} if components else {}
    parts["interim_total"] = mean("total_matl_cost", qty)
    values = ", ".join(f"{v} AS {k}" for k, v in parts.items())
    return (f"SELECT h.unique_link_key, {', '.join('h.' + k for k in keys)}, {', '.join('m.' + k for k in parts)}, '{label}' AS interim_option "
            f"FROM history h JOIN (SELECT {', '.join(keys)}, {values} FROM history WHERE data_period = '{PREVIOUS}' AND {scope} GROUP BY {', '.join(keys)}) m "
            f"ON {' AND '.join(f'h.{k} = m.{k}' for k in keys)} WHERE h.data_period = {O.P} AND {scope.replace('part_', 'h.part_')}")


def _two_sql(keys, adder: bool = True) -> str:
    done = "SELECT unique_link_key FROM one UNION ALL SELECT unique_link_key FROM two"
    if not adder:
        total = "h.part_qty_consumed * h.event_pn_nrs"
        join = ""
    else:
        total = (f"COALESCE(h.part_qty_consumed, 0.0) * COALESCE(h.event_pn_nrs, 0.0) + COALESCE(h.part_qty_consumed, 0.0) * CASE WHEN NOT {O.blank('h.event_spl')} "
                 f"AND NOT {O.blank('b.event_spl')} THEN COALESCE(b.non_nrs_rate, 0.0) ELSE x.non_nrs_rate END")
        join = (f"LEFT JOIN cost_adders b ON h.event_spl = b.event_spl AND h.region = b.region AND h.data_period = b.data_period LEFT JOIN "
                f"(SELECT DISTINCT region, non_nrs_rate FROM cost_adders WHERE event_spl = 'All Others' AND data_period = '{PREVIOUS}') x ON x.region = h.region")
    return (f"SELECT h.unique_link_key, {', '.join('h.' + k for k in keys)}, {total} AS interim_total, 'Option 2' AS interim_option FROM history h {join} "
            f"WHERE h.data_period = {O.P} AND h.unique_link_key NOT IN ({done})")


def _interim_parts(keys, components=True, guard=True, adder=True):
    return [("history", HISTORY_SQL), ("one", _option_sql(0, keys, components, guard)), ("two", _option_sql(1, keys, components, guard)), ("three", _two_sql(keys, adder))]


def _interim_select(keys, components=True) -> str:
    amounts = [*[f"interim_{c}" for c in COMPONENTS if components], "interim_total"]
    money = ", ".join(f"floor(CAST({O.money(c)} AS DOUBLE) * 10000.0e0 + 0.5e0) / 10000.0e0 AS {c}" for c in amounts)
    nulls = [c for c in amounts if c != "interim_total"]
    three = f"SELECT unique_link_key, {', '.join(keys)}, {''.join(f'CAST(NULL AS DOUBLE) AS {c}, ' for c in nulls)}interim_total, interim_option FROM three"
    return (f"SELECT unique_link_key, {', '.join(keys)}, {money}, interim_option, CAST(NULL AS DOUBLE) AS interim_non_event_cost, '{PREVIOUS}-{PERIOD}' AS interim_period, "
            f"floor(CAST({O.money('COALESCE(interim_total, 0.0)')} AS DOUBLE) * 10000.0e0 + 0.5e0) / 10000.0e0 AS interim_total_non_event "
            f"FROM (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL {three})")


def _option(number: int) -> Callable[[Bed], DataFrame]:
    def run(bed: Bed) -> DataFrame:
        rows = history(bed)
        return interim.option_one(rows.filter(F.col("data_period") == PERIOD), rows.filter(F.col("data_period") == PREVIOUS), number).select(
            KEY, *IKEYS, *[f"interim_{c}" for c in COMPONENTS], "interim_total", "interim_option")
    return run


def _option_two(bed: Bed) -> DataFrame:
    return interim.interim_costs(history(bed), bed["cost_adders"], PERIOD).filter("interim_option = 'Option 2'").select(
        KEY, *IKEYS, "interim_total", "interim_option")


def _round_all(sql: str) -> str:
    amounts = [*[f"interim_{c}" for c in COMPONENTS], "interim_total"]
    return f"SELECT * REPLACE ({', '.join(f'floor(({c}) * 10000.0e0 + 0.5e0) / 10000.0e0 AS {c}' for c in amounts)}) FROM ({sql})"


plain("interim_consumed", _option(0), ("lines",), _round_all("SELECT * FROM one"), [("history", HISTORY_SQL), ("one", _option_sql(0, IKEYS))])
plain("interim_demand_only", _option(1), ("lines",), _round_all("SELECT * FROM two"), [("history", HISTORY_SQL), ("two", _option_sql(1, IKEYS))])
plain("interim_option2", _option_two, ("lines", "cost_adders"),
      f"SELECT unique_link_key, {', '.join(IKEYS)}, floor((interim_total) * 10000.0e0 + 0.5e0) / 10000.0e0 AS interim_total, interim_option FROM three", _interim_parts(IKEYS))
plain("interim_total", lambda bed: interim.interim_costs(history(bed), bed["cost_adders"], PERIOD), ("lines", "cost_adders"), _interim_select(IKEYS), _interim_parts(IKEYS))
plain("interim_without_dmr", lambda bed: interim.interim_costs(history(bed), bed["cost_adders"], PERIOD, keys=IKEYS[:3]), ("lines", "cost_adders"),
      _interim_select(IKEYS[:3]), _interim_parts(IKEYS[:3]))
plain("interim_first_version", lambda bed: interim.interim_costs(history(bed), None, PERIOD, components=False, null_as_zero=False), ("lines",),
      _interim_select(IKEYS, False), _interim_parts(IKEYS, False, False, False))

def interim_label(bed: Bed) -> DataFrame:
    """A label replaced twice in a table that also holds another label, both quarters being read from a published history."""
    quarters = sources.Published(bed.spark, scratch(bed, "quarters"), "data_period")
    table = sources.Published(bed.spark, scratch(bed, "interim"), "interim_period")
    quarters.refresh(history(bed).select(*interim.READS), spread=False)  # two quarters
    older = interim.interim_costs(history(bed), None, PERIOD, components=True).withColumn("interim_total", F.lit(1).cast(S.MONEY))
    both = [older.withColumn("interim_period", F.lit(label)) for label in ("1996Q3-1996Q4", interim.interim_label(PERIOD))]
    table.refresh(both[0].unionByName(both[1].filter("interim_option = 'Option 2'")), spread=False)
    for _ in range(2):
        interim.publish_interim(quarters.read(), bed["cost_adders"], PERIOD, table)
    return table.read().groupBy("interim_period", "interim_option", "region").agg(
        F.count(F.lit(1)).alias("line_count"), S.exact_sum("interim_total").alias("interim_total"), S.exact_sum("interim_total_non_event").alias("non_event"))


_ROLLED = _interim_select(IKEYS)
plain("interim_label", interim_label, ("lines", "cost_adders"), f"""SELECT interim_period, interim_option, region, COUNT(*) AS line_count,
{O.rounded(O.dec('interim_total'))} AS interim_total, {O.rounded(O.dec('interim_total_non_event'))} AS non_event
FROM (SELECT interim_period, interim_option, region, interim_total, interim_total_non_event FROM rolled UNION ALL
SELECT '1996Q3-1996Q4', interim_option, region, 1.0, interim_total_non_event FROM older) GROUP BY ALL""",
      [*_interim_parts(IKEYS), ("rolled", _ROLLED), ("three_plain", _two_sql(IKEYS, False)),
       ("older", _ROLLED.replace("FROM three)", "FROM three_plain)"))])

# ---- checks ----------------------------------------------------------------------------------------------------------

CHECK = f"""SELECT e.region, e.master_event_activity_month AS month, h.spl AS event_spl, CAST(SUM(e.part_qty_consumed) AS BIGINT) AS cons_qty,
'Q' || CASE WHEN m IN (11, 12, 1) THEN '1' WHEN m < 5 THEN '2' WHEN m < 8 THEN '3' ELSE '4' END ||
substr(CAST(y + CASE WHEN m >= 11 THEN 1 ELSE 0 END AS VARCHAR), 3, 2) AS qtr
FROM (SELECT *, CAST(substr(master_event_activity_month, 1, 4) AS INT) AS y, CAST(substr(master_event_activity_month, 5, 2) AS INT) AS m FROM service_events) e
LEFT JOIN product_lines h ON e.event_hwpl = h.hwpl WHERE e.master_event_activity_month >= '199511' AND {O.SCOPE}
GROUP BY e.region, e.master_event_activity_month, h.spl, m, y"""
plain("fiscal_quarter_check", lambda bed: checks.consumption_check(bed["service_events"], bed["product_lines"], "199511")
      .select("region", "month", "event_spl", "cons_qty", "qtr"), ("service_events", "product_lines"), CHECK)
plain("reconcile", lambda bed: checks.reconcile(checks.consumption_check(bed["service_events"], bed["product_lines"], "199511"), bed["accounting_named"], bed["month_names"]),
      ("service_events", "product_lines", "accounting_named", "month_names"), f"""SELECT c.*, a.spl AS spl_in_accounting, a.cons_qty AS cons_qty_in_accounting
      FROM ({CHECK}) c LEFT JOIN (SELECT n.region, m.month_transformed AS month, n.spl, n.cons_qty FROM accounting_named n JOIN month_names m ON n.month = m.column_name) a
      ON c.region = a.region AND c.month = a.month AND c.event_spl = a.spl""")
plain("duplicate_tags", lambda bed: checks.duplicate_tags(event_base(bed), bed["repairs"], RUN), (*BASE_INPUTS, "repairs"),
      """SELECT region, COUNT(*) AS duplicate_records FROM linked WHERE repair_flow_tag IN (SELECT repair_flow_tag FROM linked GROUP BY repair_flow_tag
      HAVING COUNT(repair_flow_tag) > 1) GROUP BY region""", [("b", O.BASE), ("linked", O.repair_link("b"))])
EVENT_CHECK = f"""SELECT e.*, h.spl AS event_spl, p.part_commodity, p.material_description AS part_description, c.event_spl AS sc_spl
FROM service_events e LEFT JOIN part_master p ON e.part_number = p.material AND e.region = p.region LEFT JOIN product_lines h ON e.event_hwpl = h.hwpl
LEFT JOIN activity c ON e.unique_link_key = c.unique_link_key AND e.source_system IN ('SFDC','WFM-IM','CSN') AND e.region <> 'China' AND NOT e.part_qty_demanded = 0"""
CHECK_OUT = (KEY, "region", "source_system", "event_spl", "part_commodity", "part_description", "sc_spl")
CHECK_INPUTS = ("service_events", "part_master", "product_lines", "activity")
plain("event_check", lambda bed: checks.event_check(*[bed[n] for n in CHECK_INPUTS]).select(*CHECK_OUT), CHECK_INPUTS,
      f"SELECT {', '.join(CHECK_OUT)} FROM ({EVENT_CHECK})")
plain("event_check_filtered", lambda bed: checks.event_check(*[bed[n] for n in CHECK_INPUTS], month_range=("199501", "200112")).select(*CHECK_OUT), CHECK_INPUTS,
      f"""SELECT {', '.join(CHECK_OUT)} FROM ({EVENT_CHECK}) WHERE master_event_activity_month BETWEEN '199501' AND '200112'
      AND source_system IN ('SFDC','WFM-IM','CSN') AND region <> 'China' AND NOT part_qty_demanded = 0""")
plain("event_preview", lambda bed: checks.event_preview(checks.event_check(*[bed[n] for n in CHECK_INPUTS]).select(*CHECK_OUT)), CHECK_INPUTS,
      f"SELECT {', '.join(CHECK_OUT)} FROM ({EVENT_CHECK}) ORDER BY unique_link_key LIMIT 10")
plain("not_in_null_safe", lambda bed: checks.not_in(bed["lines"].select(KEY, "l1_supplier"), "l1_supplier", bed["l2_supplier_map"], "l1_supplier"),
      ("lines", "l2_supplier_map"), "SELECT unique_link_key, l1_supplier FROM lines WHERE l1_supplier NOT IN (SELECT l1_supplier FROM l2_supplier_map WHERE l1_supplier IS NOT NULL)")
plain("latest_event_per_user", lambda bed: latest_per_key(bed["events"], ["user_id"], ["ts"], ["event_id"]).select("user_id", "event_id", "ts", "event_type", "value"), (),
      f"""SELECT user_id, event_id, ts, event_type, {num('value')} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events)
      WHERE rn = 1""")
plain("merge_update_null", lambda bed: merge_update(bed["lines"].select(KEY, "flow_tag", "repair_vendor"), bed["patches_ame"].select("flow_tag", "repair_disposition"),
      ["flow_tag"], {"repair_vendor": "repair_disposition"}, unmatched="null"), ("lines", "patches_ame"),
      """SELECT l.unique_link_key, l.flow_tag, p.repair_disposition AS repair_vendor FROM lines l LEFT JOIN patches_ame p ON l.flow_tag = p.flow_tag""")
