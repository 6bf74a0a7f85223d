"""The quarterly run: link, classify, cost, allocate, total."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecost import rules as R
from sparecost.operators import with_rest_packed
from sparecost.plans import consumption, credits, pools, standards
from sparecost.plans.base import event_base
from sparecost.plans.disposition import final_disposition
from sparecost.plans.link import KEY, TAG_KEY, link
from sparecost.plans.supplier import assign_suppliers
from sparecost.session import Stages

INPUTS = (
    "service_events", "part_master", "product_lines", "returns", "activity", "repairs", "dc_returns", "rma",
    "patches_ame", "patches_ame_b", "patches_emea", "patches_emea_b", "plant_supplier", "disposition_supplier", "contract_vendor", "new_buy_vendor",
    "tag_vendor", "tag_supplier", "l2_supplier_map", "tag_flag", "code_remap", "flag_rules", "regional_cost",
    "sap_cost", "cost_adjustment", "service_standard", "repair_average", "variance_actuals", "defective_scrap",
    "supplier_spend", "tag_charges", "top_vendors", "part_charges", "tag_rates", "part_level", "activity_cost",
    "week_codes", "dmr_flags", "credit_rates", "price_list", "contract_cost", "contract_cost_iw", "named_vendors",
    "kitting_fees", "orphan_receipts", "region_inventory", "country_region", "country_taxes", "non_event_costs",
    "spl_by_region",
)
# needed by options only: rules.Options says which
OPTIONAL_INPUTS = ("rfc_suppliers", "subregion_inventory", "country_inventory_cost")
# what each step reads or sets of the columns that it is given; the rest passes through it as one value
USED = {
    "linked": (
        KEY, TAG_KEY,
        "flow_tag", "phy_part_no_rec_date", "received_part_kit_part_number", "physical_part_number", "region",
        "received_plant",
    ),
    "classified": (
        KEY, TAG_KEY,
        "region", "rma_vendor_name", "repair_vendor", "dcr_vendor_name", "received_plant", "dcr_disposition",
        "actual_disposition", "received_part_kit_part_number", "part_number", "flow_tag", "physical_part_number",
        "repair_disposition", "repair_warranty_status", "hub_disposition", "receipt_type", "rma_engineer_approval",
    ),
    "costed": (
        KEY, TAG_KEY,
        "received_part_kit_part_number", "physical_part_number", "region", "received_month", "part_number",
        "final_disp_flag", "part_qty_consumed", "ct_code_label", "receipt_type", "l2_supplier", "repair_oem_name", "so_item",
    ),
    "charged": (
        KEY, TAG_KEY,
        "region", "event_spl", "part_qty_consumed", "event_country_iso_cd", "part_number", "repair_tag_used",
        "final_disp_flag", "l2_supplier", "part_commodity", "flow_tag", "repair_disposition",
    ),
    "credited": (
        KEY, TAG_KEY,
        "region", "part_commodity", "part_qty_consumed", "event_pn_rvs", "dmr_status", "receipt_type",
        "received_part_kit_part_number", "l2_supplier", "final_disp_flag", "part_qty_received", "physical_part_number",
        "received_month", "repair_oem_name", "part_age", "master_event_activity_month", "event_country_iso_cd", "rma_cid",
        "rma_credit", "physical_pn_rvs", "physical_pn_nbs", "event_pn_nrs", "cons_cost", "ct_code_label",
    ),
    "totalled": (
        KEY, TAG_KEY,
        "l1_supplier", "part_qty_consumed", "event_country_iso_cd", "part_actual_sl", "region", "repair_tag_used",
        "part_qty_demanded", "part_spl", "event_pn_rvs", "cons_cost", "relabel_cost", "dekit_cost", "nppo_cost", "event_spl",
    ),
}

Cut = Callable[[DataFrame], DataFrame]


def _whole(lines: DataFrame) -> DataFrame:
    """No cut."""
    return lines


def based(inputs: dict[str, DataFrame], period: R.Period) -> DataFrame:
    return event_base(
        inputs["service_events"], inputs["part_master"], inputs["product_lines"], inputs["returns"],
        inputs["activity"], period,
    )


def linked(lines: DataFrame, inputs: dict[str, DataFrame], period: R.Period) -> DataFrame:
    """Needs stored lines: the line that keeps a tag's repair is found in them first."""
    patches = {"AME": [inputs["patches_ame"], inputs["patches_ame_b"]], "EMEA": [inputs["patches_emea"], inputs["patches_emea_b"]]}
    return link(lines, inputs["repairs"], inputs["dc_returns"], inputs["rma"], patches, period)


def classified(lines: DataFrame, inputs: dict[str, DataFrame], period: R.Period, options: R.Options, cut: Cut = _whole) -> DataFrame:
    lines = assign_suppliers(lines, inputs, period.period, options.strict, cut)
    return final_disposition(
        cut(lines), inputs["tag_flag"], inputs["tag_vendor"], inputs["code_remap"], inputs["flag_rules"], period.period
    )


def costed(lines: DataFrame, inputs: dict[str, DataFrame], period: R.Period, cut: Cut = _whole) -> DataFrame:
    """Everything that is read per line by part, month or tag."""
    p = period.period
    lines = standards.standard_costs(
        lines, inputs["regional_cost"], inputs["sap_cost"], inputs["cost_adjustment"], inputs["service_standard"], period, cut
    )
    lines = standards.link_repair_average(lines, inputs["repair_average"], p)
    lines = consumption.first_pass(lines, inputs["service_standard"])
    lines = consumption.relabel_and_dekit(lines)
    lines = standards.part_age(lines, inputs["week_codes"], period.mid_quarter)
    return credits.dmr_status(cut(lines), inputs["dmr_flags"])


def charged(lines: DataFrame, inputs: dict[str, DataFrame], period: R.Period, cut: Cut = _whole) -> DataFrame:
    """Variance, scrap and supplier charges; where two charges meet a line the later one stands."""
    p, stored = period.period, lines
    lines = pools.variance(lines, inputs["variance_actuals"], p, sums_from=stored)
    valued = pools.scrap_valuation(inputs["defective_scrap"], inputs["regional_cost"], period)
    lines = cut(pools.scrap(lines, valued, p, sums_from=stored))
    lines = pools.charge_by_supplier(lines, inputs["supplier_spend"], p, sums_from=stored)
    lines = pools.pooled_suppliers(lines, inputs["supplier_spend"], p, sums_from=stored)
    tags = inputs["tag_charges"]
    lines = pools.charge_by_tag(lines, tags.filter(F.col("region") == "AME").drop("region"), "AME", p)
    lines = pools.top_vendors(lines, inputs["top_vendors"], p, sums_from=stored)
    lines = pools.restricted_vendor(lines, inputs["top_vendors"], p, sums_from=stored)
    lines = pools.charge_by_tag(lines, tags.filter(F.col("region") == "EMEA").drop("region"), "EMEA", p)
    lines = pools.part_charges(cut(lines), inputs["part_charges"], p, sums_from=stored)
    return pools.three_layers(lines, inputs["tag_rates"], inputs["part_level"], inputs["activity_cost"], p, sums_from=stored)


def credited(lines: DataFrame, inputs: dict[str, DataFrame], period: R.Period, options: R.Options, cut: Cut = _whole) -> DataFrame:
    p, stored = period.period, lines
    lines = credits.virtual_credit(lines, inputs["credit_rates"], p, stored)
    lines = cut(credits.priced_credit(lines, inputs["price_list"], p, options.priced_by_consumed))
    averages = credits.contract_averages(
        inputs["contract_cost"], inputs["contract_cost_iw"], inputs["named_vendors"], p
    )
    lines = credits.contract_credits(lines, averages, inputs["kitting_fees"], p, options.maker_credits)
    lines = credits.cid_credit(credits.orphan_credit(lines, inputs["orphan_receipts"], p, stored))
    return consumption.at_standard(consumption.second_pass(lines))


def totalled(lines: DataFrame, inputs: dict[str, DataFrame], period: R.Period, options: R.Options) -> DataFrame:
    p, stored = period.period, lines
    lines = pools.same_day_charge(lines, inputs["top_vendors"], p, stored)
    lines = lines.withColumn("country_inv_costs", F.lit(None).cast("double"))
    if options.line_inventory:
        lines = pools.region_inventory(lines, inputs["region_inventory"], inputs["country_region"], p, sums_from=stored)
    else:
        lines = pools.country_inventory(lines, inputs["subregion_inventory"], inputs["country_inventory_cost"], p, sums_from=stored)
        lines = pools.event_line_inventory(lines, inputs["region_inventory"], p, sums_from=stored)
    lines = pools.taxes(lines, inputs["country_taxes"], p, stored)
    lines = pools.non_event(consumption.totals(lines), inputs["non_event_costs"], p, stored)
    return consumption.product_line_group(lines, inputs["spl_by_region"])


def run_quarter(
    inputs: dict[str, DataFrame], period: R.Period | None = None, options: R.Options | None = None, stages: Stages | None = None
) -> DataFrame:
    """Cost the lines of one quarter. Stages are cut where the next one reads its input more than once
    (every allocation sums the lines before it joins them), on storage that outlives an executor. Within a step they are cut
    after each one or two shuffles of the lines: a packed cut takes a tenth of the shuffle files that go with it.

    stages: where the cuts are kept. Given by the caller, as `with Stages(spark, "2017Q1", basis(...)) as stages`, a run
    that failed continues from its last finished cut, and the cuts are deleted once the caller has written the result. A cut
    goes once the next one is finished, so one is stored at a time.
    """
    period, options = period or R.Period(), options or R.Options()
    stages = stages or Stages(next(iter(inputs.values())).sparkSession)
    cut = stages.cut
    lines = stages.end("base", lambda: based(inputs, period))
    steps = {
        "linked": lambda df: cut(linked(df, inputs, period)), "classified": lambda df: classified(df, inputs, period, options, cut),
        "costed": lambda df: costed(df, inputs, period, cut), "charged": lambda df: charged(df, inputs, period, cut),
        "credited": lambda df: credited(df, inputs, period, options, cut), "totalled": lambda df: totalled(df, inputs, period, options),
    }

    def after(df: DataFrame, *names: str) -> DataFrame:
        for name in names:
            df = with_rest_packed(df, USED[name], steps[name])
        return df

    last = "base"
    for names in (("linked", "classified"), ("costed",), ("charged",), ("credited",)):
        lines = stages.end(names[-1], lambda names=names, lines=lines: after(lines, *names), instead_of=last)
        last = names[-1]
    return after(lines, "totalled").drop(TAG_KEY)


def basis(inputs: dict[str, DataFrame], period: R.Period, options: R.Options) -> tuple:
    """What the stages of a run depend on, for `Stages`. New rows in an input are not seen: such a run takes a new name."""
    return period, options, sorted((name, df.schema.json()) for name, df in inputs.items())
