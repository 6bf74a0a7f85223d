"""Standard costs, average repair costs and part age of a line."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecost import rules as R
from sparecost.functions import semantics as S
from sparecost.operators import Step, merge_update, waterfall_lookup, with_spread

COST_COLUMNS = (
    "event_pn_rvs", "event_pn_nrs", "kit_pn_rvs", "physical_pn_rvs", "physical_pn_nrs", "physical_pn_nbs",
)


def _add(lines: DataFrame, names, kind="double") -> DataFrame:
    missing = [n for n in names if n not in lines.columns]
    return lines.withColumns({n: F.lit(None).cast(kind) for n in missing}) if missing else lines


def standard_costs(
    lines: DataFrame, regional: DataFrame, sap: DataFrame, adjustments: DataFrame, service: DataFrame,
    period: R.Period, cut: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Event part, kit part and physical part at standard: regional cost, then master, then adjustment.

    A later source is used only while the cost is null or zero. Event parts read the regional cost
    of the fixed cost month, so their three sources share one key and one join; the others read the
    month of receipt first and the two period sources by part. Lines are shuffled once per part role.
    """
    lines = _add(lines, COST_COLUMNS)
    lines = with_spread(lines, "received_part_kit_part_number", "kit_key")
    lines = with_spread(lines, "physical_part_number", "physical_key")
    current = F.col("data_period") == period.period
    fixed = regional.filter(F.col("report_month") == period.cost_month)
    later = [t.filter(current).select("region", "part_number", "rvs", "nrs") for t in (sap, adjustments)]

    for part, values, missing in (
        ("kit_key", {"kit_pn_rvs": "rvs"}, "kit_pn_rvs"),
        ("physical_key", {"physical_pn_rvs": "rvs", "physical_pn_nrs": "nrs"}, "physical_pn_rvs"),
    ):
        monthly = {"region": "region", "part_no": part, "report_month": "received_month"}
        by_month = regional.select("region", "part_no", "report_month", "rvs", "nrs")
        steps = [Step(by_month, monthly, values)]
        steps += [Step(t, {"region": "region", "part_number": part}, values) for t in later]
        lines = waterfall_lookup(lines, steps, S.is_null_or_zero(missing))

    new_buy = service.select("region", "part", "period", "new_buy")
    lines = merge_update(
        lines, new_buy, {"region": "region", "part": "physical_key", "period": "received_month"},
        {"physical_pn_nbs": F.col("src_new_buy").cast("double")}, near=("region", "part"),
    )
    lines = cut(lines)
    # event parts last: the repair averages that follow use the same key
    both = {"event_pn_rvs": "rvs", "event_pn_nrs": "nrs"}
    steps = [Step(fixed.select("region", "part_no", "rvs", "nrs"), {"region": "region", "part_no": "part_number"}, both)]
    steps += [Step(t, {"region": "region", "part_number": "part_number"}, both) for t in later]
    lines = waterfall_lookup(
        lines, steps, S.is_null_or_zero("event_pn_rvs") & S.is_null_or_zero("event_pn_nrs")
    )
    return lines.drop("kit_key", "physical_key")


def repair_averages(orders: DataFrame, year: str, quarter: str) -> DataFrame:
    """Average repair cost by region and part: out of warranty, and all order types.

    Both averages come from one pass: the narrower order types are a condition inside the wider set,
    which gives the same rows as joining the two aggregates in full.
    """
    period = (F.col("fiscal_year") == year) & (F.col("fiscal_quarter") == quarter)
    wanted = orders.filter(period & F.col("sub_order_type").isin(*R.ALL_ORDER_TYPES))
    oow = F.col("sub_order_type").isin(*R.OOW_ORDER_TYPES)
    spend, qty = F.abs("spend"), F.abs("qty")
    averaged = wanted.groupBy("region", "material").agg(
        S.exact_sum(F.when(oow, spend)).alias("oow_spend"), S.exact_sum(F.when(oow, qty)).alias("oow_qty"),
        S.exact_sum(spend).alias("spend"), S.exact_sum(qty).alias("qty"),
    )
    return averaged.select(
        S.recode_region("region").alias("region"), "material",
        S.safe_ratio("oow_spend", "oow_qty").alias("oow_avg_repair_cost"),
        S.safe_ratio("spend", "qty").alias("oow_iw_avg_repair_cost"),
        F.lit(year + quarter).alias("data_period"),
    )


def repair_order_detail(orders: DataFrame, year: str, quarter: str) -> DataFrame:
    period = (F.col("fiscal_year") == year) & (F.col("fiscal_quarter") == quarter)
    return (
        orders.filter(period & F.col("sub_order_type").isin(*R.ALL_ORDER_TYPES))
        .groupBy("region", "vendor_id", "vendor_name", "sub_order_type", "po_number", "material")
        .agg(S.exact_sum("qty").cast("long").alias("total_qty"), S.exact_sum("spend").alias("total_spend"))
        .withColumn("data_period", F.lit(year + quarter))
    )


def link_repair_average(lines: DataFrame, averages: DataFrame, period: str) -> DataFrame:
    """Attach both averages and whether the out-of-warranty one exceeds the standard."""
    found = averages.filter(F.col("data_period") == period).select(
        "region", "material", "oow_avg_repair_cost", "oow_iw_avg_repair_cost"
    )
    above = F.when(F.col("src_oow_avg_repair_cost") > F.col("event_pn_rvs"), F.lit("Y")).otherwise(F.lit("N"))
    return merge_update(
        lines, found, {"region": "region", "material": "part_number"},
        {"oow_avg_repair_cost": F.col("src_oow_avg_repair_cost"),
         "oow_iw_avg_repair_cost": F.col("src_oow_iw_avg_repair_cost"), "avg_above_standard": above},
    )


def part_age(lines: DataFrame, week_codes: DataFrame, mid_quarter: str) -> DataFrame:
    """Manufacture date from characters 10-11 of a 14-character label, and age in years at mid-quarter."""
    label = F.col("ct_code_label")
    drives = (
        F.col("region").isin("AME", "EMEA") & S.is_named("l2_supplier", R.DRIVE_SUPPLIER)
        & S.is_named("repair_oem_name", R.DRIVE_MAKER)
    ) | ((F.col("region") == "APJ") & S.is_named("l2_supplier", R.DRIVE_MAKER))
    scope = (S.text_length(label) == 14) & (F.col("receipt_type") == R.PHYSICAL_RECEIPT) & drives
    months = S.month_boundaries("src_week_beginning", F.lit(mid_quarter).cast("date"))
    return merge_update(
        lines, week_codes.select("week_code", "week_beginning"), {"week_code": F.substring(label, 10, 2)},
        {"mfg_date": F.col("src_week_beginning"),
         "part_age": (months.cast("double") / 12).cast("decimal(18,1)")},
        where=scope
    )
