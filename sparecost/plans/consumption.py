"""Consumption cost of a line by its final disposition, and relabel and dekit cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecost import rules as R
from sparecost.functions import semantics as S
from sparecost.operators import Rule, merge_update, rule_cascade
from sparecost.plans.standards import _add


def first_pass(lines: DataFrame, service: DataFrame) -> DataFrame:
    """Costs that need no credit: exchange, repair, part-level, unknown and unused lines."""
    columns = [*lines.columns, *[c for c in ("cons_cost", "cons_cost_notes") if c not in lines.columns]]
    lines = _add(_add(lines, ["cons_cost"]), ["cons_cost_notes"], "string")
    repair_standard = service.filter(F.col("out_warranty_repr") >= 0).select(
        "region", "part", "period", F.col("out_warranty_repr").cast("double").alias("repr")
    )
    flag, average, both = F.col("final_disp_flag"), F.col("oow_avg_repair_cost"), F.col("oow_iw_avg_repair_cost")
    nrs = F.col("event_pn_nrs")
    lines = merge_update(
        lines, repair_standard, {"region": "region", "part": "part_number", "period": "received_month"},
        {"repair_standard": "repr"}, where=flag == "OOW Repair",
    )

    def cost(when, value, note=None, reads=False):
        values = {"cons_cost": value}
        if note:
            values["cons_cost_notes"] = note
        return Rule(when, values, reads)

    lines = rule_cascade(lines, [
        cost(flag == "IW Exch", F.lit(0.0)),
        cost((flag == "OOW Repair") & (average >= 0), average, "OOW Avg Repair Cost Used"),
        cost((flag == "OOW Repair") & S.is_null_or_negative(average) & F.col("repair_standard").isNotNull(),
             F.col("repair_standard"), "iCost SVC Repair Std Used"),
        cost((flag == "OOW Repair") & S.is_null_or_negative("cons_cost"), nrs, "NRS Used", reads=True),
        cost((flag == "Part-Level Cost") & (both >= 0), both, "OOW/IW Avg Repair Cost Used"),
        cost((flag == "Part-Level Cost") & (S.is_null_or_negative(both) | (both == 0)), nrs, "NRS Used"),
        cost(flag.isin(*R.STANDARD_COST_DISPOSITIONS), nrs * F.col("part_qty_consumed"), "NRS Used"),
        cost(flag == "Good Unused", F.lit(0.0)),
    ])
    return lines.select(*columns)


def second_pass(lines: DataFrame) -> DataFrame:
    """Costs that use the credits of a line; run after the credit stage."""
    lines = _add(lines, ["cons_cost", "di_cost", "di_credit"])
    flag, supplier = F.col("final_disp_flag"), F.col("l2_supplier")
    credit, rvs, physical = S.zero("credits"), S.zero("event_pn_rvs"), S.zero("physical_pn_rvs")
    new_buy = S.zero("physical_pn_nbs")
    di = {"di_cost": new_buy + credit, "di_credit": physical - new_buy, "cons_cost": physical + credit}
    return rule_cascade(lines, [
        Rule(S.is_named(supplier, R.DRIVE_SUPPLIER) & (flag == "NFF"), {"cons_cost": F.lit(0.0)}),
        Rule(flag.isin("Non Return", "DMR Drive"), {"cons_cost": rvs + credit}),
        Rule(flag == "Scrap in Central", {"cons_cost": physical}),
        Rule(flag == "Scrap at Supplier", {"cons_cost": physical + credit}),
        Rule(flag.isin(*R.CREDIT_FLAGS), di),
        Rule(flag.isin("Logical Receipt", "Non Return"), {"cons_cost": rvs + credit}),
        Rule(S.is_named(supplier, "PCG") & (flag == "NFF"), di),
    ])


def at_standard(lines: DataFrame) -> DataFrame:
    lines = _add(lines, ["cons_cost_at_std"])
    used, receipt = F.col("part_qty_consumed") > 0, F.col("receipt_type")
    return rule_cascade(lines, [
        Rule(used & receipt.isin(R.LOGICAL_RECEIPT, R.NO_RECEIPT), {"cons_cost_at_std": F.col("event_pn_rvs")}),
        Rule(used & (receipt == R.PHYSICAL_RECEIPT), {"cons_cost_at_std": F.col("event_pn_nrs")}),
    ])


def relabel_and_dekit(lines: DataFrame) -> DataFrame:
    """Differences between the standards of event, kit and physical part; 0 where one is missing."""
    event, kit, physical = F.col("event_pn_rvs"), F.col("kit_pn_rvs"), F.col("physical_pn_rvs")
    new = {}
    for name, first, second, same in (
        ("relabel", event, kit, (event, kit, "Same Kit Part Number")),
        ("dekit", kit, physical, (physical, kit, "Same Physical Part Number")),
    ):
        known = S.has_amount(first) & S.has_amount(second)
        new[f"{name}_cost"] = F.when(known, first - second).otherwise(F.lit(0.0))
        new[f"{name}_cost_comment"] = F.when(~known, F.lit("Missing RVS")).when(same[0] == same[1], F.lit(same[2]))
    return lines.withColumns(new)


def totals(lines: DataFrame) -> DataFrame:
    """Material cost per line, and the same with inventory cost."""
    parts = [S.zero(c) for c in ("cons_cost", "nppo_cost", "relabel_cost", "dekit_cost")]
    parts.append(F.coalesce(F.col("taxes").cast("double"), F.lit(0.0)))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    inventory = S.zero("country_inv_costs") + S.zero("region_inv_costs")
    return lines.withColumns({"total_inv_costs": inventory, "total_matl_cost": total}).withColumn(
        "total_matl_inv_cost", F.col("total_matl_cost") + F.col("total_inv_costs")
    )


def product_line_group(lines: DataFrame, regional_lines: DataFrame) -> DataFrame:
    """EG where the part's product line is on the region's list, PPS where it is another one."""
    lines = _add(lines, ["part_spl_desc"], "string")
    lists = regional_lines.select(
        F.explode(F.array(*[
            F.struct(F.lit(r).alias("region"), F.col(f"{r.lower()}_spl").alias("spl")) for r in R.REGIONS
        ])).alias("e")
    ).select("e.region", "e.spl").filter(S.not_blank("spl")).distinct()
    known = F.col("region").isin(*R.REGIONS)
    lines = merge_update(
        lines.withColumn("listed", F.lit(False)), lists, {"region": "region", "spl": "part_spl"},
        {"listed": F.lit(True)}, on_duplicate="unique"
    )
    return rule_cascade(lines, [
        Rule(known & S.not_blank("part_spl"), {"part_spl_desc": "PPS"}),
        Rule(known & F.col("listed"), {"part_spl_desc": "EG"}),
    ]).drop("listed")
