"""Final disposition flag: ordered rules, the last matching one wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecost import rules as R
from sparecost.functions import semantics as S
from sparecost.operators import Rule, merge_update, rule_cascade
from sparecost.plans.link import by_tag, with_tag_key

FLAG = "final_disp_flag"


def _attach_lookups(lines: DataFrame, tag_flag: DataFrame, tag_vendor: DataFrame, flag_rules: DataFrame,
                    period: str) -> DataFrame:
    """Bring in every lookup that does not depend on the flag, before any rule runs."""
    apj, current = F.col("region") == "APJ", F.col("data_period") == period
    yes = F.lit(True)
    lines = merge_update(
        lines, tag_flag.filter(current).select("flow_tag", "disposition"), by_tag(lines),
        {"tag_flag": "disposition", "tag_flag_hit": yes}, where=apj
    )
    lines = merge_update(
        lines, tag_vendor.filter(current).select("flow_tag", "final_disposition"), by_tag(lines),
        {"vendor_flag": "final_disposition", "vendor_flag_hit": yes}, where=apj
    )
    table = flag_rules.select(S.name_key("supplier").alias("supplier"), "repair_disposition", "repair_warranty_status", "final_disp_flag")
    west = F.col("region").isin("AME", "EMEA")
    for name, key, allowed in (("type", "supplier_type", R.FLAG_SUPPLIER_TYPES), ("l2", "l2_supplier", R.FLAG_SUPPLIERS)):
        lines = merge_update(
            lines, table,
            {"supplier": S.name_key(key), "repair_disposition": "repair_disposition",
             "repair_warranty_status": "repair_warranty_status"},
            {f"{name}_flag": F.col("src_final_disp_flag"), f"{name}_flag_hit": yes},
            where=west & S.is_named(key, *allowed)
        )
    return lines


def final_disposition(
    lines: DataFrame, tag_flag: DataFrame, tag_vendor: DataFrame, code_remap: DataFrame, flag_rules: DataFrame,
    period: str,
) -> DataFrame:
    """Set final_disp_flag.

    tag_flag (flow_tag, disposition), tag_vendor (flow_tag, final_disposition) and code_remap
    (region, final_disp_flag, correct_disposition) correct single flags; flag_rules maps supplier
    or type, repair disposition and warranty to a flag.
    """
    columns = lines.columns
    lines = _attach_lookups(with_tag_key(lines), tag_flag, tag_vendor, flag_rules, period).withColumn(FLAG, F.lit(None).cast("string"))
    region, flag, receipt = F.col("region"), F.col(FLAG), F.col("receipt_type")
    apj, west = region == "APJ", region.isin("AME", "EMEA")
    supplier, repair, warranty = F.col("l2_supplier"), F.col("repair_disposition"), F.col("repair_warranty_status")
    returned, code = F.col("dcr_disposition"), F.col("actual_disposition")
    credit_supplier = apj & F.coalesce(S.name_starts(supplier, *R.CREDIT_SUPPLIER_PREFIXES), F.lit(False))
    physical = receipt == R.PHYSICAL_RECEIPT

    def rule(when, value, reads=False):
        return Rule(when, {FLAG: value}, reads)

    lines = rule_cascade(lines, [
        # the supplier test of the base rule is always true, so it takes every APJ line with a disposition
        rule(apj & S.not_blank("hub_disposition"), F.col("hub_disposition")),
        rule(credit_supplier & warranty.isin("Non Warranty Repair", "Warranty Repair") & (repair == "NFF"), "NFF"),
        rule(credit_supplier & (warranty == "Warranty Repair") & (repair == "Repaired"), "IW Credit"),
        rule(credit_supplier & (warranty == "Non Warranty Repair") & (repair == "Repaired"), "OOW Credit"),
        rule(F.col("tag_flag_hit"), F.col("tag_flag")),
        rule(F.col("vendor_flag_hit"), F.col("vendor_flag")),
        rule(apj & (flag == "CD11"), "In Transit", reads=True),
        rule(apj & S.starts_with_any(returned, R.GOOD_UNUSED_PREFIXES_APJ), "Good Unused"),
        rule(
            apj & ((returned == "SC23") | (flag == "SC23")),
            F.when(F.col("rma_engineer_approval") == "Yes", F.lit("Scrap at Supplier")).otherwise(F.lit("Scrap in Central")),
            reads=True,
        ),
        rule(apj & (receipt == R.LOGICAL_RECEIPT) & ((returned == R.LOGICAL_CODE) | (code == R.LOGICAL_CODE)),
             "Logical Receipt"),
        rule(apj & (returned == "SC01"), "Scrap in Central"),
    ])
    lines = merge_update(lines, code_remap, ["region", FLAG], {FLAG: "correct_disposition"})
    lines = rule_cascade(lines, [
        rule(west & (receipt == R.LOGICAL_RECEIPT) & (code == R.LOGICAL_CODE), "Logical Receipt"),
        rule((region != "APJ") & S.is_named(supplier, "RRD", "PCG") & (repair == "NFF") & physical, "NFF"),
        rule((region != "APJ") & (repair == "Process Scrapped") & physical, "Scrap at Supplier"),
        rule(west & code.isin(*R.SCRAP_CODES), "Scrap in Central"),
        rule(F.col("type_flag_hit"), F.col("type_flag")),
        rule(F.col("l2_flag_hit"), F.col("l2_flag")),
        rule(west & code.isin(*R.TRANSIT_CODES), "In Transit"),
        rule(west & S.starts_with_any(code, R.GOOD_UNUSED_PREFIXES), "Good Unused"),
        rule(receipt == R.NO_RECEIPT, "Non Return"),
        rule(S.not_blank("flow_tag") & S.is_blank(flag), "Part-Level Cost", reads=True),
        rule(S.is_blank("flow_tag") & (receipt != R.NO_RECEIPT), "Unknown"),
    ])
    return lines.select(*[c for c in columns if c != FLAG], FLAG)
