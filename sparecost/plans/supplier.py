"""First- and second-level supplier of a line."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecost import rules as R
from sparecost.functions import semantics as S
from sparecost.operators import Step, latest_per_key, merge_update, waterfall_lookup, with_spread
from sparecost.plans.link import as_given, by_tag, with_tag_key

SUPPLIER_COLUMNS = ("l1_supplier", "l1_supplier_source", "l2_supplier", "supplier_type")


def add_supplier_columns(lines: DataFrame) -> DataFrame:
    return lines.withColumns({c: F.lit(None).cast("string") for c in SUPPLIER_COLUMNS})


def first_assignment(
    lines: DataFrame, plant_supplier: DataFrame, disposition_supplier: DataFrame,
    rfc_suppliers: DataFrame | None = None, strict: bool = True,
) -> DataFrame:
    """APJ by vendor name, AME by received plant, EMEA by disposition.

    strict: the type of APJ suppliers is looked up before the supplier is set, so it is 'Repair';
    otherwise it comes from rfc_suppliers where that has one.
    """
    vendor = F.coalesce("rma_vendor_name", "repair_vendor", "dcr_vendor_name")
    named = (F.col("region") == "APJ") & S.not_blank(vendor)
    lines = lines.withColumns({
        "l1_supplier": F.when(named, vendor).otherwise(F.col("l1_supplier")),
        "l1_supplier_source": F.when(named, F.lit("RWT")).otherwise(F.col("l1_supplier_source")),
        "supplier_type": F.when(named, F.lit("Repair")).otherwise(F.col("supplier_type")),
    })
    if not strict and rfc_suppliers is not None:
        kind = F.when(S.not_blank("src_supplier_type"), F.col("src_supplier_type")).otherwise(F.lit("Repair"))
        lines = merge_update(
            lines, rfc_suppliers.select(S.name_key("l1_supplier_name").alias("name"), "supplier_type"),
            {"name": S.name_key("l1_supplier")}, {"supplier_type": kind}, where=F.col("region") == "APJ"
        )
    found = {"l1_supplier": "l1_supplier_name", "supplier_type": "supplier_type"}
    lines = merge_update(
        lines, plant_supplier.select("received_plant", "region", "l1_supplier_name", "supplier_type"),
        ["received_plant", "region"], {**found, "l1_supplier_source": F.lit("Received Plant")}
    )
    return merge_update(
        lines, disposition_supplier.select("disposition", "region", "l1_supplier_name", "supplier_type"),
        {"disposition": F.coalesce("dcr_disposition", "actual_disposition"), "region": "region"},
        {**found, "l1_supplier_source": F.lit("iReturns Disposition")}
    )


def contract_vendors(contracts: DataFrame, period: str, trans_type: str | None = None) -> DataFrame:
    """Vendor of the newest cost change per region and part, within the region's plants and cost type."""
    region_rule = F.lit(False)
    for region in R.REGIONS:
        region_rule = region_rule | (
            (F.col("region") == region)
            & (F.col("cost_type") == R.CONTRACT_COST_TYPE[region])
            & F.col("plant").isin(*R.CONTRACT_PLANTS[region])
        )
    wanted = contracts.filter((F.col("data_period") == period) & region_rule)
    if trans_type is not None:
        wanted = wanted.filter(F.col("trans_type") == trans_type)
    return latest_per_key(wanted, ["region", "part"], ["cost_change"], ["vendor_description"]).select(
        "region", "part", F.col("vendor_description").alias("vendor")
    )


def contract_fallback(lines: DataFrame, contracts: DataFrame, new_buy: DataFrame, period: str) -> DataFrame:
    """Fill blank suppliers: return contracts by kit part, by event part, then new-buy contracts alike.

    The three regions share one keyed vendor table per contract kind, and both kinds share the join
    of their key, so the fallback costs one join per key column.
    """
    lines = with_spread(lines, "received_part_kit_part_number", "kit_key")
    steps = []
    for source, label in ((contract_vendors(contracts, period), "CCS Return"),
                          (contract_vendors(new_buy, period, "NB"), "CCS NB")):
        fill = {"l1_supplier": "vendor", "l1_supplier_source": F.lit(label), "supplier_type": F.lit("Repair")}
        for part in ("kit_key", "part_number"):
            steps.append(Step(source, {"region": "region", "part": part}, fill, on_duplicate="unique"))
    return waterfall_lookup(lines, steps, S.is_blank("l1_supplier")).drop("kit_key")


def override_by_tag(lines: DataFrame, tag_vendor: DataFrame, tag_supplier: DataFrame, period: str) -> DataFrame:
    """Named overrides of APJ lines by tag: both levels first, then the first level alone."""
    apj = F.col("region") == "APJ"
    current = F.col("data_period") == period
    given, lines = lines, with_tag_key(lines)
    lines = merge_update(
        lines, tag_vendor.filter(current).select("flow_tag", "final_vendor"), by_tag(lines),
        {"l1_supplier": "final_vendor", "l2_supplier": "final_vendor"}, where=apj
    )
    lines = merge_update(
        lines, tag_supplier.filter(current).select("flow_tag", "l1_supplier"), by_tag(lines),
        {"l1_supplier": "l1_supplier"}, where=apj
    )
    return as_given(lines, given)


def second_level(lines: DataFrame, l2_map: DataFrame, period: str) -> DataFrame:
    """Second-level supplier by region and first level; outside APJ an unmapped supplier stands for itself.

    Null names in the map are left out: a NOT IN list with a null would match nothing.
    """
    # EMEA suppliers from new-buy contracts are assigned after the forced type
    assigned_later = (F.col("region") == "EMEA") & ~S.not_value("l1_supplier_source", "CCS NB")
    named_rfc = S.is_named("l1_supplier", R.RFC_SUPPLIER) & ~assigned_later
    mapped = l2_map.filter(
        (F.col("data_period") == period) & F.col("l1_supplier").isNotNull()
        & ((F.col("region") == "APJ") | ~S.is_named("l1_supplier", R.ALL_ELSE))
    ).select("region", S.name_key("l1_supplier").alias("name"), "l2_supplier", F.col("supplier_type").alias("kind"), F.lit(True).alias("mapped"))
    lines = merge_update(
        lines.withColumn("mapped", F.lit(False)), mapped, {"region": "region", "name": S.name_key("l1_supplier")},
        {"l2_supplier": "l2_supplier", "supplier_type": "kind", "mapped": "mapped"}
    )
    stands = ~F.col("mapped") & F.col("region").isin("AME", "EMEA") & F.col("l1_supplier").isNotNull()
    return lines.withColumns({
        # the forced type is set after the APJ map and before the maps of the other regions
        "supplier_type": F.when(named_rfc & ((F.col("region") == "APJ") | ~F.col("mapped")), F.lit("RFC"))
        .otherwise(F.col("supplier_type")),
        "l2_supplier": F.when(stands, F.col("l1_supplier")).otherwise(F.col("l2_supplier")),
    }).drop("mapped")


def last_fallback(lines: DataFrame, contracts: DataFrame, period: str) -> DataFrame:
    """AME lines still without a supplier take the contract vendor of the physical part.

    This comes after the second level, which therefore stays blank.
    """
    lines = with_spread(lines, "physical_part_number", "physical_key")
    fill = {"l1_supplier": "vendor", "l1_supplier_source": F.lit("CCS Return"), "supplier_type": F.lit("Repair")}
    step = Step(
        contract_vendors(contracts, period), {"region": "region", "part": "physical_key"}, fill,
        where=F.col("region") == "AME", on_duplicate="unique",
    )
    return waterfall_lookup(lines, [step], S.is_blank("l1_supplier")).drop("physical_key")


def assign_suppliers(
    lines: DataFrame, inputs: dict, period: str, strict: bool = True, cut: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    lines = first_assignment(
        add_supplier_columns(lines), inputs["plant_supplier"], inputs["disposition_supplier"],
        None if strict else inputs["rfc_suppliers"], strict,
    )
    lines = cut(contract_fallback(lines, inputs["contract_vendor"], inputs["new_buy_vendor"], period))
    lines = override_by_tag(lines, inputs["tag_vendor"], inputs["tag_supplier"], period)
    lines = second_level(lines, inputs["l2_supplier_map"], period)
    return last_fallback(lines, inputs["contract_vendor"], period)
