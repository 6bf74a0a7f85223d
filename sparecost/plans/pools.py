"""Overheads spread over lines: variance, scrap, supplier charges, inventory, tax, non-event cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost import rules as R
from sparecost.functions import semantics as S
from sparecost.operators import Pool, allocate_pool, latest_per_key, merge_update, rate_by_group, with_spread
from sparecost.plans.link import KEY, as_given, by_tag, tag_in_use, with_tag_key
from sparecost.plans.standards import _add

QTY = "part_qty_consumed"
DEMAND = "part_qty_demanded"


def outside_excluded() -> Column:
    return F.col("event_country_iso_cd") != R.EXCLUDED_COUNTRY


def _period(df: DataFrame, period: str) -> DataFrame:
    return df.filter(F.col("data_period") == period)


def _by_name(pool: DataFrame, name: str, amount: str, of: str = "l2_supplier") -> Pool:
    """A pool whose key is a name; two spellings of one name in it are two rows for one key, which fails the job.

    The payers are a short list, and lines would be shuffled by a supplier alone before the bytes of the rates are known.
    """
    return Pool(pool.withColumn(name, S.name_key(name)), {name: S.name_key(of)}, amount, few=True)


# ---- standard variance and defective scrap -------------------------------------------

def variance(lines: DataFrame, actuals: DataFrame, period: str, sums_from: DataFrame | None = None) -> DataFrame:
    """Variance of region and product line by consumed quantity; the line is the code's first two characters."""
    pool = _period(actuals, period).select(
        "region", F.left("l06_ba_code", F.lit(2)).alias("spl"), F.col("actuals_usd").alias("amount")
    )
    return allocate_pool(
        _add(lines, ["esc_variance"]), Pool(pool, {"region": "region", "spl": "event_spl"}, "amount", few=True),
        QTY, "esc_variance", base=outside_excluded(), sums_from=sums_from
    )


def scrap_valuation(scrap: DataFrame, regional: DataFrame, period: R.Period) -> DataFrame:
    """Gross cost at standard, release at net standard, and the net of both, per region and material."""
    costs = regional.filter(F.col("report_month") == period.cost_month).select(
        "region", F.col("part_no").alias("material"), "rvs", "nrs"
    )
    gross, release = F.col("quantity") * F.col("src_rvs"), F.col("quantity") * F.col("src_nrs") * -1.0
    empty = scrap.withColumns({c: F.lit(None).cast("double") for c in ("gross_scrap", "ctr_release", "net_scrap")})
    return merge_update(
        empty, costs, ["region", "material"],
        {"gross_scrap": gross, "ctr_release": release, "net_scrap": gross + release},
        where=F.col("data_period") == period.period,
    )


def _scrap_base() -> Column:
    return F.col("region").isin("EMEA", "AME") & tag_in_use() & (F.col("final_disp_flag") == "Part-Level Cost")


def _scrap_pool(valued: DataFrame, period: str) -> Pool:
    """Rows of a material that could not be valued carry no amount."""
    return Pool(_period(valued, period), {"region": "region", "material": "part_number"}, "net_scrap")


def scrap(lines: DataFrame, valued: DataFrame, period: str, sums_from: DataFrame | None = None) -> DataFrame:
    """Net scrap of a material over its part-level lines; nothing where none was consumed."""
    return allocate_pool(
        _add(lines, ["def_scrap_cost"]), _scrap_pool(valued, period), QTY, "def_scrap_cost",
        base=_scrap_base(), zero_base="zero", sums_from=sums_from
    )


def scrap_audit(lines: DataFrame, valued: DataFrame, period: str) -> DataFrame:
    """Per region and part: consumed quantity, net scrap and the unit cost charged."""
    pool = _scrap_pool(valued, period)
    rates = rate_by_group(lines, pool, QTY, _scrap_base(), zero_base="zero")
    return rates.join(pool.df.select("region", "material", "net_scrap"), ["region", "material"]).select(
        "region", F.col("material").alias("part_number"), F.col("__total").alias("total_cons_qty"), "net_scrap",
        F.col("__rate").alias("def_scrap_cost"),
    )


# ---- supplier charges -------------------------------------------------------------------

def charge_by_supplier(lines: DataFrame, spend: DataFrame, period: str, sums_from: DataFrame | None = None) -> DataFrame:
    """APJ: spend of a supplier over its lines; the pooled payers are left to pooled_suppliers."""
    base = (F.col("region") == "APJ") & outside_excluded() & tag_in_use()
    pool = _by_name(_period(spend, period), "supplier", "spend")
    return allocate_pool(
        _add(lines, ["nppo_cost"]), pool, QTY, "nppo_cost", base=base,
        target=base & ~S.is_named("l2_supplier", *R.POOLED_PAYERS), sums_from=sums_from
    )


def pooled_suppliers(lines: DataFrame, spend: DataFrame, period: str, sums_from: DataFrame | None = None) -> DataFrame:
    """APJ: spend of two suppliers over the hard drives of three."""
    paid = _period(spend, period).filter(S.is_named("supplier", *R.POOLED_PAYERS))
    pool = paid.agg(S.exact_sum("spend").alias("spend")).select(F.lit("APJ").alias("region"), "spend")
    base = (
        (F.col("region") == "APJ") & outside_excluded() & tag_in_use()
        & (F.col("part_commodity") == R.HARD_DRIVE) & S.is_named("l2_supplier", *R.POOLED_USERS)
    )
    return allocate_pool(
        _add(lines, ["nppo_cost"]), Pool(pool, {"region": "region"}, "spend", "unique", few=True), QTY, "nppo_cost", base=base, sums_from=sums_from
    )


def charge_by_tag(lines: DataFrame, charges: DataFrame, region: str, period: str) -> DataFrame:
    """Charges billed per tag: (flow_tag, charge, turn); the highest turn of a tag wins."""
    newest = latest_per_key(_period(charges, period), ["flow_tag"], ["turn"], ["charge"])
    keyed = with_tag_key(lines)
    return as_given(merge_update(
        _add(keyed, ["nppo_cost"]), newest.select("flow_tag", "charge"), by_tag(keyed),
        {"nppo_cost": F.col("src_charge").cast("double")}, where=F.col("region") == region,
        on_duplicate="unique"
    ), lines)


def top_vendors(lines: DataFrame, vendors: DataFrame, period: str, sums_from: DataFrame | None = None) -> DataFrame:
    """AME: charge of each listed vendor over its lines, but for the two with rules of their own."""
    pool = _period(vendors, period).filter(
        ~S.is_named("vendor", R.DRIVE_SUPPLIER, R.SAME_DAY_SUPPLIER)
    )
    return allocate_pool(
        _add(lines, ["nppo_cost"]), _by_name(pool, "vendor", "nppo"), QTY, "nppo_cost",
        base=(F.col("region") == "AME") & tag_in_use(), sums_from=sums_from
    )


def restricted_vendor(lines: DataFrame, vendors: DataFrame, period: str, sums_from: DataFrame | None = None) -> DataFrame:
    """AME: one vendor's charge over its lines with the listed dispositions."""
    pool = _period(vendors, period).filter(S.is_named("vendor", R.DRIVE_SUPPLIER))
    base = (F.col("region") == "AME") & tag_in_use() & F.col("final_disp_flag").isin(*R.RESTRICTED_FLAGS)
    return allocate_pool(
        _add(lines, ["nppo_cost"]), _by_name(pool, "vendor", "nppo"), QTY, "nppo_cost", base=base, sums_from=sums_from
    )


def charge_vendor() -> Column:
    """Which vendor's part charges a line shares in, from its second-level supplier."""
    supplier = F.col("l2_supplier")
    vendor = F.when(F.lit(False), F.lit(""))
    for name, prefix in R.PART_CHARGE_PREFIXES.items():
        vendor = vendor.when(S.name_starts(supplier, prefix), F.lit(name))
    for name, full in R.PART_CHARGE_NAMES.items():
        vendor = vendor.when(S.is_named(supplier, full), F.lit(name))
    return vendor


def part_charges(lines: DataFrame, charges: DataFrame, period: str, sums_from: DataFrame | None = None) -> DataFrame:
    """EMEA: charges per vendor and part over the vendor's lines of the part.

    All vendors share one table keyed by vendor and part. One vendor also has a total credit, which
    is spread evenly over the quantity of its charged parts.
    """
    current = _period(charges, period)
    per_part = current.filter(F.col("part_number") != R.TOTAL_CREDIT).select("vendor", "part_number", "charge")
    lines = _add(lines, ["nppo_cost"])
    tagged = lines.withColumn("__vendor", charge_vendor())
    base = (F.col("region") == "EMEA") & tag_in_use() & F.col("__vendor").isNotNull()
    on = {"vendor": "__vendor", "part_number": "part_number"}
    sums = tagged if sums_from is None else sums_from.withColumn("__vendor", charge_vendor())
    rates = rate_by_group(sums, Pool(per_part, on, "charge"), QTY, base, zero_base="any")
    credit = current.filter(
        (F.col("part_number") == R.TOTAL_CREDIT) & (F.col("vendor") == R.SHARED_CREDIT_VENDOR)
    ).select("vendor", F.col("charge").cast("double").alias("credit"))
    charged = rates.groupBy("vendor").agg(S.exact_sum("__total").alias("charged_qty"))
    unit_credit = credit.join(charged, "vendor").select(
        "vendor", S.safe_ratio("credit", "charged_qty").alias("unit_credit")
    )
    shared = F.col("vendor") == R.SHARED_CREDIT_VENDOR
    # one row per total credit, so it is broadcast: joined by shuffle it would leave the units, and with them the lines,
    # partitioned by vendor alone
    units = rates.filter(F.col("__total") > 0).join(F.broadcast(unit_credit), "vendor", "left").select(
        "vendor", "part_number",
        F.when(shared, F.col("__rate") + F.col("unit_credit")).otherwise(F.col("__rate")).alias("unit"),
    )
    # lines of no such vendor are spread
    keyed, on = (with_spread(tagged, "__vendor", "__vendor_key"), {**on, "vendor": "__vendor_key"}) if KEY in lines.columns else (tagged, on)
    return merge_update(
        keyed, units, on, {"nppo_cost": F.col("src_unit") * F.col(QTY)}, where=base, on_duplicate="unique"
    ).drop("__vendor", "__vendor_key")


def three_layers(
    lines: DataFrame, tag_rates: DataFrame, part_level: DataFrame, activity: DataFrame, period: str,
    sums_from: DataFrame | None = None,
) -> DataFrame:
    """EMEA, one supplier: rate by repair disposition, charge per part and an activity charge.

    The activity layer is the total cost over the total quantity for every line, whatever its own
    quantity. The sum goes to lines whose repair is in use; a tag in use has one line, so the
    write-back by tag needs no join.
    """
    base = (F.col("region") == "EMEA") & S.is_named("l2_supplier", R.DRIVE_SUPPLIER) & tag_in_use()
    used = F.col(QTY) > 0
    columns = lines.columns if "nppo_cost" in lines.columns else [*lines.columns, "nppo_cost"]
    lines = _add(lines, ["nppo_cost"])
    lines = lines.withColumns({c: F.lit(None).cast("double") for c in ("tag_layer", "part_layer", "activity_layer")})
    lines = merge_update(
        lines, _period(tag_rates, period).select("repair_disposition", "rate"), ["repair_disposition"],
        {"tag_layer": F.col("src_rate").cast("double") * F.col(QTY)}, where=base & used
    )
    lines = allocate_pool(
        lines, Pool(_period(part_level, period), {"part_number": "part_number"}, "charge"), QTY, "part_layer",
        base=base, zero_base="positive", sums_from=sums_from
    )
    spent = _period(activity, period).agg(S.exact_sum(S.zero("cost")).alias("cost")).select(
        F.lit("EMEA").alias("region"), "cost"
    )
    lines = allocate_pool(
        lines, Pool(spent, {"region": "region"}, "cost", "unique", few=True), QTY, "activity_layer",
        base=base, target=base & used, share=F.lit(1.0), sums_from=sums_from
    )
    total = S.zero("tag_layer") + S.zero("part_layer") + S.zero("activity_layer")
    fires = base & used & (F.col("repair_tag_used") != "N") & S.not_blank("flow_tag") & (total != 0)
    return lines.withColumn("nppo_cost", F.when(fires, total).otherwise(F.col("nppo_cost"))).select(*columns)


def same_day_charge(lines: DataFrame, vendors: DataFrame, period: str, sums_from: DataFrame | None = None) -> DataFrame:
    """One vendor's charge per unit over its same-day lines in two countries."""
    pool = _period(vendors, period).filter(S.is_named("vendor", R.SAME_DAY_SUPPLIER)).select(
        F.lit(R.SAME_DAY_SUPPLIER_L1).alias("supplier"), "nppo"
    )
    base = (
        F.col("event_country_iso_cd").isin(*R.SAME_DAY_COUNTRIES) & S.is_named("l1_supplier", R.SAME_DAY_SUPPLIER_L1)
        & (F.col("part_actual_sl") == R.SAME_DAY_LEVEL) & (F.col(QTY) != 0)
    )
    return allocate_pool(
        _add(lines, ["nppo_cost"]), _by_name(pool, "supplier", "nppo", "l1_supplier"), QTY, "nppo_cost", base=base, sums_from=sums_from
    )


# ---- inventory cost ------------------------------------------------------------------------

def _demanded() -> Column:
    return tag_in_use() & (F.col(DEMAND) > 0)


def _inventory_region(lines: DataFrame, countries: DataFrame) -> DataFrame:
    return merge_update(
        lines.withColumn("inv_region", F.when(F.col("region").isin("APJ", "EMEA"), F.col("region"))),
        countries.select("iso_country_code", "na_vs_la"), {"iso_country_code": "event_country_iso_cd"},
        {"inv_region": "na_vs_la"}, where=F.col("region") == "AME"
    )


def event_line_inventory(lines: DataFrame, inventory: DataFrame, period: str, sums_from: DataFrame | None = None) -> DataFrame:
    """Older rule: inventory cost of region and the event's product line over demanded quantity, regions not split."""
    base = _demanded() & outside_excluded()
    pool = Pool(_period(inventory, period), {"region": "region", "spl": "event_spl"}, "total_inv_cost")
    lines = _add(lines, ["region_inv_costs"])
    return allocate_pool(
        lines, pool, DEMAND, "region_inv_costs", base=base, target=base & F.col("region_inv_costs").isNull(), sums_from=sums_from)


def region_inventory(
    lines: DataFrame, inventory: DataFrame, countries: DataFrame, period: str, sums_from: DataFrame | None = None,
) -> DataFrame:
    """Inventory cost of region and the part's product line over demanded quantity.

    AME is split in north and south by country; the split becomes part of the region key, so all
    regions are allocated in one pass.
    """
    keyed = _inventory_region(_add(lines, ["region_inv_costs"]), countries)
    sums = None if sums_from is None else _inventory_region(sums_from, countries)
    base = _demanded() & F.col("inv_region").isNotNull() & ((F.col("region") == "AME") | outside_excluded())
    pool = Pool(_period(inventory, period), {"region": "inv_region", "spl": "part_spl"}, "total_inv_cost")
    return allocate_pool(
        keyed, pool, DEMAND, "region_inv_costs", base=base, target=base & F.col("region_inv_costs").isNull(),
        sums_from=sums,
    ).drop("inv_region")


def country_inventory(
    lines: DataFrame, by_subregion: DataFrame, by_country: DataFrame, period: str, sums_from: DataFrame | None = None
) -> DataFrame:
    """Older rule: cost of sub-region and event product line first, country cost where none was set."""
    lines = _add(lines, ["country_inv_costs"])
    base = _demanded() & outside_excluded()
    home = latest_per_key(
        _period(by_subregion, period), ["spl", "iso_country_code"], ["total_inv_cost"], ["sub_region"]
    )
    keyed = merge_update(
        lines.withColumns({"__sub": F.lit(None).cast("string"), "__cost": F.lit(None).cast("double")}),
        # product lines and countries are closed lists: all three joins are broadcast, or each would shuffle the lines
        F.broadcast(home.select("spl", "iso_country_code", "sub_region", "total_inv_cost")),
        {"spl": "event_spl", "iso_country_code": "event_country_iso_cd"},
        {"__sub": "sub_region", "__cost": F.col("src_total_inv_cost").cast("double")},
        on_duplicate="unique"
    )
    # by country first, which the lines hold themselves, then by the sub-region of the country
    demanded = (lines if sums_from is None else sums_from).filter(base).groupBy(
        F.col("event_spl").alias("spl"), F.col("event_country_iso_cd").alias("iso_country_code")).agg(S.exact_sum(DEMAND).alias("qty"))
    totals = home.select("spl", "iso_country_code", "sub_region").join(demanded, ["spl", "iso_country_code"]).groupBy("spl", "sub_region").agg(
        S.exact_sum("qty").alias("qty"))
    keyed = merge_update(
        keyed, F.broadcast(totals), {"spl": "event_spl", "sub_region": "__sub"},
        {"country_inv_costs": F.col("__cost") / F.nullif(F.col("src_qty"), F.lit(0.0)) * F.col(DEMAND)},
        where=base, on_duplicate="unique",
    ).drop("__sub", "__cost")
    pool = Pool(
        _period(by_country, period), {"iso_country_code": "event_country_iso_cd", "spl": "event_spl"}, "total_inv_cost", few=True
    )
    return allocate_pool(
        keyed, pool, DEMAND, "country_inv_costs", base=base, target=base & F.col("country_inv_costs").isNull(), sums_from=sums_from
    )


# ---- tax and non-event cost ------------------------------------------------------------------

def taxes(lines: DataFrame, by_country: DataFrame, period: str, sums_from: DataFrame | None = None) -> DataFrame:
    """Taxes of a country over consumed value at standard, stored as money."""
    base = tag_in_use() & outside_excluded() & (F.col(QTY) > 0)
    pool = _period(by_country, period).filter(S.has_amount("total_taxes"))
    allocated = allocate_pool(
        lines.withColumn("taxes", F.lit(None).cast("double")),
        Pool(pool, {"iso_country_code": "event_country_iso_cd"}, "total_taxes"),
        S.zero("event_pn_rvs") * F.col(QTY), "taxes", base=base, share=F.col("event_pn_rvs") * F.col(QTY), sums_from=sums_from
    )
    return allocated.withColumn("taxes", S.money("taxes"))


def non_event(lines: DataFrame, costs: DataFrame, period: str, sums_from: DataFrame | None = None) -> DataFrame:
    """Cost of a region outside events over demanded value at standard."""
    pool = Pool(_period(costs, period), {"region": "region"}, "cost_value", few=True)
    return allocate_pool(
        _add(lines, ["non_event_cost"]), pool, F.col(DEMAND) * F.col("event_pn_rvs"), "non_event_cost",
        base=S.has_amount(DEMAND), target=F.lit(True),
        share=F.coalesce(F.col(DEMAND), F.lit(0)) * F.col("event_pn_rvs"), sums_from=sums_from
    )
