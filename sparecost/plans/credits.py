"""Supplier credits of a line, from the virtual credit to the contract credits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost import rules as R
from sparecost.functions import semantics as S
from sparecost.operators import Pool, Rule, allocate_pool, merge_update, rule_cascade, with_spread
from sparecost.plans.pools import QTY, outside_excluded
from sparecost.plans.standards import _add

_FORECAST = "CCS NB Fcst"
_FORECAST_BLANK = "CCS NB Fcst - Blank Part Age"
_IN_WARRANTY = "CCS IW Credit"
_OUT_OF_WARRANTY = "CCS OOW Credit"
_SUPPLIER = "Supplier Credit"


def _ready(lines: DataFrame) -> DataFrame:
    return _add(_add(lines, ["credits"]), ["credit_comments"], "string")


def dmr_status(lines: DataFrame, dmr: DataFrame) -> DataFrame:
    """DMR flag by region and order item without hyphens; 'No DMR' where none is found."""
    flags = dmr.filter(S.not_blank("dmr_flag")).select("region", "so_item", "dmr_flag").distinct()
    # lines without an order item are spread, or they would share one key per region
    keyed = with_spread(_add(lines, ["dmr_status"], "string").withColumn("__item", S.unhyphenate("so_item")), "__item", "__item_key")
    found = merge_update(
        keyed, flags, {"region": "region", "so_item": "__item_key"}, {"dmr_status": "dmr_flag"}, on_duplicate="first", order=("dmr_flag",),
    ).drop("__item", "__item_key")
    return found.withColumn(
        "dmr_status", F.when(S.is_blank("dmr_status"), F.lit("No DMR")).otherwise(F.col("dmr_status"))
    )


def virtual_credit(
    lines: DataFrame, rates: DataFrame, period: str, sums_from: DataFrame | None = None
) -> DataFrame:
    """Credit rate of region and drive type over the value of its lines without a physical receipt."""
    current = rates.filter(F.col("data_period") == period)
    pool = current.select("region", F.explode(F.create_map(
        F.lit(R.HARD_DRIVE), F.col("hdd_credit_rate").cast("double"),
        F.lit(R.SOLID_STATE), F.col("ssd_credit_rate").cast("double"),
    )).alias("commodity", "rate")).withColumn("rate", -F.col("rate"))
    base = (
        F.col("part_commodity").isin(R.HARD_DRIVE, R.SOLID_STATE) & (F.col("dmr_status") == "DMR")
        & F.col("receipt_type").isin(R.LOGICAL_RECEIPT, R.NO_RECEIPT)
    )
    return allocate_pool(
        _ready(lines), Pool(pool, {"region": "region", "commodity": "part_commodity"}, "rate", few=True),
        S.zero(F.col(QTY).cast("double")) * S.zero("event_pn_rvs"), "credits", base=base,
        share=F.col(QTY) * F.col("event_pn_rvs"), extra={"credit_comments": F.lit("DMR Credit")}, sums_from=sums_from,
    )


def priced_credit(lines: DataFrame, prices: DataFrame, period: str, by_consumed: bool = False) -> DataFrame:
    """Credit at list price by disposition and commodity; other combinations lose their credit."""
    lines = with_spread(_ready(lines), "received_part_kit_part_number", "kit_key")
    listed = prices.filter(F.col("data_period") == period).select("region", "part_number", "commodity", "final_price")
    flag, commodity = F.col("final_disp_flag"), F.col("src_commodity")
    qty = F.col(QTY if by_consumed else "part_qty_received")
    value = qty * F.col("src_final_price").cast("double")
    credits = F.when(flag.isin(*R.CREDIT_FLAGS) & (commodity == R.MEMORY), value * R.MEMORY_FACTOR * -1.0)
    credits = credits.when((flag == "IW Credit") & (commodity == R.PROCESSOR), value * -1.0)
    credits = credits.when((flag == "NFF") & commodity.isin(R.PROCESSOR, R.MEMORY), value * -1.0)
    credits = credits.when(flag == "Scrap at Supplier", value * R.SCRAP_FACTOR * -1.0)
    known = (
        (flag.isin(*R.CREDIT_FLAGS) & (commodity == R.MEMORY)) | ((flag == "IW Credit") & (commodity == R.PROCESSOR))
        | ((flag == "NFF") & commodity.isin(R.PROCESSOR, R.MEMORY)) | (flag == "Scrap at Supplier")
    )
    scope = S.name_starts("l2_supplier", "PCG") & flag.isin(*R.PRICED_FLAGS)
    if not by_consumed:
        scope = scope & (F.col("part_qty_received") == 1)
    return merge_update(
        lines, listed, {"region": "region", "part_number": "kit_key"},
        {"credits": credits, "credit_comments": F.when(known, F.lit(_SUPPLIER))}, where=scope,
    ).drop("kit_key")


def contract_averages(contract: DataFrame, contract_iw: DataFrame, named_vendors: DataFrame, period: str) -> DataFrame:
    """All contract averages of region, month and part in one row, for one join with the lines.

    nb_*: new-buy forecast; iw_*: in-warranty contract; oow: out-of-warranty contract.
    *_named: vendors of the list and the three organisations; *_org: the organisations only.
    """
    key = ["region", "month", "part_no"]
    vendors = named_vendors.filter(F.col("data_period") == period).select(
        "region", F.col("vendor").alias("vendor_no"), F.lit(1).alias("weight")
    )
    # a vendor listed twice would count twice, as the join of the list does
    vendors = vendors.groupBy("region", "vendor_no").agg(F.sum("weight").alias("weight"))
    org = F.col("org_cd").isin(*R.CONTRACT_ORGS)
    new_buy = org & (F.col("transaction_type") == "NB") & (F.col("forecast_cost") >= 0)
    named = F.col("weight").isNotNull()

    def average(cost, when, weight=None):
        value = F.when(when, F.col(cost).cast("double"))
        n = F.when(when & F.col(cost).isNotNull(), F.lit(1))
        if weight is not None:
            value, n = value * F.col(weight), n * F.col(weight)
        return S.exact_sum(value) / F.nullif(F.sum(n).cast("double"), F.lit(0.0))

    def count(when):
        return F.count(F.when(when, F.lit(1)))

    always = F.lit(True)
    plain = contract.join(vendors, ["region", "vendor_no"], "left").groupBy(*key).agg(
        average("contract_cost", F.col("transaction_type") == "OC").alias("oow_avg"),
        count(F.col("transaction_type") == "OC").alias("oow_n"),
        average("forecast_cost", new_buy & named, "weight").alias("nb_named_avg"), count(new_buy & named).alias("nb_named_n"),
        average("forecast_cost", new_buy).alias("nb_org_avg"), count(new_buy).alias("nb_org_n"),
    )
    warranty = contract_iw.join(vendors, ["region", "vendor_no"], "left").groupBy(*key).agg(
        average("contract_cost", always).alias("iw_avg"), count(always).alias("iw_n"),
        average("contract_cost", org & named, "weight").alias("iw_named_avg"), count(org & named).alias("iw_named_n"),
        average("contract_cost", org).alias("iw_org_avg"), count(org).alias("iw_org_n"),
    )
    return plain.join(warranty, key, "full")


_AVERAGES = ("oow", "nb_named", "nb_org", "iw", "iw_named", "iw_org")


def _attach(lines: DataFrame, averages: DataFrame) -> DataFrame:
    lines = with_spread(_ready(lines), "physical_part_number", "physical_key")
    values = {f"{a}_{s}": f"{a}_{s}" for a in _AVERAGES for s in ("avg", "n")}
    lines = merge_update(
        lines, averages, {"region": "region", "part_no": "physical_key", "month": "received_month"},
        values, on_duplicate="unique",
    )
    return lines.drop("physical_key")


def _has(name: str) -> Column:
    return F.coalesce(F.col(f"{name}_n") > 0, F.lit(False))


def _minus(name: str) -> Column:
    return F.col(f"{name}_avg") * -1.0


def _flag(*flags) -> Column:
    return F.col("final_disp_flag").isin(*flags)


def _west() -> Column:
    return F.col("region").isin("AME", "EMEA")


def contract_fallback_rules() -> list[Rule]:
    """Contract averages where priced suppliers have no credit yet, or one that is not negative."""
    open_credit = F.col("credits").isNull() | (F.col("credits") > 0)
    priced = S.name_starts("l2_supplier", "PCG")

    def fallback(name, flags, label):
        return Rule(
            priced & _has(name) & _flag(*flags) & open_credit,
            {"credits": _minus(name), "credit_comments": F.when(S.is_blank("credit_comments"), F.lit(label))}, True,
        )

    return [
        fallback("iw", ("IW Credit", "NFF", "Scrap at Supplier"), _IN_WARRANTY),
        fallback("oow", ("OOW Credit",), _OUT_OF_WARRANTY),
    ]


def _maker_line() -> Column:
    west = _west() & S.is_named("l2_supplier", R.DRIVE_SUPPLIER) & S.is_named("repair_oem_name", R.DRIVE_MAKER)
    apj = (F.col("region") == "APJ") & S.is_named("l2_supplier", R.DRIVE_MAKER)
    return (west | apj) & _flag("IW Credit")


def age_credit_rules() -> list[Rule]:
    """Named maker: forecast cost, half of it for old parts; then the contract where still open."""
    age = F.col("part_age")
    forecast = F.when(age > R.AGE_LIMIT, F.col("nb_named_avg") * R.AGED_FACTOR * -1.0).otherwise(_minus("nb_named"))
    comment = F.when(age.isNotNull(), F.lit(_FORECAST)).otherwise(F.lit(_FORECAST_BLANK))
    return [
        Rule(_maker_line() & _has("nb_named"), {"credits": forecast, "credit_comments": comment}),
        Rule(
            _maker_line() & _has("iw_named") & S.is_null_or_zero("credits"),
            {"credits": _minus("iw_named"), "credit_comments": F.lit(_IN_WARRANTY)}, True,
        ),
    ]


def forecast_rules() -> list[Rule]:
    """Older variant, one rule for the drive supplier's lines of any maker (APJ: the named maker's): forecast cost, half of it
    for old parts of the named maker; then the contract where still open."""
    age, maker = F.col("part_age"), S.is_named("repair_oem_name", R.DRIVE_MAKER)
    west = _west() & S.is_named("l2_supplier", R.DRIVE_SUPPLIER) & _flag("IW Credit")
    apj = (F.col("region") == "APJ") & S.is_named("l2_supplier", R.DRIVE_MAKER) & _flag("IW Credit")
    unknown = age.isNull() | S.is_blank("ct_code_label")

    def forecast(scope, of_maker):
        aged = F.coalesce(of_maker & (age > R.AGE_LIMIT), F.lit(False))
        value = F.when(aged, F.col("nb_named_avg") * R.AGED_FACTOR * -1.0).otherwise(_minus("nb_named"))
        blank = F.coalesce(of_maker & unknown, F.lit(False))
        return Rule(scope & _has("nb_named"), {
            "credits": value, "credit_comments": F.when(blank, F.lit(_FORECAST_BLANK)).otherwise(F.lit(_FORECAST))})

    return [
        forecast(west, maker), forecast(apj, F.lit(True)),
        Rule((west | apj) & _has("iw_named") & S.is_null_or_zero("credits"), {
            "credits": _minus("iw_named"), "credit_comments": F.lit(_IN_WARRANTY)}, True),
    ]


def kitting_fee(lines: DataFrame, fees: DataFrame, period: str, maker_credits: bool = True) -> DataFrame:
    """Add the month's average kitting fee: to forecast credits of the named maker, or, in the older variant, to all in-warranty
    lines of the drive supplier, which are then commented as a supplier credit."""
    if maker_credits:
        scope = S.is_named("l2_supplier", R.DRIVE_MAKER) & F.col("credit_comments").isin(_FORECAST, _FORECAST_BLANK)
    else:
        scope = S.is_named("l2_supplier", R.DRIVE_SUPPLIER)
    current = fees.filter(F.col("data_period") == period).select("region", "month", "avg_kitting_fee")
    values = {"credits": S.zero("credits") + F.col("src_avg_kitting_fee").cast("double")}
    if not maker_credits:
        values["credit_comments"] = F.lit(_SUPPLIER)
    return merge_update(
        _ready(lines), current, {"region": "region", "month": "master_event_activity_month"}, values, where=scope & _flag("IW Credit")
    )


def other_maker_rules() -> list[Rule]:
    """Drives of other makers: forecast, then contract; APJ has its own list of suppliers."""
    west = _west() & S.is_named("l2_supplier", R.DRIVE_SUPPLIER) & ~S.is_named("repair_oem_name", R.DRIVE_MAKER)
    apj = (F.col("region") == "APJ") & S.is_named("l2_supplier", *R.APJ_DRIVE_SUPPLIERS)
    warranty = {"credits": _minus("iw_org"), "credit_comments": F.lit(_IN_WARRANTY)}
    return [
        Rule(west & _flag("IW Credit") & _has("nb_org"), {"credits": _minus("nb_org"), "credit_comments": F.lit(_FORECAST)}),
        Rule(west & _flag("IW Credit") & _has("iw_org") & S.is_null_or_zero("credits"), warranty, True),
        Rule(apj & _flag("IW Credit") & _has("iw_org"), warranty),
    ]


def all_other_rules(maker_credits: bool = True) -> list[Rule]:
    """Every other named supplier: in-warranty and out-of-warranty contract averages.

    In the older variant only the drive supplier is named, and the maker in APJ in warranty; out of warranty holds in all regions.
    """
    supplier, apj = F.col("l2_supplier"), F.col("region") == "APJ"
    if maker_credits:
        named = {"iw": R.APJ_NAMED_SUPPLIERS, "oow": R.APJ_NAMED_SUPPLIERS}
        elsewhere = {"iw": _west(), "oow": _west()}
    else:
        named = {"iw": (R.DRIVE_SUPPLIER, R.DRIVE_MAKER), "oow": (R.DRIVE_SUPPLIER,)}
        elsewhere = {"iw": _west(), "oow": ~apj}
    return [
        Rule(
            ((elsewhere[name] & ~S.is_named(supplier, R.DRIVE_SUPPLIER)) | (apj & ~S.is_named(supplier, *named[name])))
            & ~S.name_starts(supplier, "PCG") & _flag(flag) & _has(name),
            {"credits": _minus(name), "credit_comments": F.lit(_SUPPLIER)})
        for name, flag in (("iw", "IW Credit"), ("oow", "OOW Credit"))
    ]


def contract_credits(lines: DataFrame, averages: DataFrame, fees: DataFrame, period: str, maker_credits: bool = True) -> DataFrame:
    """All contract credits in order, on one join with the averages."""
    columns = _ready(lines).columns
    forecast = age_credit_rules() if maker_credits else forecast_rules()
    lines = rule_cascade(_attach(lines, averages), contract_fallback_rules() + forecast)
    lines = kitting_fee(lines, fees, period, maker_credits)
    rest = other_maker_rules() if maker_credits else []
    return rule_cascade(lines, rest + all_other_rules(maker_credits)).select(*columns)


def apply_average_rules(lines: DataFrame, averages: DataFrame, rules: list[Rule]) -> DataFrame:
    columns = _ready(lines).columns
    return rule_cascade(_attach(lines, averages), rules).select(*columns)


def orphan_credit(
    lines: DataFrame, orphans: DataFrame, period: str, sums_from: DataFrame | None = None
) -> DataFrame:
    """Orphan receipts of a region over its non-returned lines: defective by value, good by standard."""
    current = orphans.filter(F.col("data_period") == period)
    lost = _flag("Non Return") & outside_excluded()
    valued = S.has_amount("event_pn_rvs")
    used = lost & (F.col("dmr_status") == "No DMR") & (F.col(QTY) > 0)
    value = F.col("event_pn_rvs") * F.col(QTY)
    lines = allocate_pool(
        _ready(lines), Pool(current, {"region": "region"}, "orphan_receipt_at_dv", few=True), value, "credits",
        base=used & valued, target=used, extra={"credit_comments": F.lit("Def Orphan Receipt Credit")},
        sums_from=sums_from,
    )
    unused = lost & (F.col(QTY) == 0) & valued
    return allocate_pool(
        lines, Pool(current, {"region": "region"}, "orphan_receipt_at_fg", few=True), "event_pn_rvs", "credits",
        base=unused, extra={"credit_comments": F.lit("Good Orphan Receipt Credit")}, sums_from=sums_from,
    )


def cid_credit(lines: DataFrame) -> DataFrame:
    """APJ lines with a supplier CID take the RMA credit."""
    scope = (F.col("region") == "APJ") & (F.col("rma_cid") == "Y") & _flag(*R.CREDIT_FLAGS)
    return rule_cascade(_ready(lines), [Rule(scope, {
        "credits": F.col("rma_credit").cast("double") * -1.0, "credit_comments": F.lit("Supplier CID Credit"),
    })])
