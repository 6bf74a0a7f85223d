"""Link lines to repairs, distribution-centre returns and RMA credits by flow tag."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost import rules as R
from sparecost.functions import semantics as S
from sparecost.operators import SALT, hot_keys, latest_per_key, merge_update, replicated, salted, with_spread

TAG_KEY = "tag_key"
KEY = "unique_link_key"


def tag_in_use(column="repair_tag_used") -> Column:
    """Lines that were not set aside as an older repair of the same tag."""
    return S.not_value(column, "N")


# ---- repairs ----------------------------------------------------------------------

def usable_repairs(repairs: DataFrame, period: R.Period) -> DataFrame:
    return repairs.filter(
        F.col("record_status").isin(*R.REPAIR_STATUSES)
        & (F.col("upload_date") < F.to_timestamp(F.lit(period.repair_cutoff)))
        & S.is_repair_tag("flow_tag")
    )


def _repair_values() -> dict:
    return {
        "repair_vendor": F.col("vendor_name"),
        "repair_flow_tag": S.normalise_tag("flow_tag"),
        "repair_oem_name": F.col("oem_name"),
        "repair_disposition": F.col("final_disposition"),
        "repair_warranty_status": F.col("warranty_vendor"),
        "repair_upload_month": S.year_month("upload_date"),
        "repair_upload_date": F.col("upload_date"),
    }


def _newest(repairs: DataFrame) -> DataFrame:
    return latest_per_key(repairs, ["flow_tag"], ["upload_date"], ["repair_id"])


def clean_repairs(repairs: DataFrame, period: R.Period, months: tuple[str, str] | None = None) -> DataFrame:
    """The newest usable repair of each tag, without a link to lines."""
    wanted = repairs.filter(F.col("record_status").isin(*R.REPAIR_STATUSES) & S.is_repair_tag("flow_tag"))
    if months is not None:
        wanted = wanted.filter(F.col("upload_month").between(*months))
    return _newest(wanted).select(
        "flow_tag", "repair_id", *[v.alias(k) for k, v in _repair_values().items()]
    )


def _winners(lines: DataFrame) -> DataFrame:
    """The one line per tag that keeps the tag's repair: the smallest link key."""
    return lines.filter(F.col("flow_tag").isNotNull()).groupBy("flow_tag").agg(F.min(KEY).alias("winner"))


def _turnaround() -> Column:
    return S.days_between("phy_part_no_rec_date", "repair_upload_date")


def repair_link(lines: DataFrame, repairs: DataFrame, period: R.Period, hot_rows: int = 1_000_000, slots: int = 64) -> DataFrame:
    """All repairs of every line's tag; the newest repair of a tag is in use once ('Y'), the rest is not.

    The result has lines x repairs rows of a tag. Tags of `hot_rows` lines or more have their lines dealt over `slots` parts,
    each of which meets a copy of the tag's repairs; so neither one task nor a wider copy of all repairs is needed.
    """
    wanted = usable_repairs(repairs, period)
    newest = _newest(wanted).select("flow_tag", F.col("repair_id").alias("newest_id"))
    hot = hot_keys(lines, "flow_tag", hot_rows)
    found = replicated(wanted.join(newest.join(_winners(lines), "flow_tag", "left"), "flow_tag"), "flow_tag", hot, slots).select(
        F.col("flow_tag").alias(TAG_KEY), SALT, "repair_id", *[v.alias(k) for k, v in _repair_values().items()],
        "newest_id", "winner",
    )
    tagged = with_spread(salted(lines, "flow_tag", hot, slots, KEY), "flow_tag", TAG_KEY).join(found, [TAG_KEY, SALT], "left")
    used = (F.col("repair_id") == F.col("newest_id")) & (F.col(KEY) == F.col("winner"))
    return (
        tagged.withColumn("repair_tag_used", F.when(F.col("repair_id").isNotNull(), F.when(used, "Y").otherwise("N")))
        .withColumn("repair_tat", _turnaround())
        .drop("newest_id", "winner", TAG_KEY, SALT)
    )


def latest_repair(lines: DataFrame, repairs: DataFrame, period: R.Period) -> DataFrame:
    """Lines with the newest repair of their tag; of lines that share a repaired tag one survives.

    Repairs and lines are both cut to one row per tag before they meet, so a tag with many lines
    and many repairs never forms their product. The spread tag key stays for the joins that follow.
    """
    newest = _newest(usable_repairs(repairs, period))
    found = newest.join(_winners(lines), "flow_tag", "inner").select(
        F.col("flow_tag").alias(TAG_KEY), *[v.alias(k) for k, v in _repair_values().items()], "winner"
    )
    linked = with_spread(lines, "flow_tag", TAG_KEY).join(found, TAG_KEY, "left")
    return (
        linked.filter(F.col("winner").isNull() | (F.col("winner") == F.col(KEY)))
        .withColumn("repair_tag_used", F.when(F.col("winner").isNotNull(), F.lit("Y")))
        .withColumn("repair_tat", _turnaround())
        .drop("winner")
    )


def clean_part_numbers(lines: DataFrame) -> DataFrame:
    return lines.withColumns({
        c: S.hyphenate(c) for c in ("received_part_kit_part_number", "physical_part_number")
    })


# ---- distribution-centre returns ----------------------------------------------------

def latest_return(dc_returns: DataFrame, period: R.Period) -> DataFrame:
    wanted = dc_returns.filter(
        (F.col("disp_location") != R.UNKNOWN_LOCATION) & (F.col("report_month") <= period.return_cutoff_month)
    )
    return latest_per_key(wanted, ["flow_tag"], ["report_month", "change_date"], _rest(wanted))


def _rest(df: DataFrame) -> list[str]:
    """Every column, so that rows tied on the order are told apart by content and not by chance."""
    return sorted(c for c in df.columns if c != "flow_tag")


def link_returns(lines: DataFrame, dc_returns: DataFrame, period: R.Period) -> DataFrame:
    """Attach the tag's return where its spare matches the kit part, else its part the physical part.

    A tag has one return row, so both passes read the same row and one join serves them.
    """
    fits = (F.col("src_spare_no") == F.col("received_part_kit_part_number")) | (
        F.col("src_recvd_part") == F.col("physical_part_number")
    )
    region = F.col("region")
    fits = F.coalesce(fits, F.lit(False)) & region.isin("APJ", "EMEA") & tag_in_use()
    values = {
        "dcr_received_plant": F.col("src_rcvg_plant"),
        "dcr_disposition": F.when(region == "APJ", F.col("src_disp_location")).otherwise(F.col("src_disposition")),
        "dcr_report_month": F.col("src_report_month"),
        "dcr_vendor_id": F.col("src_fl_vendor_id"),
        "dcr_vendor_name": F.col("src_fl_vendor_name"),
    }
    return merge_update(
        lines, latest_return(dc_returns, period), by_tag(lines), {k: F.when(fits, v) for k, v in values.items()},
        on_duplicate="unique",
    )


# ---- RMA credits ----------------------------------------------------------------------

def latest_rma(rma: DataFrame, period: R.Period) -> DataFrame:
    wanted = rma.filter(S.year_month("container_release") <= period.rma_cutoff_month)
    return latest_per_key(wanted, ["flow_tag"], ["container_release"], _rest(wanted))


def link_rma(lines: DataFrame, rma: DataFrame, period: R.Period) -> DataFrame:
    """Attach the tag's RMA row to APJ lines at the hub, by kit part and else by physical part."""
    at_hub = F.coalesce("dcr_received_plant", "received_plant") == R.HUB_PLANT
    fits = (F.col("src_part_number") == F.col("received_part_kit_part_number")) | (
        F.col("src_part_number") == F.col("physical_part_number")
    )
    fits = F.coalesce(fits, F.lit(False)) & (F.col("region") == "APJ") & tag_in_use() & F.coalesce(at_hub, F.lit(False))
    values = {
        "rma_cid": F.col("src_cid"),
        "rma_credit": S.money("src_actual_credit"),
        "rma_disposition": F.col("src_disposition"),
        "rma_vendor_id": F.col("src_vendor_code"),
        "rma_vendor_name": F.col("src_vendor_name"),
        "rma_engineer_approval": F.col("src_engineer_approval"),
        "rma_nff_results": F.col("src_nff_results"),
        "rma_release_month": S.year_month("src_container_release"),
    }
    return merge_update(
        lines, latest_rma(rma, period), by_tag(lines), {k: F.when(fits, v) for k, v in values.items()},
        on_duplicate="unique",
    )


def pick_hub_values(lines: DataFrame) -> DataFrame:
    """Plant and disposition of APJ lines: return before event plant; RMA, repair, return in this order."""
    apj = F.col("region") == "APJ"
    return lines.withColumns({
        "hub_received_plant": F.when(apj, F.coalesce("dcr_received_plant", "received_plant")),
        "hub_disposition": F.when(apj, F.coalesce("rma_disposition", "repair_disposition", "dcr_disposition")),
    })


def override_repairs(lines: DataFrame, patches: dict) -> DataFrame:
    """Correct repair disposition and warranty by tag.

    patches: {region: [patch tables, later ones win]}; the tables of a region are stacked first so
    that each region costs one join.
    """
    given, lines = lines, with_tag_key(lines)
    for region, tables in patches.items():
        ranked = [t.select("flow_tag", "repair_disposition", "repair_warranty_status", F.lit(i).alias("turn"))
                  for i, t in enumerate(tables)]
        stacked = latest_per_key(
            reduce(DataFrame.unionByName, ranked), ["flow_tag"], ["turn"],
            ["repair_disposition", "repair_warranty_status"],
        )
        lines = merge_update(
            lines, stacked.drop("turn"), by_tag(lines),
            {"repair_disposition": "repair_disposition", "repair_warranty_status": "repair_warranty_status"},
            where=F.col("region") == region, on_duplicate="unique"
        )
    return as_given(lines, given)


def with_tag_key(lines: DataFrame) -> DataFrame:
    """Lines with the spread tag key, or those without a tag would meet in one task."""
    return lines if TAG_KEY in lines.columns or KEY not in lines.columns else with_spread(lines, "flow_tag", TAG_KEY)


def as_given(result: DataFrame, lines: DataFrame) -> DataFrame:
    """Without the tag key, where the lines had none."""
    return result if TAG_KEY in lines.columns else result.drop(TAG_KEY)


def by_tag(lines: DataFrame) -> dict:
    """Join on the tag: the spread key where the link stage has made it."""
    return {"flow_tag": TAG_KEY if TAG_KEY in lines.columns else "flow_tag"}


def link(lines: DataFrame, repairs: DataFrame, dc_returns: DataFrame, rma: DataFrame, patches: dict,
         period: R.Period) -> DataFrame:
    """The whole linking stage; every join is by the tag key, so lines are shuffled once."""
    lines = clean_part_numbers(latest_repair(lines, repairs, period))
    lines = link_returns(lines, dc_returns, period)
    lines = pick_hub_values(link_rma(lines, rma, period))
    return override_repairs(lines, patches)
