"""Inventory model: revaluation and reserve true-up allocated over an inventory snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost import rules as R
from sparecost.functions import semantics as S
from sparecost.operators import merge_update
from sparecost.session import stage_end

GROUP = ["support_product_line", "region_l2"]


def in_scope() -> Column:
    return (F.col("source") != R.INVENTORY_EXCLUDED_SOURCE) & (F.col("country") != R.INVENTORY_EXCLUDED_COUNTRY)


def region_l2() -> Column:
    return (
        F.when(F.col("region") == "APJ", F.lit("APJeC")).when(F.col("region") == "EMEA", F.lit("EMEA"))
        .when(F.col("country").isin(*R.NORTH_AMERICA), F.lit("NA")).otherwise(F.lit("LA"))
    )


def snapshot(stock: DataFrame) -> DataFrame:
    """Start of quarter: value and reserve per place, with the derived region, area and types."""
    location_type = F.substring("location", 1, 2)
    event = location_type.isin(*R.EVENT_LOCATION_TYPES) | ((F.col("location") == "#") & (F.col("condition") == "Good"))
    keys = ["region", "support_product_line", "subregion", "region_l2", "type", "country", "plant", "location",
            "condition", "inv_type"]
    derived = stock.filter(in_scope()).withColumns({
        "region_l2": region_l2(), "inv_type": F.when(event, F.lit("Event")).otherwise(F.lit("Non Event")),
    })
    return (
        derived.groupBy(*keys)
        .agg(S.exact_sum("value_current").alias("value_current"), S.exact_sum("reserve_current").alias("reserve_start"))
        .withColumns({
            "mrp_area": F.concat("plant", "location"), "location_type": location_type,
            "location_type_condition": F.concat(location_type, F.lit("-"), F.col("condition")),
        })
    )


def group_value(stock: DataFrame) -> DataFrame:
    return (
        stock.filter(in_scope()).withColumn("region_l2", region_l2()).groupBy(*GROUP)
        .agg(S.exact_sum("value_current").alias("group_value"))
    )


def end_reserve(stock: DataFrame) -> DataFrame:
    return (
        stock.filter(in_scope()).withColumn("mrp_area", F.concat("plant", "location"))
        .groupBy("mrp_area", "support_product_line", "condition")
        .agg(S.exact_sum("reserve_current").alias("reserve_end"))
    )


def allocation_key(places: DataFrame, reserves: DataFrame, special_keys: DataFrame) -> DataFrame:
    """Attach the end reserve and the key: a special key of the area, else sub-region and type."""
    places = merge_update(
        places, reserves, ["mrp_area", "support_product_line", "condition"], {"reserve_end": "reserve_end"},
        unmatched="null", on_duplicate="unique",
    )
    places = merge_update(
        places, special_keys.select("inv_plant_location", "special_alloc_key"), {"inv_plant_location": "mrp_area"},
        {"special_alloc_key": "special_alloc_key"}, unmatched="null"
    )
    plain = F.concat("subregion", F.lit("-"), F.col("type"))
    return places.withColumn("allocation_key", F.coalesce("special_alloc_key", plain))


def share(part: str, whole: str) -> Column:
    """part of whole; 0 where the whole is 0, null where it is null."""
    return F.when(F.col(whole) != 0, F.col(part) / F.nullif(F.col(whole), F.lit(0.0))).when(F.col(whole) == 0, F.lit(0.0))


def _cube(places: DataFrame, cube: DataFrame, kind: str, out: str) -> DataFrame:
    costs = cube.filter(F.col("type") == kind).select("region_l2", F.col("spl").alias("support_product_line"), "adj_cube")
    return merge_update(places, costs, ["region_l2", "support_product_line"], {out: F.col("src_adj_cube").cast("double")})


def with_group_totals(places: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """True-up (start less end reserve) per place, and value and true-up of its group, both totals from one aggregate.

    The totals are partial sums per task, so a group with very many places costs one row per task. stored: the same places
    as a stored stage, from which the totals are read; the stock itself is then scanned once.
    """
    def trued(df):
        df = df.withColumn("reserve_end", S.zero("reserve_end"))
        return df.withColumn("true_up", F.col("reserve_start") - F.col("reserve_end"))

    totals = trued(places if stored is None else stored).groupBy(*GROUP).agg(
        S.exact_sum("value_current").alias("group_value"), S.exact_sum("true_up").alias("group_true_up"))
    return merge_update(
        trued(places), totals, GROUP, {"group_value": "group_value", "group_true_up": "group_true_up"}, unmatched="null", on_duplicate="unique")


def revaluation(places: DataFrame, cube: DataFrame) -> DataFrame:
    """Standard revaluation of a group over its places by value."""
    return _cube(places.withColumn("std_rev_share", share("value_current", "group_value")), cube, R.REVALUATION_COST, "cube_std_rev").withColumn(
        "std_rev_usd", F.col("std_rev_share") * F.col("cube_std_rev")
    )


def reserve_true_up(places: DataFrame, cube: DataFrame) -> DataFrame:
    """Reserve cost of a group over its places by true-up."""
    return _cube(places.withColumn("true_up_share", share("true_up", "group_true_up")), cube, R.RESERVE_COST, "cube_reserve").withColumn(
        "true_up_usd", F.col("true_up_share") * F.col("cube_reserve")
    )


def inventory_model(
    start: DataFrame, end: DataFrame, special_keys: DataFrame, cube: DataFrame
) -> DataFrame:
    """Both allocations over the snapshot. Its places are stored once: the group totals and the shares read them, not the stock."""
    places = stage_end(allocation_key(snapshot(start), end_reserve(end), special_keys))
    return reserve_true_up(revaluation(with_group_totals(places), cube), cube)
