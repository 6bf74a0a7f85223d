"""Checks beside the model: consumption by quarter, accounting comparison, duplicates, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecost import rules as R
from sparecost.functions import semantics as S
from sparecost.operators import merge_update
from sparecost.plans.link import usable_repairs


def consumption_check(events: DataFrame, product_lines: DataFrame, first_month: str = "201511") -> DataFrame:
    """Consumed quantity by region, month, fiscal quarter and product line, ready for accounting's."""
    hwpl = product_lines.select(F.col("hwpl").alias("event_hwpl"), "spl")
    wanted = events.filter(
        (F.col("master_event_activity_month") >= first_month) & F.col("source_system").isin(*R.SOURCE_SYSTEMS)
        & (F.col("region") != R.EXCLUDED_REGION) & (F.col("event_country_iso_cd") != R.EXCLUDED_COUNTRY)
        & ~(F.col("part_qty_demanded") == 0)
    )
    return (
        wanted.join(hwpl, "event_hwpl", "left")
        .groupBy("region", F.col("master_event_activity_month").alias("month"), F.col("spl").alias("event_spl"))
        .agg(F.sum("part_qty_consumed").cast("long").alias("cons_qty"))
        .withColumns({
            "qtr": S.fiscal_quarter_label("month"), "spl_in_accounting": F.lit(None).cast("string"),
            "cons_qty_in_accounting": F.lit(None).cast("long"),
        })
    )


def reconcile(check: DataFrame, accounting: DataFrame, months: DataFrame) -> DataFrame:
    """Set accounting's quantity next to ours; months maps accounting's month names."""
    mapped = accounting.join(
        months.select(F.col("column_name").alias("month"), "month_transformed"), "month"
    ).select("region", F.col("month_transformed").alias("month"), "spl", F.col("cons_qty").alias("qty"))
    return merge_update(
        check, mapped.withColumn("name", F.col("spl")), {"region": "region", "month": "month", "spl": "event_spl"},
        {"spl_in_accounting": "name", "cons_qty_in_accounting": F.col("src_qty").cast("long")},
    )


def duplicate_tags(lines: DataFrame, repairs: DataFrame, period: R.Period) -> DataFrame:
    """Rows of the repair link per region whose normalised tag occurs more than once there.

    Only counts meet: a tag contributes lines x repairs rows, so the link itself is not made and a tag in very many lines or
    repairs is one row.
    """
    held = lines.filter(F.col("flow_tag").isNotNull()).groupBy("flow_tag", "region").agg(F.count(F.lit(1)).alias("lines"))
    found = usable_repairs(repairs, period).groupBy("flow_tag").agg(F.count(F.lit(1)).alias("repairs"))
    linked = held.join(found, "flow_tag").groupBy(S.normalise_tag("flow_tag").alias("tag"), "region").agg(
        F.sum(F.col("lines") * F.col("repairs")).alias("n"))
    repeated = linked.groupBy("tag").agg(F.sum("n").alias("all")).filter(F.col("all") > 1).select("tag")
    return linked.join(repeated, "tag", "left_semi").groupBy("region").agg(F.sum("n").alias("duplicate_records"))


def event_check(events: DataFrame, part_master: DataFrame, product_lines: DataFrame, activity: DataFrame,
                month_range: tuple[str, str] | None = None) -> DataFrame:
    """Events with part, product line and activity columns.

    Without a month range the scope tests belong to the last join, so that no event is dropped and
    only the activity column of events out of scope is empty. With a range they filter the events.
    """
    hwpl = product_lines.select(F.col("hwpl").alias("event_hwpl"), F.col("spl").alias("event_spl"))
    parts = part_master.select(
        F.col("material").alias("part_number"), "region", "part_commodity",
        F.col("material_description").alias("part_description"),
    )
    scope = (
        F.col("source_system").isin(*R.SOURCE_SYSTEMS) & (F.col("region") != R.EXCLUDED_REGION)
        & ~(F.col("part_qty_demanded") == 0)
    )
    if month_range is not None:
        events = events.filter(F.col("master_event_activity_month").between(*month_range) & scope)
    joined = events.join(parts, ["part_number", "region"], "left").join(hwpl, "event_hwpl", "left")
    costs = activity.select(F.col("unique_link_key").alias("cost_key"), F.col("event_spl").alias("sc_spl"))
    on = joined["unique_link_key"] == costs["cost_key"]
    return joined.join(costs, on if month_range is not None else on & scope, "left").drop("cost_key")


def event_preview(checked: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows by link key; each task keeps its own first rows, so nothing large is sorted."""
    return checked.orderBy("unique_link_key").limit(rows)


def not_in(df: DataFrame, column: str, excluded: DataFrame, name: str) -> DataFrame:
    """Rows whose value is not in a list: rows with a null value drop, nulls in the list are ignored."""
    values = excluded.select(F.col(name).alias("__v")).filter(F.col("__v").isNotNull())
    return df.filter(F.col(column).isNotNull()).join(values, F.col(column) == F.col("__v"), "left_anti")
