"""Event base: the service lines of a period with part, product line and return data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost import rules as R
from sparecost.functions import semantics as S
from sparecost.operators import unique_source, with_spread

_PICKED = {
    "received_month": "received_month",
    "phy_part_no_rec_date": "phy_part_no_rec_date",
    "flow_tag": "flow_tag_number",
    "actual_disposition": "actual_disposition",
    "ct_code_label": "received_part_serial_number",
    "received_plant": "received_plant_id",
}
_DATES = {"phy_part_no_rec_date"}
_PLAIN = (
    "notification_type_a", "received_part_kit_part_number", "physical_part_number", "part_qty_received",
    "match_fl", "sn_transaction_status", "sales_doc_type", "sales_document",
)


def receipt_type(key="l2_reverse_unique_link_key", a="actual_disposition_a", b="actual_disposition_b") -> Column:
    """No return row, a logical receipt (code in A, nothing in B), or a physical one."""
    return (
        F.when(S.is_blank(key), F.lit(R.NO_RECEIPT))
        .when((F.col(a) == R.LOGICAL_CODE) & S.is_blank(b), F.lit(R.LOGICAL_RECEIPT))
        .otherwise(F.lit(R.PHYSICAL_RECEIPT))
    )


def return_columns(returns: DataFrame) -> DataFrame:
    """One value per return attribute: B where it is filled, else A."""
    picked = []
    for out, stem in _PICKED.items():
        a, b = F.col(f"{stem}_a"), F.col(f"{stem}_b")
        value = F.coalesce(b, a) if out in _DATES else S.pick_b_over_a(b, a)
        picked.append(value.alias(out))
    return returns.select(
        "unique_link_key",
        F.col("unique_link_key").alias("l2_reverse_unique_link_key"),
        *picked,
        receipt_type("unique_link_key").alias("receipt_type"),
        *_PLAIN,
    )


def in_scope() -> Column:
    """Wanted source systems, outside the excluded region and country, with a demanded quantity."""
    return (
        F.col("source_system").isin(*R.SOURCE_SYSTEMS)
        & ~((F.col("region") == R.EXCLUDED_REGION) | (F.col("event_country_iso_cd") == R.EXCLUDED_COUNTRY))
        & ~(F.col("part_qty_demanded") == 0)
    )


def event_base(
    events: DataFrame,
    part_master: DataFrame,
    product_lines: DataFrame,
    returns: DataFrame,
    activity: DataFrame,
    period: R.Period,
) -> DataFrame:
    """Filter the events of the period and attach part, product line (two roles) and return columns.

    Events, returns and activity costs share the link key: their joins use one partitioning. A part or a product line that
    a master has twice fails the job, as it would double lines.
    """
    lines = events.filter(
        F.col("master_event_activity_month").between(period.start_month, period.end_month) & in_scope()
    )
    hwpl = unique_source(product_lines.filter(F.col("hwpl").isNotNull()).select("hwpl", "spl"), ["hwpl"])
    parts = unique_source(part_master.filter(F.col("material").isNotNull()).select(
        F.col("material").alias("part_number"), "region", "hw_prod_line", "part_commodity",
        F.col("material_description").alias("part_description"),
    ), ["part_number", "region"])
    costs = activity.select("unique_link_key", F.col("event_spl").alias("sc_spl"))
    found = return_columns(returns)
    # events without a part are spread, or they would meet in one partition of the join with the part master
    lines = with_spread(lines, "part_number", "part_key")
    parts = parts.withColumnRenamed("part_number", "part_key")
    joined = (
        lines.join(found, "unique_link_key", "left")
        .join(costs, "unique_link_key", "left")
        .join(parts, ["part_key", "region"], "left")
        .join(hwpl.select(F.col("hwpl").alias("hw_prod_line"), F.col("spl").alias("part_spl")), "hw_prod_line", "left")
        .join(hwpl.select(F.col("hwpl").alias("event_hwpl"), F.col("spl").alias("event_spl")), "event_hwpl", "left")
    )
    return joined.withColumn("receipt_type", F.coalesce("receipt_type", F.lit(R.NO_RECEIPT))).withColumn(
        "data_period", F.lit(period.period)
    ).drop("hw_prod_line", "part_key")


def refresh_returns(lines: DataFrame, returns: DataFrame, period: str) -> DataFrame:
    """Renew the return columns of one period; lines without a return row lose theirs.

    One row out per line: two return rows for one key fail the job. Returns without a key meet no line.
    """
    found = unique_source(return_columns(returns.filter(F.col("unique_link_key").isNotNull())), ["unique_link_key"])
    values = {c: c for c in found.columns if c != "unique_link_key"}
    values["receipt_type"] = F.coalesce(F.col("src_receipt_type"), F.lit(R.NO_RECEIPT))
    scope = F.col("data_period") == period
    joined = lines.alias("l").join(
        found.select("unique_link_key", *[F.col(c).alias(f"src_{c}") for c in values]), "unique_link_key", "left"
    )
    new = {c: F.col(f"src_{c}") if isinstance(v, str) else v for c, v in values.items()}
    return joined.select(
        *[F.when(scope, new[c]).otherwise(F.col(f"l.{c}")).alias(c) if c in new else F.col(c) for c in lines.columns]
    )


def adjustment_feed(adjustments: DataFrame) -> DataFrame:
    return adjustments.select("unique_link_key", "amid2_adj")


def shipment_lines(shipments: DataFrame, events: DataFrame, period: R.Period) -> DataFrame:
    """Shipments of the listed document types, with the service level of their event."""
    wanted = shipments.filter(F.col("so_po_document_type").isin(*R.SHIPMENT_DOCUMENT_TYPES))
    lines = events.filter(F.col("master_event_activity_month").between(period.start_month, period.end_month))
    return wanted.join(unique_source(lines.select("unique_link_key", "part_actual_sl"), ["unique_link_key"]),
                       "unique_link_key", "inner")
