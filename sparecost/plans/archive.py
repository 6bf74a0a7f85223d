"""Archive of a costed quarter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparecost.sources import Published

# fixed value: the output layout
ARCHIVE_COLUMNS = (
    "unique_link_key", "master_event_activity_month", "source_system", "region", "master_event_number",
    "event_number", "event_country_iso_cd", "part_qty_demanded", "event_hwpl", "part_number", "part_actual_sl",
    "part_shipment_month", "part_qty_consumed", "so_item", "dmr_status", "event_spl", "sc_spl", "part_spl",
    "part_spl_desc", "part_commodity", "part_description", "warranty_flag", "l2_reverse_unique_link_key",
    "received_month", "phy_part_no_rec_date", "flow_tag", "actual_disposition", "notification_type_a",
    "receipt_type", "ct_code_label", "mfg_date", "part_age", "received_part_kit_part_number",
    "physical_part_number", "part_qty_received", "received_plant", "match_fl", "sn_transaction_status",
    "sales_doc_type", "sales_document", "repair_vendor", "repair_flow_tag", "repair_tag_used", "repair_oem_name",
    "repair_disposition", "repair_warranty_status", "repair_upload_date", "repair_upload_month", "repair_tat",
    "dcr_received_plant", "dcr_disposition", "dcr_report_month", "dcr_vendor_id", "dcr_vendor_name",
    "hub_received_plant", "hub_disposition", "rma_cid", "rma_credit", "rma_disposition", "rma_vendor_id",
    "rma_vendor_name", "rma_engineer_approval", "rma_nff_results", "rma_release_month", "l1_supplier",
    "l1_supplier_source", "l2_supplier", "supplier_type", "final_disp_flag", "cons_cost", "di_cost", "di_credit",
    "oow_avg_repair_cost", "oow_iw_avg_repair_cost", "avg_above_standard", "cons_cost_notes", "esc_variance",
    "def_scrap_cost", "nppo_cost", "event_pn_rvs", "event_pn_nrs", "kit_pn_rvs", "physical_pn_rvs",
    "physical_pn_nrs", "physical_pn_nbs", "relabel_cost", "dekit_cost", "relabel_cost_comment",
    "dekit_cost_comment", "credits", "credit_comments", "cons_cost_at_std", "country_inv_costs",
    "region_inv_costs", "total_inv_costs", "total_matl_cost", "total_matl_inv_cost", "taxes", "non_event_cost",
)


PERIOD_COLUMN = "data_period"


def archive_period(lines: DataFrame, history: Published, period: str, as_text: Iterable[str] = ()) -> int:
    """Replace the period in the history, in one commit. as_text: columns that an older layout keeps as text.

    Each period keeps the layout it was written in; `read_history` brings them together. Returns the number of rows.
    """
    as_text = set(as_text)
    wanted = lines.select(*[lines[c].cast("string").alias(c) if c in as_text else lines[c] for c in ARCHIVE_COLUMNS])
    # one value, so a task writes one file and the lines need no shuffle
    return history.replace(wanted.withColumn(PERIOD_COLUMN, F.lit(period)), [period], spread=False)


def read_history(history: Published, schema: T.StructType | None = None) -> DataFrame:
    """All periods as one table in the types of the newest layout, or in those given.

    Text of an older layout is cast; a value that does not fit fails the job. A column that an older layout lacks is null.
    """
    return history.read(schema=schema)
