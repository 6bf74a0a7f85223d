"""The same results as plain SQL for the checking database.

A step takes the name of a relation of lines and returns a SELECT with the step applied, so steps can
be checked one by one and chained into the whole run. The SQL goes statement by statement (one join
per source, ranks over joined rows), other than the plans it checks.
"""

from __future__ import annotations

from sparecost.testbed.standins import COST_MONTH, PERIOD, PREVIOUS, ctes

P = f"'{PERIOD}'"
REGIONS3 = "('APJ','AME','EMEA')"
USED = "COALESCE(repair_tag_used <> 'N', TRUE)"
ABROAD = "event_country_iso_cd <> 'CN'"


def blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


def nz(c: str) -> str:
    return f"({c} IS NULL OR {c} = 0)"


def low(c: str, *names: str) -> str:
    return f"lower({c}) IN ({', '.join(repr(n.lower()) for n in names)})"


def dec(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(28,6))) AS DOUBLE)"


def mean(c: str) -> str:
    return f"{dec(c)} / NULLIF(COUNT({c}), 0)"


def ym(c: str) -> str:
    return f"strftime({c}, '%Y%m')"


def normal_tag(c: str) -> str:
    return (f"CASE WHEN {c} LIKE '%FT%' THEN substr({c}, strpos({c}, 'FT')) WHEN {c} LIKE '$T%' OR {c} LIKE '0T%' "
            f"THEN 'F' || substr({c}, 2) ELSE {c} END")


def updated(src: str, join: str, changes: dict[str, str], existing: bool = True) -> str:
    """Lines with columns changed from a joined source (alias b); new columns if not existing."""
    if existing:
        return f"SELECT a.* REPLACE ({', '.join(f'{v} AS {k}' for k, v in changes.items())}) FROM {src} a {join}"
    return f"SELECT a.*, {', '.join(f'{v} AS {k}' for k, v in changes.items())} FROM {src} a {join}"


def nested(src: str, *steps) -> str:
    """Apply steps one after the other as common table expressions."""
    parts, name = [], src
    for i, step in enumerate(steps[:-1]):
        parts.append(f"n{i}_{src} AS ({step(name)})")
        name = f"n{i}_{src}"
    last = steps[-1](name)
    return f"WITH {', '.join(parts)} {last}" if parts else last


# ---- base and link ------------------------------------------------------------------

RECEIPT = ("CASE WHEN r.unique_link_key IS NULL THEN 'No Receipt' WHEN r.actual_disposition_a = 'SC99' AND "
           + blank("r.actual_disposition_b") + " THEN 'Logical Receipt' ELSE 'Physical Receipt' END")


def b_over_a(stem: str) -> str:
    return f"CASE WHEN {blank(f'r.{stem}_b')} THEN r.{stem}_a ELSE r.{stem}_b END"


RETURN_COLUMNS = f"""r.unique_link_key AS l2_reverse_unique_link_key, {b_over_a('received_month')} AS received_month,
  COALESCE(r.phy_part_no_rec_date_b, r.phy_part_no_rec_date_a) AS phy_part_no_rec_date,
  {b_over_a('flow_tag_number')} AS flow_tag, {b_over_a('actual_disposition')} AS actual_disposition,
  {b_over_a('received_part_serial_number')} AS ct_code_label, {b_over_a('received_plant_id')} AS received_plant,
  r.notification_type_a, r.received_part_kit_part_number, r.physical_part_number, r.part_qty_received, r.match_fl,
  r.sn_transaction_status, r.sales_doc_type, r.sales_document, {RECEIPT} AS receipt_type"""

SCOPE = ("e.source_system IN ('SFDC','WFM-IM','CSN') AND NOT (e.region = 'China' OR e.event_country_iso_cd = 'CN') "
         "AND NOT e.part_qty_demanded = 0")
BASE = f"""SELECT e.*, h1.spl AS part_spl, h2.spl AS event_spl, c.event_spl AS sc_spl, p.part_commodity,
  p.material_description AS part_description, {P} AS data_period, {RETURN_COLUMNS}
FROM service_events e LEFT JOIN part_master p ON e.part_number = p.material AND e.region = p.region
LEFT JOIN product_lines h1 ON p.hw_prod_line = h1.hwpl LEFT JOIN product_lines h2 ON e.event_hwpl = h2.hwpl
LEFT JOIN returns r ON e.unique_link_key = r.unique_link_key LEFT JOIN activity c ON e.unique_link_key = c.unique_link_key
WHERE e.master_event_activity_month BETWEEN '199501' AND '200112' AND {SCOPE}"""

REPAIRS = """(SELECT * FROM repairs WHERE record_status IN ('Valid','Warning') AND upload_date < TIMESTAMP '2024-01-25 00:00:00'
  AND (flow_tag LIKE '%FT%' OR flow_tag LIKE '$T%' OR flow_tag LIKE '0T%'))"""
REPAIR_COLUMNS = f"""r.vendor_name AS repair_vendor, {normal_tag('r.flow_tag')} AS repair_flow_tag, r.oem_name AS repair_oem_name,
  r.final_disposition AS repair_disposition, r.warranty_vendor AS repair_warranty_status, {ym('r.upload_date')} AS repair_upload_month,
  r.upload_date AS repair_upload_date"""
RANKED = "row_number() OVER (PARTITION BY r.flow_tag ORDER BY r.upload_date DESC, r.repair_id DESC, a.unique_link_key)"


def repair_link(src: str) -> str:
    return f"""SELECT a.*, r.repair_id, {REPAIR_COLUMNS},
  CASE WHEN r.flow_tag IS NULL THEN NULL WHEN {RANKED} = 1 THEN 'Y' ELSE 'N' END AS repair_tag_used,
  date_diff('day', CAST(a.phy_part_no_rec_date AS DATE), CAST(r.upload_date AS DATE)) AS repair_tat
FROM {src} a LEFT JOIN {REPAIRS} r ON a.flow_tag = r.flow_tag"""


def latest_repair(src: str) -> str:
    return f"SELECT * EXCLUDE (repair_id) FROM ({repair_link(src)}) WHERE {USED}"


def clean_parts(src: str) -> str:
    return updated(src, "", {c: f"replace({c}, ' ', '-')" for c in ("received_part_kit_part_number", "physical_part_number")})


DCR = """(SELECT *, row_number() OVER (PARTITION BY flow_tag ORDER BY report_month DESC, change_date DESC, disp_location DESC,
  disposition DESC, fl_vendor_id DESC, fl_vendor_name DESC NULLS LAST, rcvg_plant DESC, recvd_part DESC, spare_no DESC) AS rn
  FROM dc_returns WHERE disp_location <> 'XXXX' AND report_month <= '200103')"""
DCR_COLUMNS = ("dcr_received_plant", "dcr_disposition", "dcr_report_month", "dcr_vendor_id", "dcr_vendor_name")


def link_returns(src: str) -> str:
    def one(part, mine, region, disposition, only_blank):
        hit = "b.rn IS NOT NULL"
        join = (f"LEFT JOIN {DCR} b ON b.rn = 1 AND a.flow_tag = b.flow_tag AND a.{mine} = b.{part} AND a.region = '{region}' "
                f"AND {USED}" + (f" AND {blank('a.dcr_disposition')}" if only_blank else ""))
        values = ("b.rcvg_plant", f"b.{disposition}", "b.report_month", "b.fl_vendor_id", "b.fl_vendor_name")
        return lambda s: updated(s, join, {c: f"CASE WHEN {hit} THEN {v} ELSE {c} END" for c, v in zip(DCR_COLUMNS, values)})

    empty = lambda s: f"SELECT *, {', '.join(f'CAST(NULL AS VARCHAR) AS {c}' for c in DCR_COLUMNS)} FROM {s}"
    passes = [one(part, mine, region, disposition, again)
              for again, part, mine in ((False, "spare_no", "received_part_kit_part_number"), (True, "recvd_part", "physical_part_number"))
              for region, disposition in (("APJ", "disp_location"), ("EMEA", "disposition"))]
    return nested(src, empty, *passes)


RMA = """(SELECT *, row_number() OVER (PARTITION BY flow_tag ORDER BY container_release DESC, actual_credit DESC, cid DESC,
  container_release DESC, disposition DESC NULLS LAST, engineer_approval DESC, nff_results DESC, part_number DESC, vendor_code DESC,
  vendor_name DESC) AS rn FROM rma WHERE strftime(container_release, '%Y%m') <= '200104')"""
RMA_COLUMNS = {
    "rma_cid": "b.cid", "rma_credit": "b.actual_credit", "rma_disposition": "b.disposition", "rma_vendor_id": "b.vendor_code",
    "rma_vendor_name": "b.vendor_name", "rma_engineer_approval": "b.engineer_approval", "rma_nff_results": "b.nff_results",
    "rma_release_month": "strftime(b.container_release, '%Y%m')",
}


def link_rma(src: str) -> str:
    def one(mine, only_blank):
        join = (f"LEFT JOIN {RMA} b ON b.rn = 1 AND a.flow_tag = b.flow_tag AND a.{mine} = b.part_number AND a.region = 'APJ' AND {USED} "
                f"AND COALESCE(a.dcr_received_plant, a.received_plant) = 'H499'" + (f" AND {blank('a.rma_disposition')}" if only_blank else ""))
        return lambda s: updated(s, join, {c: f"CASE WHEN b.rn IS NOT NULL THEN {v} ELSE a.{c} END" for c, v in RMA_COLUMNS.items()})

    def empty(s):
        kinds, varchar = {"rma_credit": "DECIMAL(19,4)"}, "VARCHAR"
        return f"SELECT *, {', '.join(f'CAST(NULL AS {kinds.get(c, varchar)}) AS {c}' for c in RMA_COLUMNS)} FROM {s}"

    return nested(src, empty, one("received_part_kit_part_number", False), one("physical_part_number", True))


def pick_hub(src: str) -> str:
    return f"""SELECT *, CASE WHEN region = 'APJ' THEN COALESCE(dcr_received_plant, received_plant) END AS hub_received_plant,
  CASE WHEN region = 'APJ' THEN COALESCE(rma_disposition, repair_disposition, dcr_disposition) END AS hub_disposition FROM {src}"""


def override(src: str) -> str:
    def one(table, region):
        return lambda s: updated(
            s, f"LEFT JOIN {table} b ON a.flow_tag = b.flow_tag AND a.region = '{region}'",
            {c: f"CASE WHEN b.flow_tag IS NOT NULL THEN b.{c} ELSE a.{c} END" for c in ("repair_disposition", "repair_warranty_status")})

    return nested(src, one("patches_ame", "AME"), one("patches_ame_b", "AME"), one("patches_emea", "EMEA"), one("patches_emea_b", "EMEA"))


# ---- suppliers --------------------------------------------------------------------------

def empty_suppliers(src: str) -> str:
    names = ("l1_supplier", "l1_supplier_source", "l2_supplier", "supplier_type")
    return f"SELECT *, {', '.join(f'CAST(NULL AS VARCHAR) AS {c}' for c in names)} FROM {src}"


def first_assignment(src: str) -> str:
    vendor = "COALESCE(a.rma_vendor_name, a.repair_vendor, a.dcr_vendor_name)"
    named = f"a.region = 'APJ' AND NOT {blank(vendor)}"
    return nested(
        src,
        lambda s: updated(s, "", {
            "l1_supplier": f"CASE WHEN {named} THEN {vendor} ELSE l1_supplier END",
            "l1_supplier_source": f"CASE WHEN {named} THEN 'RWT' ELSE l1_supplier_source END",
            "supplier_type": f"CASE WHEN {named} THEN 'Repair' ELSE supplier_type END"}),
        lambda s: updated(s, "LEFT JOIN plant_supplier b ON a.received_plant = b.received_plant AND a.region = b.region", {
            "l1_supplier": "CASE WHEN b.region IS NOT NULL THEN b.l1_supplier_name ELSE a.l1_supplier END",
            "l1_supplier_source": "CASE WHEN b.region IS NOT NULL THEN 'Received Plant' ELSE a.l1_supplier_source END",
            "supplier_type": "CASE WHEN b.region IS NOT NULL THEN b.supplier_type ELSE a.supplier_type END"}),
        lambda s: updated(
            s, "LEFT JOIN disposition_supplier b ON COALESCE(a.dcr_disposition, a.actual_disposition) = b.disposition AND a.region = b.region", {
                "l1_supplier": "CASE WHEN b.region IS NOT NULL THEN b.l1_supplier_name ELSE a.l1_supplier END",
                "l1_supplier_source": "CASE WHEN b.region IS NOT NULL THEN 'iReturns Disposition' ELSE a.l1_supplier_source END",
                "supplier_type": "CASE WHEN b.region IS NOT NULL THEN b.supplier_type ELSE a.supplier_type END"}),
    )


def corrected_assignment(src: str) -> str:
    """The first assignment with the type of APJ suppliers looked up after the supplier is set."""
    named = f"a.region = 'APJ' AND NOT {blank('COALESCE(a.rma_vendor_name, a.repair_vendor, a.dcr_vendor_name)')}"
    return updated(f"({first_assignment(src)})", "LEFT JOIN rfc_suppliers b ON a.l1_supplier = b.l1_supplier_name", {
        "supplier_type": f"CASE WHEN {named} AND a.l1_supplier_source = 'RWT' AND NOT {blank('b.supplier_type')} THEN b.supplier_type ELSE a.supplier_type END"})


def vendors_of(table: str, extra: str = "") -> str:
    return f"""(SELECT region, part, vendor_description AS vendor FROM (SELECT *, row_number() OVER (PARTITION BY region, part
  ORDER BY cost_change DESC, vendor_description DESC) AS rn FROM {table} WHERE data_period = {P} AND ((region = 'APJ' AND cost_type = 'C'
  AND plant = 'H499') OR (region = 'AME' AND cost_type = 'F' AND plant IN ('C299','C208','C212','C240')) OR (region = 'EMEA'
  AND cost_type = 'F' AND plant = 'AM02')) {extra}) WHERE rn = 1)"""


def _fill(table: str, part: str, label: str, region: str = ""):
    join = f"LEFT JOIN {table} b ON a.region = b.region AND a.{part} = b.part AND {blank('a.l1_supplier')} {region}"
    return lambda s: updated(s, join, {
        "l1_supplier": "CASE WHEN b.part IS NOT NULL THEN b.vendor ELSE a.l1_supplier END",
        "l1_supplier_source": f"CASE WHEN b.part IS NOT NULL THEN '{label}' ELSE a.l1_supplier_source END",
        "supplier_type": "CASE WHEN b.part IS NOT NULL THEN 'Repair' ELSE a.supplier_type END"})


def contract_fallback(src: str) -> str:
    steps = []
    for table, label in ((vendors_of("contract_vendor"), "CCS Return"), (vendors_of("new_buy_vendor", "AND trans_type = 'NB'"), "CCS NB")):
        steps += [_fill(table, "received_part_kit_part_number", label), _fill(table, "part_number", label)]
    return nested(src, *steps)


def override_by_tag(src: str) -> str:
    hit = "b.flow_tag IS NOT NULL"
    return nested(
        src,
        lambda s: updated(s, f"LEFT JOIN tag_vendor b ON a.flow_tag = b.flow_tag AND a.region = 'APJ' AND b.data_period = {P}", {
            "l1_supplier": f"CASE WHEN {hit} THEN b.final_vendor ELSE a.l1_supplier END",
            "l2_supplier": f"CASE WHEN {hit} THEN b.final_vendor ELSE a.l2_supplier END"}),
        lambda s: updated(s, f"LEFT JOIN tag_supplier b ON a.flow_tag = b.flow_tag AND a.region = 'APJ' AND b.data_period = {P}", {
            "l1_supplier": f"CASE WHEN {hit} THEN b.l1_supplier ELSE a.l1_supplier END"}),
    )


def second_level(src: str) -> str:
    def mapped(region, all_else):
        join = (f"LEFT JOIN l2_supplier_map b ON a.region = b.region AND a.region = '{region}' AND a.l1_supplier = b.l1_supplier "
                f"AND b.data_period = {P}" + ("" if all_else else " AND b.l1_supplier <> 'All Else'"))
        return lambda s: updated(s, join, {
            "l2_supplier": "CASE WHEN b.region IS NOT NULL THEN b.l2_supplier ELSE a.l2_supplier END",
            "supplier_type": "CASE WHEN b.region IS NOT NULL THEN b.supplier_type ELSE a.supplier_type END"})

    def itself(region):
        return lambda s: updated(s, "", {
            "l2_supplier": f"CASE WHEN a.region = '{region}' AND a.l1_supplier NOT IN (SELECT l1_supplier FROM l2_supplier_map WHERE region = "
                           f"'{region}' AND l1_supplier IS NOT NULL AND l1_supplier <> 'All Else' AND data_period = {P}) THEN a.l1_supplier ELSE a.l2_supplier END"})

    forced = lambda s: updated(s, "", {
        "supplier_type": "CASE WHEN l1_supplier = 'CONVERGE INC' AND NOT (region = 'EMEA' AND COALESCE(l1_supplier_source, '') = 'CCS NB') "
                         "THEN 'RFC' ELSE supplier_type END"})
    return nested(src, mapped("APJ", True), forced, mapped("AME", False), itself("AME"), mapped("EMEA", False), itself("EMEA"))


def last_fallback(src: str) -> str:
    return _fill(vendors_of("contract_vendor"), "physical_part_number", "CCS Return", "AND a.region = 'AME'")(src)


# ---- final disposition --------------------------------------------------------------------

def final_disposition(src: str) -> str:
    def put(where, value="", join=""):
        return lambda s: updated(s, join, {"final_disp_flag": f"CASE WHEN {where} THEN {value} ELSE a.final_disp_flag END"})

    pcg = "a.region = 'APJ' AND (COALESCE(l2_supplier, '') LIKE 'PCG%' OR COALESCE(l2_supplier, '') LIKE 'CONVERGE%')"
    west = "a.region IN ('AME','EMEA')"
    physical = "receipt_type = 'Physical Receipt'"
    returned = "dcr_disposition"

    def table_rule(key, names):
        return put(f"b.supplier IS NOT NULL AND a.{key} IN ({names}) AND {west}", "b.final_disp_flag",
                   f"LEFT JOIN flag_rules b ON a.{key} = b.supplier AND a.repair_disposition = b.repair_disposition "
                   "AND a.repair_warranty_status = b.repair_warranty_status")

    return nested(
        src,
        lambda s: f"SELECT *, CAST(NULL AS VARCHAR) AS final_disp_flag FROM {s}",
        put(f"a.region = 'APJ' AND NOT {blank('hub_disposition')}", "hub_disposition"),
        put(f"{pcg} AND repair_warranty_status IN ('Non Warranty Repair','Warranty Repair') AND repair_disposition = 'NFF'", "'NFF'"),
        put(f"{pcg} AND repair_warranty_status = 'Warranty Repair' AND repair_disposition = 'Repaired'", "'IW Credit'"),
        put(f"{pcg} AND repair_warranty_status = 'Non Warranty Repair' AND repair_disposition = 'Repaired'", "'OOW Credit'"),
        put("b.flow_tag IS NOT NULL", "b.disposition", f"LEFT JOIN tag_flag b ON a.flow_tag = b.flow_tag AND a.region = 'APJ' AND b.data_period = {P}"),
        put("b.flow_tag IS NOT NULL", "b.final_disposition", f"LEFT JOIN tag_vendor b ON a.flow_tag = b.flow_tag AND a.region = 'APJ' AND b.data_period = {P}"),
        put("a.region = 'APJ' AND final_disp_flag = 'CD11'", "'In Transit'"),
        put(f"a.region = 'APJ' AND ({returned} LIKE 'FG%' OR {returned} LIKE 'QC%')", "'Good Unused'"),
        put(f"a.region = 'APJ' AND ({returned} = 'SC23' OR final_disp_flag = 'SC23')",
            "CASE WHEN rma_engineer_approval = 'Yes' THEN 'Scrap at Supplier' ELSE 'Scrap in Central' END"),
        put(f"a.region = 'APJ' AND receipt_type = 'Logical Receipt' AND ({returned} = 'SC99' OR actual_disposition = 'SC99')", "'Logical Receipt'"),
        put(f"a.region = 'APJ' AND {returned} = 'SC01'", "'Scrap in Central'"),
        put("b.region IS NOT NULL", "b.correct_disposition", "LEFT JOIN code_remap b ON a.region = b.region AND a.final_disp_flag = b.final_disp_flag"),
        put(f"{west} AND receipt_type = 'Logical Receipt' AND actual_disposition = 'SC99'", "'Logical Receipt'"),
        put(f"a.region <> 'APJ' AND l2_supplier IN ('RRD','PCG') AND repair_disposition = 'NFF' AND {physical}", "'NFF'"),
        put(f"a.region <> 'APJ' AND repair_disposition = 'Process Scrapped' AND {physical}", "'Scrap at Supplier'"),
        put(f"{west} AND actual_disposition IN ('SC01','SC12','SC02','SCRU','EC01','EC02','EC11')", "'Scrap in Central'"),
        table_rule("supplier_type", "'RFC','Repair'"),
        table_rule("l2_supplier", "'Inventec','Foxconn','SPC'"),
        put(f"{west} AND actual_disposition IN ('CD11','IT21')", "'In Transit'"),
        put(f"{west} AND (actual_disposition LIKE 'FG%' OR actual_disposition LIKE 'CU%' OR actual_disposition LIKE 'QC%' OR actual_disposition LIKE 'DS%')",
            "'Good Unused'"),
        put("receipt_type = 'No Receipt'", "'Non Return'"),
        put(f"NOT {blank('flow_tag')} AND {blank('final_disp_flag')}", "'Part-Level Cost'"),
        put(f"{blank('flow_tag')} AND receipt_type <> 'No Receipt'", "'Unknown'"),
    )


# ---- standards and consumption --------------------------------------------------------------

COSTS = ("event_pn_rvs", "event_pn_nrs", "kit_pn_rvs", "physical_pn_rvs", "physical_pn_nrs", "physical_pn_nbs")


def standard_costs(src: str) -> str:
    def fill(join, changes, where=""):
        return lambda s: updated(s, f"LEFT JOIN {join} {where}", {t: f"CASE WHEN b.region IS NOT NULL THEN b.{c} ELSE a.{t} END" for t, c in changes.items()})

    event = {"event_pn_rvs": "rvs", "event_pn_nrs": "nrs"}
    missing = f"AND {nz('a.event_pn_rvs')} AND {nz('a.event_pn_nrs')}"
    steps = [lambda s: f"SELECT *, {', '.join(f'CAST(NULL AS DOUBLE) AS {c}' for c in COSTS)} FROM {s}",
             fill(f"regional_cost b ON a.part_number = b.part_no AND a.region = b.region AND b.report_month = '{COST_MONTH}'", event)]
    for table in ("sap_cost", "cost_adjustment"):
        steps.append(fill(f"{table} b ON a.part_number = b.part_number AND a.region = b.region AND b.data_period = {P}", event, missing))
    for part, changes in (("received_part_kit_part_number", {"kit_pn_rvs": "rvs"}),
                          ("physical_part_number", {"physical_pn_rvs": "rvs", "physical_pn_nrs": "nrs"})):
        steps.append(fill(f"regional_cost b ON a.{part} = b.part_no AND a.region = b.region AND a.received_month = b.report_month", changes))
        for table in ("sap_cost", "cost_adjustment"):
            steps.append(fill(f"{table} b ON a.{part} = b.part_number AND a.region = b.region AND b.data_period = {P}", changes,
                              f"AND {nz('a.' + next(iter(changes)))}"))
    steps.append(fill("service_standard b ON a.physical_part_number = b.part AND a.region = b.region AND a.received_month = b.period",
                      {"physical_pn_nbs": "new_buy"}))
    return nested(src, *steps)


def repair_average(src: str) -> str:
    return updated(src, f"LEFT JOIN repair_average b ON a.part_number = b.material AND a.region = b.region AND b.data_period = {P}", {
        "oow_avg_repair_cost": "b.oow_avg_repair_cost", "oow_iw_avg_repair_cost": "b.oow_iw_avg_repair_cost",
        "avg_above_standard": "CASE WHEN b.region IS NULL THEN NULL WHEN b.oow_avg_repair_cost > a.event_pn_rvs THEN 'Y' ELSE 'N' END"}, existing=False)


def first_pass(src: str) -> str:
    def put(where, cost, note=None, join=""):
        changes = {"cons_cost": f"CASE WHEN {where} THEN {cost} ELSE a.cons_cost END"}
        if note:
            changes["cons_cost_notes"] = f"CASE WHEN {where} THEN '{note}' ELSE a.cons_cost_notes END"
        return lambda s: updated(s, join, changes)

    oow, part = "final_disp_flag = 'OOW Repair'", "final_disp_flag = 'Part-Level Cost'"
    return nested(
        src,
        lambda s: f"SELECT *, CAST(NULL AS DOUBLE) AS cons_cost, CAST(NULL AS VARCHAR) AS cons_cost_notes FROM {s}",
        put("final_disp_flag = 'IW Exch'", "0.0"),
        put(f"{oow} AND oow_avg_repair_cost IS NOT NULL AND oow_avg_repair_cost >= 0", "oow_avg_repair_cost", "OOW Avg Repair Cost Used"),
        put(f"{oow} AND (oow_avg_repair_cost IS NULL OR oow_avg_repair_cost < 0) AND b.out_warranty_repr >= 0", "b.out_warranty_repr",
            "iCost SVC Repair Std Used", "LEFT JOIN service_standard b ON a.part_number = b.part AND a.region = b.region AND a.received_month = b.period"),
        put(f"{oow} AND (cons_cost IS NULL OR cons_cost < 0)", "event_pn_nrs", "NRS Used"),
        put(f"{part} AND oow_iw_avg_repair_cost IS NOT NULL AND oow_iw_avg_repair_cost >= 0", "oow_iw_avg_repair_cost", "OOW/IW Avg Repair Cost Used"),
        put(f"{part} AND (oow_iw_avg_repair_cost IS NULL OR oow_iw_avg_repair_cost <= 0)", "event_pn_nrs", "NRS Used"),
        put("final_disp_flag IN ('Unknown','WT02','QT20','In Transit')", "event_pn_nrs * part_qty_consumed", "NRS Used"),
        put("final_disp_flag = 'Good Unused'", "0.0"),
    )


def relabel(src: str) -> str:
    known = f"NOT {nz('event_pn_rvs')} AND NOT {nz('kit_pn_rvs')}"
    known2 = f"NOT {nz('kit_pn_rvs')} AND NOT {nz('physical_pn_rvs')}"
    return f"""SELECT *, CASE WHEN {known} THEN event_pn_rvs - kit_pn_rvs ELSE 0.0 END AS relabel_cost,
  CASE WHEN {known} THEN CASE WHEN event_pn_rvs = kit_pn_rvs THEN 'Same Kit Part Number' END ELSE 'Missing RVS' END AS relabel_cost_comment,
  CASE WHEN {known2} THEN kit_pn_rvs - physical_pn_rvs ELSE 0.0 END AS dekit_cost,
  CASE WHEN {known2} THEN CASE WHEN physical_pn_rvs = kit_pn_rvs THEN 'Same Physical Part Number' END ELSE 'Missing RVS' END AS dekit_cost_comment
FROM {src}"""


def part_age(src: str) -> str:
    months = "((1996 - year(b.week_beginning)) * 12 + 12 - month(b.week_beginning))"
    scope = (f"length(rtrim(a.ct_code_label)) = 14 AND substr(a.ct_code_label, 10, 2) = b.week_code AND a.receipt_type = 'Physical Receipt' AND "
             f"((a.region IN ('AME','EMEA') AND a.l2_supplier = 'RRD' AND {low('a.repair_oem_name', 'Seagate')}) "
             f"OR (a.region = 'APJ' AND {low('a.l2_supplier', 'Seagate')}))")
    age = f"CAST(sign({months}) * floor(abs({months}) * 10.0 / 12 + 0.5) / 10 AS DECIMAL(18,1))"
    return updated(src, f"LEFT JOIN week_codes b ON {scope}", {"part_age": age, "mfg_date": "b.week_beginning"}, existing=False)


def dmr(src: str) -> str:
    return updated(src, f"LEFT JOIN (SELECT region, so_item, MAX(dmr_flag) AS flag FROM dmr_flags WHERE NOT {blank('dmr_flag')} GROUP BY region, so_item) b "
                   "ON a.region = b.region AND replace(a.so_item, '-', '') = b.so_item", {"dmr_status": "COALESCE(b.flag, 'No DMR')"}, existing=False)


def second_pass(src: str) -> str:
    def put(where, **changes):
        return lambda s: updated(s, "", {k: f"CASE WHEN {where} THEN {v} ELSE {k} END" for k, v in changes.items()})

    z = lambda c: f"COALESCE({c}, 0.0)"
    di = {"di_cost": f"{z('physical_pn_nbs')} + {z('credits')}", "di_credit": f"{z('physical_pn_rvs')} - {z('physical_pn_nbs')}",
          "cons_cost": f"{z('physical_pn_rvs')} + {z('credits')}"}
    returned = f"{z('event_pn_rvs')} + {z('credits')}"
    return nested(
        src,
        lambda s: f"SELECT *, CAST(NULL AS DOUBLE) AS di_cost, CAST(NULL AS DOUBLE) AS di_credit FROM {s}",
        put("l2_supplier = 'RRD' AND final_disp_flag = 'NFF'", cons_cost="0.0"),
        put("final_disp_flag IN ('Non Return','DMR Drive')", cons_cost=returned),
        put("final_disp_flag = 'Scrap in Central'", cons_cost=z("physical_pn_rvs")),
        put("final_disp_flag = 'Scrap at Supplier'", cons_cost=f"{z('physical_pn_rvs')} + {z('credits')}"),
        put("final_disp_flag IN ('IW Credit','OOW Credit')", **di),
        put("final_disp_flag IN ('Logical Receipt','Non Return')", cons_cost=returned),
        put("l2_supplier = 'PCG' AND final_disp_flag = 'NFF'", **di),
    )


def at_standard(src: str) -> str:
    return f"""SELECT *, CASE WHEN part_qty_consumed > 0 AND receipt_type IN ('Logical Receipt','No Receipt') THEN event_pn_rvs
  WHEN part_qty_consumed > 0 AND receipt_type = 'Physical Receipt' THEN event_pn_nrs END AS cons_cost_at_std FROM {src}"""


# ---- pools -------------------------------------------------------------------------------------

def share(src: str, out: str, pool: str, on: dict, base: str, weight: str = "part_qty_consumed", target: str | None = None,
          amount: str = "amount", part: str | None = None, guard: str = "d.total <> 0", rate: str | None = None, new: bool = False,
          extra: dict | None = None) -> str:
    """Amount of the pool over the summed weight of base lines, times the line's own part."""
    keys = ", ".join(f"{v} AS dk{i}" for i, v in enumerate(on.values()))
    groups = ", ".join(on.values())
    d = f"(SELECT {keys}, {dec(weight)} AS total FROM {src} a WHERE {base} GROUP BY {groups})"
    join = (f"LEFT JOIN {pool} p ON {' AND '.join(f'p.{k} = a.{v}' for k, v in on.items())} "
            f"LEFT JOIN {d} d ON {' AND '.join(f'd.dk{i} = a.{v}' for i, v in enumerate(on.values()))}")
    hit = f"p.{next(iter(on))} IS NOT NULL AND d.total IS NOT NULL AND {guard} AND ({target or base})"
    value = f"{rate or f'CAST(p.{amount} AS DOUBLE) / d.total'} * {part or weight}"
    changes = {out: f"CASE WHEN {hit} THEN {value} {'' if new else f'ELSE a.{out} '}END"}
    changes.update({k: f"CASE WHEN {hit} THEN {v} ELSE a.{k} END" for k, v in (extra or {}).items()})
    return updated(src, join, changes, existing=not new)


def period(table: str, columns: str = "*", where: str = "TRUE") -> str:
    return f"(SELECT {columns} FROM {table} WHERE data_period = {P} AND {where})"


def variance(src: str) -> str:
    return share(src, "esc_variance", period("variance_actuals", "region AS pr, substr(l06_ba_code, 1, 2) AS spl, actuals_usd AS amount"),
                 {"pr": "region", "spl": "event_spl"}, ABROAD, new=True)


VALUED = f"""SELECT s.region, s.material, s.quantity, s.data_period, s.quantity * c.rvs AS gross_scrap, s.quantity * c.nrs * -1.0 AS ctr_release,
  s.quantity * c.rvs + s.quantity * c.nrs * -1.0 AS net_scrap FROM defective_scrap s LEFT JOIN regional_cost c
  ON s.material = c.part_no AND s.region = c.region AND c.report_month = '{COST_MONTH}' AND s.data_period = {P}"""
SCRAP_BASE = f"a.region IN ('EMEA','AME') AND {USED} AND final_disp_flag = 'Part-Level Cost'"


def scrap(src: str) -> str:
    return share(src, "def_scrap_cost", f"(SELECT region AS pr, material, net_scrap AS amount FROM ({VALUED}) WHERE data_period = {P})",
                 {"pr": "region", "material": "part_number"}, SCRAP_BASE, new=True, guard="TRUE",
                 rate="(CASE WHEN d.total > 0 THEN p.amount / d.total ELSE 0.0 END)")


def empty_nppo(src: str) -> str:
    return f"SELECT *, CAST(NULL AS DOUBLE) AS nppo_cost FROM {src}"


def by_supplier(src: str) -> str:
    base = f"region = 'APJ' AND {ABROAD} AND {USED}"
    return share(src, "nppo_cost", period("supplier_spend", "supplier, spend AS amount"), {"supplier": "l2_supplier"}, base,
                 target=f"{base} AND NOT {low('l2_supplier', 'RRD', 'Seagate')}")


def pooled(src: str) -> str:
    base = f"region = 'APJ' AND {ABROAD} AND {USED} AND part_commodity = 'Hard Drive' AND {low('l2_supplier', 'RRD', 'Toshiba', 'Seagate')}"
    pool = f"(SELECT 'APJ' AS pr, {dec('spend')} AS amount FROM supplier_spend WHERE data_period = {P} AND {low('supplier', 'RRD', 'Seagate')})"
    return share(src, "nppo_cost", pool, {"pr": "region"}, base)


def by_tag(region: str):
    def step(src: str) -> str:
        newest = (f"(SELECT flow_tag, CAST(charge AS DOUBLE) AS charge FROM (SELECT *, row_number() OVER (PARTITION BY flow_tag ORDER BY turn DESC, charge DESC) rn "
                  f"FROM tag_charges WHERE data_period = {P} AND region = '{region}') WHERE rn = 1)")
        return updated(src, f"LEFT JOIN {newest} b ON a.flow_tag = b.flow_tag AND a.region = '{region}'",
                       {"nppo_cost": "CASE WHEN b.flow_tag IS NOT NULL THEN b.charge ELSE a.nppo_cost END"})
    return step


def top_vendors(src: str) -> str:
    base = f"region = 'AME' AND {USED}"
    pool = period("top_vendors", "vendor, nppo AS amount", "vendor NOT IN ('RRD','Expresspoint')")
    return share(src, "nppo_cost", pool, {"vendor": "l2_supplier"}, base)


def restricted(src: str) -> str:
    base = f"region = 'AME' AND {USED} AND final_disp_flag IN ('IW Credit','NFF','Scrap at Supplier','Scrap in Central')"
    return share(src, "nppo_cost", period("top_vendors", "vendor, nppo AS amount", "vendor = 'RRD'"), {"vendor": "l2_supplier"}, base)


def part_charges(src: str) -> str:
    rules = {"ACCTON": "LIKE 'ACCTON%'", "IQOR": "LIKE 'IQOR%'", "EATON": "LIKE 'EATON%'", "SPC": "LIKE 'SPC%'", "H3C": "LIKE 'H3C%'",
             "REL": "= 'RENFREWSHIRE ELECTRONICS LTD'"}

    def one(vendor, rule):
        base = f"region = 'EMEA' AND {USED} AND l2_supplier {rule}"
        charge = f"(SELECT part_number AS part, charge FROM part_charges WHERE vendor = '{vendor}' AND data_period = {P})"

        def step(s):
            d = f"(SELECT part_number AS part, {dec('part_qty_consumed')} AS total FROM {s} WHERE {base} GROUP BY part_number)"
            credit = "0.0"
            if vendor == "SPC":
                credit = (f"(SELECT charge FROM {charge} WHERE part = 'Total Credit') / (SELECT CAST(SUM(CAST(total AS DECIMAL(28,6))) AS DOUBLE) "
                          f"FROM {d} JOIN {charge} USING (part))")
            unit = f"(SELECT c.part, c.charge / d.total + {credit} AS unit FROM {charge} c JOIN {d} d ON c.part = d.part WHERE d.total > 0)"
            return updated(s, f"LEFT JOIN {unit} u ON a.part_number = u.part", {
                "nppo_cost": f"CASE WHEN u.part IS NOT NULL AND a.{base} THEN u.unit * part_qty_consumed ELSE a.nppo_cost END"})
        return step

    return nested(src, *[one(v, r) for v, r in rules.items()])


def three_layers(src: str) -> str:
    base = f"region = 'EMEA' AND l2_supplier = 'RRD' AND {USED}"
    total = "(COALESCE(t.rate * a.part_qty_consumed, 0.0) + COALESCE(c.charge / x.total * a.part_qty_consumed, 0.0) + COALESCE(z.unit, 0.0))"
    return f"""SELECT a.* REPLACE (CASE WHEN a.{base} AND a.part_qty_consumed > 0 AND a.repair_tag_used <> 'N' AND NOT {blank('a.flow_tag')}
  AND {total} <> 0 THEN {total} ELSE a.nppo_cost END AS nppo_cost) FROM {src} a
LEFT JOIN {period('tag_rates')} t ON a.repair_disposition = t.repair_disposition LEFT JOIN {period('part_level')} c ON a.part_number = c.part_number
LEFT JOIN (SELECT part_number, {dec('part_qty_consumed')} AS total FROM {src} WHERE {base} GROUP BY part_number
  HAVING SUM(part_qty_consumed) > 0) x ON x.part_number = c.part_number
LEFT JOIN (SELECT 'EMEA' AS region, (SELECT {dec('COALESCE(cost, 0.0)')} FROM activity_cost WHERE data_period = {P})
  / NULLIF((SELECT {dec('part_qty_consumed')} FROM {src} WHERE {base}), 0) AS unit) z ON a.region = z.region"""


def same_day(src: str) -> str:
    base = ("event_country_iso_cd IN ('CA','US') AND l1_supplier = 'EXPRESSPOINT TECHNOLOGY SERVICES' AND part_actual_sl = 'Same Day' "
            "AND part_qty_consumed <> 0")
    pool = period("top_vendors", "'EXPRESSPOINT TECHNOLOGY SERVICES' AS supplier, nppo AS amount", "vendor = 'Expresspoint'")
    return share(src, "nppo_cost", pool, {"supplier": "l1_supplier"}, base)


def _inventory(src: str, spl: str, replace_: bool) -> str:
    head = "SELECT *" if replace_ else "SELECT *, CAST(NULL AS DOUBLE) AS region_inv_costs"
    keyed = (f"{head}, CASE WHEN region = 'AME' THEN na_vs_la WHEN region IN ('APJ','EMEA') THEN region END AS inv_region FROM {src} "
             f"LEFT JOIN (SELECT iso_country_code AS iso, na_vs_la FROM country_region) k ON event_country_iso_cd = k.iso")
    base = f"{USED} AND part_qty_demanded > 0 AND inv_region IS NOT NULL AND (a.region = 'AME' OR {ABROAD})"
    return nested(
        src, lambda s: keyed,
        lambda s: share(s, "region_inv_costs", period("region_inventory", "region AS pr, spl, total_inv_cost AS amount"),
                        {"pr": "inv_region", "spl": spl}, base, weight="part_qty_demanded",
                        target=base + " AND a.region_inv_costs IS NULL"),
        lambda s: f"SELECT * EXCLUDE (inv_region, iso, na_vs_la) FROM {s}")


def region_inventory(src: str) -> str:
    return _inventory(src, "part_spl", False)


def event_line_inventory(src: str) -> str:
    base = f"{USED} AND part_qty_demanded > 0 AND {ABROAD}"
    existing = src if " " in src else f"(SELECT * FROM {src})"
    return nested(
        src, lambda s: f"SELECT *, CAST(NULL AS DOUBLE) AS region_inv_costs FROM {existing}",
        lambda s: share(s, "region_inv_costs", period("region_inventory", "region AS pr, spl, total_inv_cost AS amount"),
                        {"pr": "region", "spl": "event_spl"}, base, weight="part_qty_demanded", target=base + " AND a.region_inv_costs IS NULL"))


def country_inventory(src: str) -> str:
    base = f"{USED} AND part_qty_demanded > 0 AND {ABROAD}"
    sub = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY spl, iso_country_code ORDER BY total_inv_cost DESC, sub_region DESC) rn FROM {period('subregion_inventory')}) WHERE rn = 1)"

    def by_sub(s):
        d = (f"(SELECT b.spl, b.sub_region, {dec('part_qty_demanded')} AS total FROM {s} a JOIN {sub} b ON a.event_spl = b.spl AND "
             f"a.event_country_iso_cd = b.iso_country_code WHERE {base} GROUP BY b.spl, b.sub_region)")
        return updated(s, f"LEFT JOIN {sub} b ON a.event_spl = b.spl AND a.event_country_iso_cd = b.iso_country_code LEFT JOIN {d} d "
                       "ON d.spl = b.spl AND d.sub_region = b.sub_region", {
                           "country_inv_costs": f"CASE WHEN d.total IS NOT NULL AND {base} THEN b.total_inv_cost / NULLIF(d.total, 0) * part_qty_demanded "
                                                "ELSE a.country_inv_costs END"})

    return nested(src, by_sub, lambda s: share(
        s, "country_inv_costs", period("country_inventory_cost", "iso_country_code, spl, total_inv_cost AS amount"),
        {"iso_country_code": "event_country_iso_cd", "spl": "event_spl"}, base, weight="part_qty_demanded",
        target=base + " AND a.country_inv_costs IS NULL"))


def taxes(src: str) -> str:
    base = f"{USED} AND {ABROAD} AND part_qty_consumed > 0"
    inner = share(src, "taxes_raw", period("country_taxes", "iso_country_code, total_taxes AS amount", f"NOT {nz('total_taxes')}"),
                  {"iso_country_code": "event_country_iso_cd"}, base, weight="COALESCE(event_pn_rvs, 0.0) * part_qty_consumed",
                  part="(event_pn_rvs * part_qty_consumed)", new=True)
    return f"SELECT * EXCLUDE (taxes_raw), {money('taxes_raw')} AS taxes FROM ({inner})"


def totals(src: str) -> str:
    z = lambda c: f"COALESCE({c}, 0.0)"
    total = f"{z('cons_cost')} + {z('nppo_cost')} + {z('relabel_cost')} + {z('dekit_cost')} + COALESCE(CAST(taxes AS DOUBLE), 0.0)"
    inventory = f"{z('country_inv_costs')} + {z('region_inv_costs')}"
    return f"SELECT *, {inventory} AS total_inv_costs, {total} AS total_matl_cost, ({total}) + ({inventory}) AS total_matl_inv_cost FROM {src}"


def non_event(src: str) -> str:
    return share(src, "non_event_cost", period("non_event_costs", "region AS pr, cost_value AS amount"), {"pr": "region"},
                 f"NOT {nz('part_qty_demanded')}", weight="part_qty_demanded * event_pn_rvs", target="TRUE",
                 part="(COALESCE(part_qty_demanded, 0) * event_pn_rvs)", new=True)


def spl_group(src: str) -> str:
    listed = " OR ".join(f"(region = '{r}' AND part_spl IN (SELECT {r.lower()}_spl FROM spl_by_region WHERE NOT {blank(r.lower() + '_spl')}))"
                         for r in ("APJ", "EMEA", "AME"))
    return f"""SELECT *, CASE WHEN {listed} THEN 'EG' WHEN region IN {REGIONS3} AND NOT {blank('part_spl')} THEN 'PPS' END AS part_spl_desc FROM {src}"""


# ---- credits -------------------------------------------------------------------------------------

def empty_credits(src: str) -> str:
    return f"SELECT *, CAST(NULL AS DOUBLE) AS credits, CAST(NULL AS VARCHAR) AS credit_comments FROM {src}"


def virtual_credit(src: str) -> str:
    pool = (f"(SELECT region AS pr, 'Hard Drive' AS com, -hdd_credit_rate AS amount FROM credit_rates WHERE data_period = {P} UNION ALL "
            f"SELECT region, 'Solid State Drive', -ssd_credit_rate FROM credit_rates WHERE data_period = {P})")
    base = "part_commodity IN ('Hard Drive','Solid State Drive') AND dmr_status = 'DMR' AND receipt_type IN ('Logical Receipt','No Receipt')"
    return share(src, "credits", pool, {"pr": "region", "com": "part_commodity"}, base,
                 weight="COALESCE(part_qty_consumed, 0.0) * COALESCE(event_pn_rvs, 0.0)", part="(part_qty_consumed * event_pn_rvs)",
                 extra={"credit_comments": "'DMR Credit'"})


def priced_credit(src: str, qty: str = "part_qty_received", only: str = "AND a.part_qty_received = 1") -> str:
    kinds = [("a.final_disp_flag IN ('IW Credit','OOW Credit') AND b.commodity = 'Memory'", "* 0.88e0"),
             ("a.final_disp_flag = 'IW Credit' AND b.commodity = 'CPU'", ""),
             ("a.final_disp_flag = 'NFF' AND b.commodity IN ('CPU','Memory')", ""), ("a.final_disp_flag = 'Scrap at Supplier'", "* 0.06e0")]
    value = "CASE " + " ".join(f"WHEN {w} THEN a.{qty} * b.final_price {f} * -1.0" for w, f in kinds) + " ELSE NULL END"
    note = "CASE " + " ".join(f"WHEN {w} THEN 'Supplier Credit'" for w, _ in kinds) + " ELSE NULL END"
    join = (f"LEFT JOIN price_list b ON a.region = b.region AND a.received_part_kit_part_number = b.part_number AND a.l2_supplier LIKE 'PCG%' "
            f"AND a.final_disp_flag IN ('IW Credit','OOW Credit','NFF','Scrap at Supplier') {only} AND b.data_period = {P}")
    return updated(src, join, {"credits": f"CASE WHEN b.region IS NOT NULL THEN {value} ELSE a.credits END",
                               "credit_comments": f"CASE WHEN b.region IS NOT NULL THEN {note} ELSE a.credit_comments END"})


def _average(table: str, cost: str, where: str = "TRUE", named: bool = False) -> str:
    join = f"JOIN named_vendors v ON c.vendor_no = v.vendor AND c.region = v.region AND v.data_period = {P}" if named else ""
    return (f"(SELECT c.region, c.month, c.part_no, {mean('c.' + cost)} AS cost FROM {table} c {join} WHERE {where} GROUP BY c.region, c.month, c.part_no)")


ORG = "c.org_cd IN ('AM02','H499','C299')"
NEW_BUY = f"{ORG} AND c.transaction_type = 'NB' AND c.forecast_cost IS NOT NULL AND c.forecast_cost >= 0.0"
OOW = _average("contract_cost", "contract_cost", "c.transaction_type = 'OC'")
IW = _average("contract_cost_iw", "contract_cost")
NB_NAMED = _average("contract_cost", "forecast_cost", NEW_BUY, True)
IW_NAMED = _average("contract_cost_iw", "contract_cost", ORG, True)
NB_ORG = _average("contract_cost", "forecast_cost", NEW_BUY)
IW_ORG = _average("contract_cost_iw", "contract_cost", ORG)


def _credit(average: str, where: str, credit: str = "b.cost * -1.0", note: str = "a.credit_comments"):
    join = (f"LEFT JOIN {average} b ON a.physical_part_number = b.part_no AND a.region = b.region AND a.received_month = b.month AND ({where})")
    return lambda s: updated(s, join, {"credits": f"CASE WHEN b.region IS NOT NULL THEN {credit} ELSE a.credits END",
                                       "credit_comments": f"CASE WHEN b.region IS NOT NULL THEN {note} ELSE a.credit_comments END"})


OPEN = "(a.credits IS NULL OR a.credits > 0)"
WEST = "a.region IN ('AME','EMEA')"
MAKER = (f"(({WEST} AND a.l2_supplier = 'RRD' AND {low('a.repair_oem_name', 'seagate')}) OR (a.region = 'APJ' AND {low('a.l2_supplier', 'seagate')})) "
         "AND a.final_disp_flag = 'IW Credit'")


def contract_fallback_credit(src: str) -> str:
    def note(label):
        return f"CASE WHEN {blank('a.credit_comments')} THEN '{label}' END"

    return nested(
        src,
        _credit(IW, f"a.l2_supplier LIKE 'PCG%' AND a.final_disp_flag IN ('IW Credit','NFF','Scrap at Supplier') AND {OPEN}", note=note("CCS IW Credit")),
        _credit(OOW, f"a.l2_supplier LIKE 'PCG%' AND a.final_disp_flag = 'OOW Credit' AND {OPEN}", note=note("CCS OOW Credit")),
    )


def age_credit(src: str) -> str:
    value = ("CASE WHEN a.part_age IS NOT NULL AND a.part_age <= 3.0 THEN b.cost * -1.0 WHEN a.part_age IS NOT NULL AND a.part_age > 3.0 "
             "THEN b.cost * 0.5 * -1.0 ELSE b.cost * -1.0 END")
    note = "CASE WHEN a.part_age IS NOT NULL THEN 'CCS NB Fcst' ELSE 'CCS NB Fcst - Blank Part Age' END"
    return nested(src, _credit(NB_NAMED, MAKER, value, note), _credit(IW_NAMED, f"{MAKER} AND {nz('a.credits')}", note="'CCS IW Credit'"))


def forecast_older(src: str) -> str:
    west, apj = f"{WEST} AND a.l2_supplier = 'RRD' AND a.final_disp_flag = 'IW Credit'", f"a.region = 'APJ' AND {low('a.l2_supplier', 'seagate')} AND a.final_disp_flag = 'IW Credit'"
    maker, unknown = low("a.repair_oem_name", "seagate"), f"(a.part_age IS NULL OR {blank('a.ct_code_label')})"
    steps = [_credit(NB_NAMED, scope, f"CASE WHEN {mine} AND a.part_age > 3.0 THEN b.cost * 0.5 * -1.0 ELSE b.cost * -1.0 END",
                     f"CASE WHEN {mine} AND {unknown} THEN 'CCS NB Fcst - Blank Part Age' ELSE 'CCS NB Fcst' END")
             for scope, mine in ((west, maker), (apj, "TRUE"))]
    return nested(src, *steps, *[_credit(IW_NAMED, f"{scope} AND {nz('a.credits')}", note="'CCS IW Credit'") for scope in (west, apj)])


def kitting_older(src: str) -> str:
    join = (f"LEFT JOIN kitting_fees b ON a.region = b.region AND a.master_event_activity_month = b.month AND b.data_period = {P} AND "
            "a.l2_supplier = 'RRD' AND a.final_disp_flag = 'IW Credit'")
    return updated(src, join, {"credits": "CASE WHEN b.region IS NOT NULL THEN COALESCE(a.credits, 0.0) + b.avg_kitting_fee ELSE a.credits END",
                               "credit_comments": "CASE WHEN b.region IS NOT NULL THEN 'Supplier Credit' ELSE a.credit_comments END"})


def all_others_older(src: str) -> str:
    other = "a.l2_supplier <> 'RRD' AND COALESCE(a.l2_supplier, '') NOT LIKE 'PCG%'"
    return nested(
        src, _credit(IW, f"{WEST} AND {other} AND a.final_disp_flag = 'IW Credit'", note="'Supplier Credit'"),
        _credit(IW, f"a.region = 'APJ' AND {other} AND lower(a.l2_supplier) <> 'seagate' AND a.final_disp_flag = 'IW Credit'", note="'Supplier Credit'"),
        _credit(OOW, f"{other} AND a.final_disp_flag = 'OOW Credit'", note="'Supplier Credit'"))


def kitting(src: str) -> str:
    join = (f"LEFT JOIN kitting_fees b ON a.region = b.region AND a.master_event_activity_month = b.month AND b.data_period = {P} AND "
            f"{low('a.l2_supplier', 'seagate')} AND a.final_disp_flag = 'IW Credit' AND a.credit_comments IN ('CCS NB Fcst','CCS NB Fcst - Blank Part Age')")
    return updated(src, join, {"credits": "CASE WHEN b.region IS NOT NULL THEN COALESCE(a.credits, 0.0) + b.avg_kitting_fee ELSE a.credits END"})


def other_makers(src: str) -> str:
    west = f"{WEST} AND a.l2_supplier = 'RRD' AND NOT {low('a.repair_oem_name', 'seagate')} AND a.final_disp_flag = 'IW Credit'"
    apj = f"a.region = 'APJ' AND {low('a.l2_supplier', 'RRD', 'HITACHI GST', 'TOSHIBA', 'WESTERN DIGITAL')} AND a.final_disp_flag = 'IW Credit'"
    return nested(src, _credit(NB_ORG, west, note="'CCS NB Fcst'"), _credit(IW_ORG, f"{west} AND {nz('a.credits')}", note="'CCS IW Credit'"),
                  _credit(IW_ORG, apj, note="'CCS IW Credit'"))


def all_others(src: str) -> str:
    west = f"{WEST} AND a.l2_supplier <> 'RRD' AND COALESCE(a.l2_supplier, '') NOT LIKE 'PCG%'"
    apj = (f"a.region = 'APJ' AND NOT {low('a.l2_supplier', 'RRD', 'seagate', 'HITACHI GST', 'WESTERN DIGITAL', 'TOSHIBA')} "
           "AND COALESCE(a.l2_supplier, '') NOT LIKE 'PCG%'")
    steps = [_credit(t, f"{scope} AND a.final_disp_flag = '{flag}'", note="'Supplier Credit'")
             for t, flag in ((IW, "IW Credit"), (OOW, "OOW Credit")) for scope in (west, apj)]
    return nested(src, *steps)


def orphan(src: str) -> str:
    lost = f"final_disp_flag = 'Non Return' AND {ABROAD}"
    used = f"{lost} AND dmr_status = 'No DMR' AND part_qty_consumed > 0"
    value = "event_pn_rvs * part_qty_consumed"
    unused = f"{lost} AND part_qty_consumed = 0 AND NOT {nz('event_pn_rvs')}"
    return nested(
        src,
        lambda s: share(s, "credits", period("orphan_receipts", "region AS pr, orphan_receipt_at_dv AS amount"), {"pr": "region"},
                        f"{used} AND NOT {nz('event_pn_rvs')}", weight=value, target=used, part=f"({value})",
                        extra={"credit_comments": "'Def Orphan Receipt Credit'"}),
        lambda s: share(s, "credits", period("orphan_receipts", "region AS pr, orphan_receipt_at_fg AS amount"), {"pr": "region"},
                        unused, weight="event_pn_rvs", extra={"credit_comments": "'Good Orphan Receipt Credit'"}))


def cid(src: str) -> str:
    scope = "region = 'APJ' AND rma_cid = 'Y' AND final_disp_flag IN ('IW Credit','OOW Credit')"
    return updated(src, "", {"credits": f"CASE WHEN {scope} THEN CAST(rma_credit AS DOUBLE) * -1.0 ELSE credits END",
                             "credit_comments": f"CASE WHEN {scope} THEN 'Supplier CID Credit' ELSE credit_comments END"})


# ---- assembling ---------------------------------------------------------------------------------

NUMERIC = {
    "cons_cost", "di_cost", "di_credit", "oow_avg_repair_cost", "oow_iw_avg_repair_cost", "esc_variance", "def_scrap_cost", "nppo_cost",
    "event_pn_rvs", "event_pn_nrs", "kit_pn_rvs", "physical_pn_rvs", "physical_pn_nrs", "physical_pn_nbs", "relabel_cost", "dekit_cost",
    "credits", "cons_cost_at_std", "country_inv_costs", "region_inv_costs", "total_inv_costs", "total_matl_cost", "total_matl_inv_cost",
    "taxes", "non_event_cost", "rma_credit", "part_age",
}
WHOLE = {"repair_tat", "part_qty_received", "part_qty_demanded", "part_qty_consumed"}


# shares and unit rates, compared at ten decimals
FINE = {"std_rev_share", "true_up_share", "unit_rate"}


def rounded(c: str, fine: bool = False) -> str:
    """Four decimals (ten if fine) by plain arithmetic, so that halves fall alike in both engines."""
    unit = "10000000000.0e0" if fine else "10000.0e0"
    return f"floor(CAST({c} AS DOUBLE) * {unit} + 0.5e0) / {unit}"


def money(c: str) -> str:
    """Money rounds halves of the printed number up, as a cast of text does."""
    return f"CAST(CAST({c} AS VARCHAR) AS DECIMAL(19,4))"


def column(c: str) -> str:
    if c in NUMERIC:
        return f"{rounded(c)} AS {c}"
    if c in WHOLE:
        return f"CAST({c} AS BIGINT) AS {c}"
    return c


def statement(inputs: tuple[str, ...], parts: list[tuple[str, str]], select: str) -> str:
    named = ctes(*inputs) + [f"{n} AS ({sql})" for n, sql in parts]
    return ("WITH " + ",\n".join(named) + "\n" if named else "") + select


def chain(inputs: tuple[str, ...], columns: tuple[str, ...], *steps, start: str = "lines", first: str | None = None) -> str:
    """Steps one after the other over `start` (a stand-in, or the SELECT given as `first`)."""
    parts = [("start_lines", first or f"SELECT * FROM {start}")]
    for i, step in enumerate(steps):
        parts.append((f"step{i}", step(parts[-1][0])))
    return statement(inputs if first else (start, *inputs), parts, f"SELECT {', '.join(column(c) for c in columns)} FROM {parts[-1][0]}")
