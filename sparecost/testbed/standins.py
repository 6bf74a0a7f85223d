"""Model inputs derived from the benchmark tables.

The benchmark has no service data, so every input of the model is stated as one SELECT over its
tables. The text is plain enough to run unchanged on Spark and on the checking database, which makes
both sides start from the same rows. Every value is a pure function of the row (or a grouped sum).
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from sparecost.session import checkpoint_dir
from sparecost.sources import Folder, read_table

PERIOD = "1997Q1"
PREVIOUS = "1996Q4"
COST_MONTH = "199701"
BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def pick(index: str, *names: str) -> str:
    """The name at an index, null for an empty name."""
    return f"NULLIF(split_part('{';'.join(names)}', ';', CAST(({index}) % {len(names)} AS INT) + 1), '')"


def div(a: str, b: int) -> str:
    return f"CAST(floor(({a}) / {b}) AS BIGINT)"


def text(a: str) -> str:
    return f"CAST({a} AS STRING)"


def month(d: str) -> str:
    return text(f"year({d}) * 100 + month({d})")


def tag(k: str) -> str:
    """Tag of a number in one of four spellings."""
    return f"CASE {k} % 4 WHEN 0 THEN 'FT' WHEN 1 THEN '$T' WHEN 2 THEN '0T' ELSE 'XXFT' END || {text(k)}"


def total(a: str) -> str:
    return f"CAST(SUM(CAST({a} AS DECIMAL(18,2))) AS DOUBLE)"


def period_of(k: str) -> str:
    """Mostly the current period, some rows of the one before."""
    return f"CASE WHEN {k} % 8 = 7 THEN '{PREVIOUS}' ELSE '{PERIOD}' END"


def per_region(body: str, *regions: str) -> str:
    return "\nUNION ALL ".join(body.replace("@R", f"'{r}'").replace("@I", str(i)) for i, r in enumerate(regions))


SUPPLIERS = ("RRD", "Seagate", "PCG", "PCG EAST", "Toshiba", "ACCTON TECHNOLOGY CORP", "IQOR GLOBAL", "EATON POWER",
             "SPC INTERNATIONAL", "H3C TECHNOLOGIES", "RENFREWSHIRE ELECTRONICS LTD", "Foxconn", "Inventec",
             "CONVERGE INC", "HITACHI GST", "WESTERN DIGITAL", "Other One", "Other Two", "")
L1_SUPPLIERS = ("EXPRESSPOINT TECHNOLOGY SERVICES", "CONVERGE INC", "Maker One", "Maker Two", "Maker Three", "All Else", "")
FLAGS = ("IW Credit", "OOW Credit", "NFF", "Scrap at Supplier", "Scrap in Central", "Part-Level Cost", "Non Return",
         "OOW Repair", "IW Exch", "Unknown", "In Transit", "Good Unused", "Logical Receipt", "WT02", "DMR Drive", "")
CODES = ("SC99", "SC01", "SC12", "FG10", "CU01", "QC02", "DS03", "CD11", "IT21", "SC23", "RP01", "XXXX", "")
RETURN_CODES = ("FG10", "QC02", "SC23", "SC01", "SC99", "CD11", "RP01", "RP02", "XXXX")
REPAIR_FLAGS = ("NFF", "Repaired", "Process Scrapped", "Exchanged", "")
WARRANTIES = ("Warranty Repair", "Non Warranty Repair", "Other", "")
PLANTS = ("H499", "C299", "AM02", "C208", "X1", "X2", "X3")
VENDORS = ("Maker One", "Maker Two", "Maker Three", "CONVERGE INC", "PCG")
COMMODITY = ("CASE p_type WHEN 'PROMO' THEN 'Hard Drive' WHEN 'STANDARD' THEN 'Solid State Drive' "
             "WHEN 'ECONOMY' THEN 'Memory' WHEN 'MEDIUM' THEN 'CPU' ELSE p_type END")
SPL = "lpad(substr(p_brand, 7), 2, '0')"
RVS = "CASE WHEN p_size % 7 = 0 THEN CAST(NULL AS DOUBLE) WHEN p_size % 11 = 0 THEN 0e0 ELSE p_retailprice + {add}e0 END"
NRS = "CASE WHEN p_size % 7 = 0 THEN CAST(NULL AS DOUBLE) WHEN p_size % 11 = 0 THEN 0e0 ELSE p_retailprice * 4e-1 END"
KEY = (f"{text('l_orderkey')} || '-' || {text('l_linenumber')} || '-' || {text('l_partkey')} || '-' || "
       f"{text('l_suppkey')} || '-' || {text('CAST(l_quantity AS INT)')}")
KIT = f"CASE WHEN h % 4 = 0 THEN 'P ' || {text('l_partkey + 1')} ELSE 'P ' || {text('l_partkey')} END"
PHYSICAL = f"CASE WHEN h % 5 = 0 THEN 'P ' || {text('l_partkey + 2')} ELSE {KIT} END"
HYPHEN = "replace({0}, ' ', '-')"

_SOURCES: dict[str, str] = {}


def _define(name: str, sql: str) -> None:
    _SOURCES[name] = sql


# the columns of "sale" are made of these
_SALE_READS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_shipdate, "
               "o_orderpriority, o_custkey, o_totalprice, n_nationkey, r_name, p_brand, p_type, p_size, p_name, p_retailprice")
_SALE = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INT) AS qty, l_extendedprice, l_returnflag,
  l_linestatus, l_shipdate, o_orderpriority, o_custkey, o_totalprice, n_nationkey, p_brand, p_type, p_size, p_name,
  p_retailprice, {KEY} AS unique_link_key, {month('l_shipdate')} AS sale_month,
  l_orderkey * 3 + l_partkey * 5 + l_linenumber * 7 + l_suppkey * 11 AS h,
  l_orderkey + l_suppkey * 13 + CAST(l_quantity AS BIGINT) * 17 + l_partkey * 3 AS g,
  CASE r_name WHEN 'AMERICA' THEN 'AME' WHEN 'ASIA' THEN 'APJ' WHEN 'AFRICA' THEN 'APJ' ELSE 'EMEA' END AS region,
  CASE n_nationkey WHEN 2 THEN 'CN' WHEN 1 THEN 'US' WHEN 6 THEN 'CA' ELSE 'N' || {text('n_nationkey')} END AS country
FROM """
# the same join for the landing: customers meet orders and not lines, and a slice of the orders is joined alone
_SALE_SLICE = f"""
SELECT {_SALE_READS} FROM (SELECT * FROM {{lineitem}} WHERE pmod(xxhash64(l_orderkey), @N) = @I) JOIN (
  SELECT o_orderkey, o_orderpriority, o_custkey, o_totalprice, n_nationkey, r_name FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
  JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey WHERE pmod(xxhash64(o_orderkey), @N) = @I
) ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey"""

_define("sale", f"""{_SALE}{{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey
JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
JOIN {{part}} ON l_partkey = p_partkey""")

_define("service_events", f"""
SELECT unique_link_key, sale_month AS master_event_activity_month,
  CASE WHEN n_nationkey = 7 THEN 'China' ELSE region END AS region, country AS event_country_iso_cd,
  {pick('h', 'SFDC', 'WFM-IM', 'CSN', 'OTHER', 'SFDC')} AS source_system,
  'E' || {text('l_orderkey')} AS event_number, 'M' || {text('o_custkey')} AS master_event_number,
  'S-' || {text('l_orderkey')} || '-' || {text('l_linenumber')} AS so_item,
  'H' || {text('l_suppkey % 40')} AS event_hwpl, 'P-' || {text('l_partkey')} AS part_number,
  {pick('l_linenumber', 'Same Day', 'Next Day')} AS part_actual_sl, sale_month AS part_shipment_month,
  CASE WHEN qty = 13 THEN 0 ELSE qty END AS part_qty_demanded,
  CASE WHEN l_linestatus = 'F' THEN qty ELSE 0 END AS part_qty_consumed,
  {pick('g', 'Y', 'N')} AS dmr_flag, {pick('g', 'IW', 'OOW', '')} AS warranty_flag,
  {pick('h', 'ADJ', '')} AS amid2_adj
FROM {{sale}}""")

_define("returns", f"""
SELECT unique_link_key, CASE WHEN g % 3 = 0 THEN NULL ELSE sale_month END AS received_month_b, sale_month AS received_month_a,
  CAST(NULL AS TIMESTAMP) AS phy_part_no_rec_date_b,
  CASE WHEN h % 9 = 0 THEN NULL ELSE CAST('2023-12-20 10:00:00' AS TIMESTAMP) END AS phy_part_no_rec_date_a,
  CASE WHEN h % 6 = 0 THEN {tag('l_orderkey')} ELSE '' END AS flow_tag_number_b,
  CASE WHEN h % 6 = 0 THEN 'OLD' WHEN h % 41 = 7 THEN NULL ELSE {tag('l_orderkey')} END AS flow_tag_number_a,
  CASE WHEN l_returnflag = 'A' THEN 'SC99' ELSE {pick('h', *CODES)} END AS actual_disposition_a,
  CASE WHEN l_returnflag = 'A' AND g % 3 <> 0 THEN '' ELSE {pick('g', *CODES)} END AS actual_disposition_b,
  'SN' || lpad({text('l_partkey')}, 7, '0') || lpad({text('g % 30')}, 2, '0') || 'ABC' AS received_part_serial_number_a,
  {pick('h', 'X', '', '')} AS received_part_serial_number_b,
  {pick('g', *PLANTS)} AS received_plant_id_a, {pick('h', 'H499', '', '', '')} AS received_plant_id_b,
  {pick('h', 'ZA', 'ZB')} AS notification_type_a, {KIT} AS received_part_kit_part_number,
  {PHYSICAL} AS physical_part_number, CAST(g % 3 AS INT) AS part_qty_received, {pick('g', 'M', 'N')} AS match_fl,
  'ST' AS sn_transaction_status, {pick('h', 'ZOR', 'ZRE')} AS sales_doc_type, 'D' || {text('l_orderkey')} AS sales_document
FROM {{sale}} WHERE l_returnflag <> 'N'""")

_define("activity", f"""
SELECT unique_link_key, {SPL} AS event_spl FROM {{sale}} WHERE l_linenumber % 4 <> 0""")

_define("product_lines", f"""
SELECT DISTINCT 'H' || {text('s_suppkey % 40')} AS hwpl, lpad({text('s_suppkey % 40 % 25 + 1')}, 2, '0') AS spl
FROM {{supplier}} WHERE s_suppkey % 40 <> 9""")

_define("part_master", per_region(f"""
SELECT 'P-' || {text('p_partkey')} AS material, @R AS region, 'H' || {text('(p_partkey + @I) % 40')} AS hw_prod_line,
  {COMMODITY} AS part_commodity, p_name AS material_description FROM {{part}} WHERE (p_partkey + @I) % 10 <> 3""",
    "APJ", "AME", "EMEA"))

_define("repairs", f"""
SELECT event_id AS repair_id, {tag('(event_id - event_id % 3)')} AS flow_tag, ts AS upload_date,
  {month('ts')} AS upload_month, {pick('event_id', 'Valid', 'Warning', 'Valid', 'Valid', 'Invalid')} AS record_status,
  {pick(div('event_id', 3), *VENDORS, '')} AS vendor_name,
  {pick(div('event_id', 3), 'Seagate', 'seagate', 'Hitachi', 'Toshiba', '')} AS oem_name,
  {pick(div('event_id', 2), *REPAIR_FLAGS)} AS final_disposition, {pick('event_id', *WARRANTIES)} AS warranty_vendor,
  event_type, value
FROM {{events}}""")

_define("dc_returns", f"""
SELECT {tag('l_orderkey')} AS flow_tag, {HYPHEN.format(KIT)} AS spare_no, {HYPHEN.format(PHYSICAL)} AS recvd_part,
  {pick('g', *PLANTS)} AS rcvg_plant, {pick('h', *RETURN_CODES)} AS disp_location, sale_month AS report_month,
  'V' || {text('l_suppkey')} AS fl_vendor_id, {pick('h', *VENDORS, '')} AS fl_vendor_name,
  l_shipdate AS change_date, {pick('g', *RETURN_CODES)} AS disposition
FROM {{sale}} WHERE l_returnflag <> 'N' AND l_linenumber % 2 = 1""")

_define("rma", f"""
SELECT {tag('l_orderkey')} AS flow_tag, {HYPHEN.format(KIT)} AS part_number, {pick('g', 'Y', 'N')} AS cid,
  CAST(l_extendedprice / 100 AS DECIMAL(19,4)) AS actual_credit, {pick('h', 'IW Credit', 'OOW Credit', 'SC23', '')} AS disposition,
  'V' || {text('l_suppkey')} AS vendor_code, {pick('g', *VENDORS)} AS vendor_name, {pick('h', 'Yes', 'No')} AS engineer_approval,
  {pick('g', 'Pass', 'Fail')} AS nff_results, l_shipdate AS container_release
FROM {{sale}} WHERE l_returnflag = 'R'""")

for _name, _mod, _rest in (("patches_ame", 17, 3), ("patches_ame_b", 11, 3), ("patches_emea", 19, 4), ("patches_emea_b", 13, 5)):
    _define(_name, f"""
SELECT {tag('o_orderkey')} AS flow_tag, {pick('o_custkey', *REPAIR_FLAGS)} AS repair_disposition,
  {pick('o_custkey', *WARRANTIES)} AS repair_warranty_status FROM {{orders}} WHERE o_orderkey % {_mod} = {_rest}""")

_define("plant_supplier", f"""
SELECT {pick('n_nationkey', *PLANTS)} AS received_plant, 'AME' AS region, {pick('n_nationkey', *VENDORS)} AS l1_supplier_name,
  {pick('n_nationkey', 'RFC', 'Repair')} AS supplier_type FROM {{nation}} WHERE n_nationkey < 6 AND n_nationkey <> 1""")

_define("disposition_supplier", f"""
SELECT {pick('n_nationkey', *CODES)} AS disposition, 'EMEA' AS region, {pick('n_nationkey', *VENDORS)} AS l1_supplier_name,
  {pick('n_nationkey', 'RFC', 'Repair')} AS supplier_type FROM {{nation}} WHERE n_nationkey < 12 AND n_nationkey % 3 <> 0""")

_define("rfc_suppliers", f"""
SELECT {pick('n_nationkey', *VENDORS)} AS l1_supplier_name, {pick('n_nationkey', 'RFC', '', 'RFC', '', 'RFC')} AS supplier_type
FROM {{nation}} WHERE n_nationkey < 4""")

for _name, _mod in (("contract_vendor", 0), ("new_buy_vendor", 1)):
    _define(_name, f"""
SELECT region, 'P-' || {text('l_partkey')} AS part, {pick('h', 'H499', 'C299', 'AM02', 'C208', 'ZZ')} AS plant,
  {pick('g', 'NB', 'OC')} AS trans_type, {pick('g', 'C', 'F', 'F')} AS cost_type, {pick('h', *VENDORS)} AS vendor_description,
  l_shipdate AS cost_change, {period_of('g')} AS data_period FROM {{sale}} WHERE l_suppkey % 3 = {_mod}""")

_define("tag_vendor", f"""
SELECT {tag('o_orderkey')} AS flow_tag, {pick('o_custkey', 'JP One', 'JP Two')} AS final_vendor,
  {pick('o_custkey', 'CD11', 'IW Credit', 'SC23')} AS final_disposition, {period_of('o_custkey')} AS data_period
FROM {{orders}} WHERE o_orderkey % 23 = 5""")
_define("tag_supplier", f"""
SELECT {tag('o_orderkey')} AS flow_tag, {pick('o_custkey', *VENDORS)} AS l1_supplier, {period_of('o_custkey')} AS data_period
FROM {{orders}} WHERE o_orderkey % 29 = 6""")
_define("tag_flag", f"""
SELECT {tag('o_orderkey')} AS flow_tag, {pick('o_custkey', 'CD11', 'NFF', 'SC23', 'OOW Credit', '')} AS disposition,
  {period_of('o_custkey')} AS data_period FROM {{orders}} WHERE o_orderkey % 13 = 2""")

_define("l2_supplier_map", per_region(f"""
SELECT @R AS region, {pick('n_nationkey', *VENDORS, 'All Else', '')} AS l1_supplier,
  {pick('n_nationkey + @I', 'RRD', 'PCG', 'Inventec', 'Foxconn', 'Seagate', 'SPC INTERNATIONAL', 'SPC INTERNATIONAL')} AS l2_supplier,
  {pick('n_nationkey', 'RFC', 'Repair')} AS supplier_type, CASE WHEN n_nationkey = 1 THEN '{PREVIOUS}' ELSE '{PERIOD}' END AS data_period
FROM {{nation}} WHERE n_nationkey < 7 AND n_nationkey <> 2""", "APJ", "AME", "EMEA"))

_define("code_remap", f"""
SELECT 'APJ' AS region, {pick('n_nationkey', 'RP01', 'RP02', 'FG10', 'Repaired', 'Exchanged')} AS final_disp_flag,
  {pick('n_nationkey', 'OOW Repair', 'IW Exch', 'Good Unused', 'OOW Repair', 'IW Exch')} AS correct_disposition
FROM {{nation}} WHERE n_nationkey < 5""")

_define("flag_rules", f"""
SELECT {pick('n_nationkey', 'RFC', 'Repair', 'Inventec', 'Foxconn', 'SPC')} AS supplier,
  {pick(div('n_nationkey', 5), 'Repaired', 'NFF', 'Exchanged', 'Process Scrapped', 'Repaired')} AS repair_disposition,
  {pick(div('n_nationkey', 5), 'Warranty Repair', 'Non Warranty Repair', 'Warranty Repair', 'Other', 'Non Warranty Repair')}
    AS repair_warranty_status,
  {pick('n_nationkey', 'IW Credit', 'OOW Repair', 'IW Exch', 'OOW Credit', 'NFF', 'Scrap at Supplier', '')} AS final_disp_flag
FROM {{nation}}""")

_define("regional_cost", f"""
SELECT region, 'P-' || {text('l_partkey')} AS part_no, sale_month AS report_month,
  MAX({RVS.format(add=0)}) AS rvs, MAX({NRS}) AS nrs FROM {{sale}} WHERE l_partkey % 9 <> 4 GROUP BY region, l_partkey, sale_month""")
_define("sap_cost", per_region(f"""
SELECT @R AS region, 'P-' || {text('p_partkey')} AS part_number, {RVS.format(add=1)} AS rvs, {NRS} AS nrs,
  {period_of('p_size')} AS data_period FROM {{part}} WHERE (p_partkey + @I) % 2 = 0""", "APJ", "AME", "EMEA"))
_define("cost_adjustment", per_region(f"""
SELECT @R AS region, 'P-' || {text('p_partkey')} AS part_number, p_retailprice + 2e0 AS rvs, p_retailprice * 3e-1 AS nrs,
  {period_of('p_size')} AS data_period FROM {{part}} WHERE (p_partkey + @I) % 3 = 0""", "APJ", "AME", "EMEA"))
_define("service_standard", f"""
SELECT region, 'P-' || {text('l_partkey')} AS part, sale_month AS period, MAX(p_retailprice * 12e-1) AS new_buy,
  MAX(CASE WHEN p_size % 5 = 0 THEN CAST(NULL AS DOUBLE) WHEN p_size % 13 = 0 THEN -1e0 ELSE p_retailprice * 2e-1 END)
  AS out_warranty_repr FROM {{sale}} WHERE h % 3 <> 1 GROUP BY region, l_partkey, sale_month""")

_define("repair_orders", f"""
SELECT CASE WHEN region = 'AME' AND g % 2 = 0 THEN 'AMS' ELSE region END AS region, 'P-' || {text('l_partkey')} AS material,
  {pick('h', 'YI1P', 'ZSR', 'ZSRA', 'ZSX', 'ZZZ')} AS sub_order_type, '1997' AS fiscal_year,
  CASE WHEN g % 9 = 0 THEN 'Q2' ELSE 'Q1' END AS fiscal_quarter, 'V' || {text('l_suppkey')} AS vendor_id,
  'Vendor ' || {text('l_suppkey')} AS vendor_name, 'PO' || {text('l_orderkey')} AS po_number,
  CASE WHEN g % 5 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS spend,
  CASE WHEN g % 5 = 0 THEN -qty WHEN p_size = 17 THEN 0 ELSE qty END AS qty FROM {{sale}}""")
_define("repair_average", f"""
SELECT region, 'P-' || {text('l_partkey')} AS material,
  CASE WHEN MAX(p_size) % 6 = 0 THEN CAST(NULL AS DOUBLE) ELSE MAX(p_retailprice) * (5e-1 + (l_partkey % 8) * 1e-1) END AS oow_avg_repair_cost,
  CASE WHEN MAX(p_size) % 8 = 0 THEN 0e0 ELSE MAX(p_retailprice) * 3e-1 END AS oow_iw_avg_repair_cost, '{PERIOD}' AS data_period
FROM {{sale}} WHERE l_partkey % 5 <> 2 GROUP BY region, l_partkey""")

_define("variance_actuals", f"""
SELECT region, {SPL} || 'BA' AS l06_ba_code, {total('l_extendedprice')} / 100 AS actuals_usd, '{PERIOD}' AS data_period
FROM {{sale}} WHERE p_brand <> 'Brand#5' GROUP BY region, p_brand
UNION ALL SELECT region, 'ZZBA', {total('l_extendedprice')}, '{PREVIOUS}' FROM {{sale}} GROUP BY region""")
_define("defective_scrap", per_region(f"""
SELECT @R AS region, 'P-' || {text('p_partkey')} AS material, CAST(p_size AS INT) AS quantity, {period_of('p_partkey')} AS data_period
FROM {{part}} WHERE (p_partkey + @I) % 4 = 1""", "AME", "EMEA"))
_define("supplier_spend", f"""
SELECT {pick('n_nationkey', *SUPPLIERS[:-1])} AS supplier, {total('s_acctbal')} AS spend,
  {period_of('n_nationkey')} AS data_period FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
WHERE n_nationkey < 17 GROUP BY n_nationkey""")
_define("tag_charges", per_region(f"""
SELECT @R AS region, {tag('o_orderkey')} AS flow_tag, CAST(o_totalprice / 100 AS DECIMAL(19,4)) AS charge, 1 AS turn,
  {period_of('o_custkey')} AS data_period FROM {{orders}} WHERE (o_orderkey + @I) % 31 = 7
UNION ALL SELECT @R, {tag('o_orderkey')}, CAST(o_totalprice / 10 AS DECIMAL(19,4)), 2, {period_of('o_custkey')}
FROM {{orders}} WHERE (o_orderkey + @I) % 62 = 7""", "AME", "EMEA"))
_define("top_vendors", f"""
SELECT CASE WHEN n_nationkey = 19 THEN 'Expresspoint' ELSE {pick('n_nationkey', *SUPPLIERS[:-1])} END AS vendor,
  {total('s_acctbal')} * 2 AS nppo, CASE WHEN n_nationkey = 3 THEN '{PREVIOUS}' ELSE '{PERIOD}' END AS data_period
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey WHERE (n_nationkey % 2 = 0 AND n_nationkey < 18) OR n_nationkey = 19 OR n_nationkey = 3
GROUP BY n_nationkey""")
_define("part_charges", per_region(f"""
SELECT @R AS vendor, 'P-' || {text('p_partkey')} AS part_number, p_retailprice * (1 + @I) AS charge, '{PERIOD}' AS data_period
FROM {{part}} WHERE (p_partkey + @I) % 3 <> 0""", "ACCTON", "IQOR", "EATON", "SPC", "H3C", "REL") + f"""
UNION ALL SELECT 'SPC', 'Total Credit', -{total('s_acctbal')} / 10, '{PERIOD}' FROM {{supplier}}""")
_define("tag_rates", f"""
SELECT {pick('n_nationkey', *REPAIR_FLAGS[:-1])} AS repair_disposition, 1e0 + n_nationkey AS rate, '{PERIOD}' AS data_period
FROM {{nation}} WHERE n_nationkey < 3""")
_define("part_level", f"""
SELECT 'P-' || {text('p_partkey')} AS part_number, p_retailprice AS charge, {period_of('p_size')} AS data_period
FROM {{part}} WHERE p_partkey % 3 <> 1""")
_define("activity_cost", f"""
SELECT CASE WHEN s_suppkey % 6 = 0 THEN CAST(NULL AS DOUBLE) ELSE s_acctbal END AS cost, {period_of('s_suppkey')} AS data_period
FROM {{supplier}}""")

_define("week_codes", f"""
SELECT lpad({text('n_nationkey')}, 2, '0') AS week_code,
  CAST({text('1985 + ' + div('n_nationkey', 2))} || '-' || lpad({text('n_nationkey % 12 + 1')}, 2, '0') || '-28' AS DATE) AS week_beginning
FROM {{nation}}""")
_define("dmr_flags", f"""
SELECT region, 'S' || {text('l_orderkey')} || {text('l_linenumber')} AS so_item, {pick('l_orderkey', 'DMR', 'DMR', 'CDMR', '')} AS dmr_flag,
  'C' || {text('o_custkey')} AS customer_po_number FROM {{sale}} WHERE l_linenumber % 3 <> 0""")
_define("credit_rates", f"""
SELECT region, {total('o_totalprice')} / 1000 AS hdd_credit_rate, {total('o_totalprice')} / 2000 AS ssd_credit_rate,
  '{PERIOD}' AS data_period FROM {{sale}} GROUP BY region""")
_define("price_list", per_region(f"""
SELECT @R AS region, 'P-' || {text('p_partkey')} AS part_number, {COMMODITY} AS commodity, p_retailprice AS final_price,
  {period_of('p_size')} AS data_period FROM {{part}} WHERE (p_partkey + @I) % 5 <> 1""", "APJ", "AME", "EMEA"))
_define("contract_cost", f"""
SELECT region, 'P-' || {text('l_partkey')} AS part_no, sale_month AS month, 'V' || {text('l_suppkey')} AS vendor_no,
  {pick('g', 'NB', 'OC', 'NB')} AS transaction_type, {pick('h', 'AM02', 'H499', 'C299', 'ZZ')} AS org_cd,
  l_extendedprice / qty AS contract_cost,
  CASE WHEN g % 11 = 0 THEN -1e0 WHEN g % 13 = 0 THEN CAST(NULL AS DOUBLE) ELSE l_extendedprice / qty * 9e-1 END AS forecast_cost
FROM {{sale}}""")
_define("contract_cost_iw", f"""
SELECT region, 'P-' || {text('l_partkey')} AS part_no, sale_month AS month, 'V' || {text('l_suppkey')} AS vendor_no,
  {pick('h', 'AM02', 'H499', 'C299', 'ZZ')} AS org_cd, l_extendedprice / qty * 8e-1 AS contract_cost FROM {{sale}} WHERE h % 3 <> 0""")
_define("named_vendors", per_region(f"""
SELECT 'V' || {text('s_suppkey')} AS vendor, @R AS region, {period_of('s_suppkey')} AS data_period
FROM {{supplier}} WHERE (s_suppkey + @I) % 2 = 0""", "APJ", "AME", "EMEA"))
_define("kitting_fees", f"""
SELECT region, sale_month AS month, {total('l_extendedprice')} / 1000000 AS avg_kitting_fee, '{PERIOD}' AS data_period
FROM {{sale}} GROUP BY region, sale_month""")
_define("orphan_receipts", f"""
SELECT region, -{total('l_extendedprice')} / 1000 AS orphan_receipt_at_dv, -{total('l_extendedprice')} / 3000 AS orphan_receipt_at_fg,
  '{PERIOD}' AS data_period FROM {{sale}} GROUP BY region""")

_define("country_region", f"""
SELECT CASE n_nationkey WHEN 1 THEN 'US' WHEN 6 THEN 'CA' ELSE 'N' || {text('n_nationkey')} END AS iso_country_code,
  CASE WHEN n_nationkey < 10 THEN 'NA' ELSE 'LA' END AS na_vs_la FROM {{nation}} WHERE n_nationkey % 5 = 1 AND n_nationkey <> 21""")
_define("region_inventory", per_region(f"""
SELECT @R AS region, 'S' || {text('p_size % 20')} AS spl, {total('p_retailprice')} * (1 + @I) AS total_inv_cost,
  '{PERIOD}' AS data_period FROM {{part}} WHERE p_size % 20 <> 5 GROUP BY p_size % 20""", "APJ", "EMEA", "NA", "LA"))
_define("subregion_inventory", f"""
SELECT {SPL} AS spl, country AS iso_country_code, 'SR' || {text('n_nationkey % 5')} AS sub_region,
  {total('p_retailprice')} AS total_inv_cost, '{PERIOD}' AS data_period FROM {{sale}} WHERE n_nationkey % 3 = 0
GROUP BY p_brand, country, n_nationkey""")
_define("country_inventory_cost", f"""
SELECT {SPL} AS spl, country AS iso_country_code, {total('p_retailprice')} * 2 AS total_inv_cost, '{PERIOD}' AS data_period
FROM {{sale}} WHERE n_nationkey % 4 <> 1 GROUP BY p_brand, country""")
_define("country_taxes", f"""
SELECT country AS iso_country_code, CASE WHEN n_nationkey = 12 THEN 0e0 ELSE {total('o_totalprice')} / 100 END AS total_taxes,
  '{PERIOD}' AS data_period FROM {{sale}} WHERE n_nationkey <> 4 GROUP BY country, n_nationkey""")
_define("non_event_costs", f"""
SELECT region, {total('o_totalprice')} / 50 AS cost_value, '{PERIOD}' AS data_period FROM {{sale}} WHERE region <> 'EMEA' GROUP BY region""")
_define("spl_by_region", f"""
SELECT 'S' || {text('n_nationkey % 20')} AS apj_spl, CASE WHEN n_nationkey % 2 = 0 THEN 'S' || {text('n_nationkey % 20')} ELSE '' END AS emea_spl,
  CASE WHEN n_nationkey % 3 = 0 THEN 'S' || {text('n_nationkey % 20')} END AS ame_spl FROM {{nation}} WHERE n_nationkey < 12""")

# lines in the middle of the run: every column an operator reads, independent of the stages before it
_define("lines", f"""
SELECT unique_link_key, region, country AS event_country_iso_cd, sale_month AS master_event_activity_month,
  {text('CASE WHEN month(l_shipdate) >= 11 THEN year(l_shipdate) + 1 ELSE year(l_shipdate) END')} || 'Q' ||
    CASE WHEN month(l_shipdate) IN (11, 12, 1) THEN '1' WHEN month(l_shipdate) < 5 THEN '2'
         WHEN month(l_shipdate) < 8 THEN '3' ELSE '4' END AS data_period,
  'S-' || {text('l_orderkey')} || '-' || {text('l_linenumber')} AS so_item, 'P-' || {text('l_partkey')} AS part_number,
  {pick('l_linenumber', 'Same Day', 'Next Day')} AS part_actual_sl,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE {HYPHEN.format(KIT)} END AS received_part_kit_part_number,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE {HYPHEN.format(PHYSICAL)} END AS physical_part_number,
  {SPL} AS event_spl, CASE WHEN p_size % 20 = 3 THEN '' WHEN p_size % 20 = 4 THEN NULL ELSE 'S' || {text('p_size % 20')} END AS part_spl,
  {COMMODITY} AS part_commodity, CASE WHEN qty = 13 THEN 0 ELSE qty END AS part_qty_demanded,
  CASE WHEN l_linestatus = 'F' THEN qty ELSE 0 END AS part_qty_consumed, CAST(g % 3 AS INT) AS part_qty_received,
  CASE l_returnflag WHEN 'N' THEN 'No Receipt' WHEN 'A' THEN 'Logical Receipt' ELSE 'Physical Receipt' END AS receipt_type,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE {tag('l_orderkey')} END AS flow_tag,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE {pick('h', *CODES)} END AS actual_disposition,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE sale_month END AS received_month,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE {pick('g', *PLANTS)} END AS received_plant,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST('2023-12-20 10:00:00' AS TIMESTAMP) END AS phy_part_no_rec_date,
  CASE WHEN l_returnflag = 'N' THEN NULL WHEN h % 10 = 1 THEN 'SN' || lpad({text('l_partkey')}, 7, '0') || lpad({text('g % 30')}, 2, '0') || 'AB'
       WHEN h % 10 = 2 THEN 'SN' || lpad({text('l_partkey')}, 7, '0') || lpad({text('g % 30')}, 2, '0') || 'ABCD'
       ELSE 'SN' || lpad({text('l_partkey')}, 7, '0') || lpad({text('g % 30')}, 2, '0') || 'ABC' END AS ct_code_label,
  {pick('g', 'IW', 'OOW', '')} AS warranty_flag, {pick(div('h', 3), 'DMR', 'No DMR')} AS dmr_status,
  {pick('h', *VENDORS, '')} AS repair_vendor, {pick('g', 'Y', 'N', 'Y', '')} AS repair_tag_used,
  {pick(div('g', 5), 'Seagate', 'seagate', 'Hitachi', 'Toshiba', '')} AS repair_oem_name,
  {pick(div('h', 2), *REPAIR_FLAGS)} AS repair_disposition, {pick(div('g', 2), *WARRANTIES)} AS repair_warranty_status,
  {pick(div('h', 5), *PLANTS, '', '', '')} AS dcr_received_plant, {pick(div('g', 4), *RETURN_CODES, '', '')} AS dcr_disposition,
  {pick(div('h', 4), *VENDORS, '', '')} AS dcr_vendor_name, {pick(div('g', 3), 'Y', 'N', '')} AS rma_cid,
  CAST(l_extendedprice / 100 AS DECIMAL(19,4)) AS rma_credit, {pick(div('h', 7), 'IW Credit', 'OOW Credit', 'SC23', '', '')} AS rma_disposition,
  {pick(div('g', 7), *VENDORS, '', '', '')} AS rma_vendor_name, {pick(div('h', 6), 'Yes', 'No', '')} AS rma_engineer_approval,
  {pick(div('g', 6), 'FG10', 'CD11', 'SC23', 'IW Credit', 'RP01', '')} AS hub_disposition,
  {pick(div('h', 8), *L1_SUPPLIERS)} AS l1_supplier, {pick(div('g', 8), 'RWT', 'CCS NB', 'CCS Return')} AS l1_supplier_source,
  {pick(div('h', 9), *SUPPLIERS)} AS l2_supplier, {pick(div('g', 9), 'RFC', 'Repair', '')} AS supplier_type,
  {pick(div('g', 10), *FLAGS)} AS final_disp_flag,
  {RVS.format(add=0)} AS event_pn_rvs, {NRS} AS event_pn_nrs,
  CASE WHEN h % 7 = 0 THEN CAST(NULL AS DOUBLE) WHEN h % 7 = 1 THEN 0e0 WHEN h % 7 = 2 THEN p_retailprice ELSE p_retailprice + 5e0 END AS kit_pn_rvs,
  CASE WHEN g % 7 = 0 THEN CAST(NULL AS DOUBLE) WHEN g % 7 = 1 THEN 0e0 WHEN g % 7 < 4 THEN p_retailprice + 5e0 ELSE p_retailprice + 8e0 END AS physical_pn_rvs,
  CASE WHEN g % 6 = 0 THEN CAST(NULL AS DOUBLE) ELSE p_retailprice * 12e-1 END AS physical_pn_nbs,
  CASE WHEN h % 8 = 0 THEN CAST(NULL AS DOUBLE) WHEN h % 8 = 1 THEN -1e0 WHEN h % 8 = 2 THEN 0e0 ELSE p_retailprice * 5e-1 END AS oow_avg_repair_cost,
  CASE WHEN g % 8 = 0 THEN CAST(NULL AS DOUBLE) WHEN g % 8 = 1 THEN -1e0 WHEN g % 8 = 2 THEN 0e0 ELSE p_retailprice * 3e-1 END AS oow_iw_avg_repair_cost,
  CAST(CASE WHEN h % 6 = 0 THEN NULL WHEN h % 6 = 1 THEN 3.0 ELSE (g % 60) / 10.0 END AS DECIMAL(18,1)) AS part_age,
  CASE WHEN g % 5 = 0 THEN CAST(NULL AS DOUBLE) WHEN g % 5 = 1 THEN 0e0 WHEN g % 5 = 2 THEN 12e-1 ELSE -25e-1 * (h % 9) END AS credits,
  {pick(div('h', 10), 'CCS NB Fcst', 'CCS NB Fcst - Blank Part Age', 'DMR Credit', '')} AS credit_comments,
  CASE WHEN h % 9 = 0 THEN CAST(NULL AS DOUBLE) ELSE p_retailprice END AS cons_cost,
  CASE WHEN g % 9 = 0 THEN CAST(NULL AS DOUBLE) ELSE l_extendedprice / 100 END AS nppo_cost,
  CASE WHEN h % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE 1e0 * (h % 11) END AS relabel_cost,
  CASE WHEN g % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE 2e0 * (g % 11) END AS dekit_cost,
  CAST(CASE WHEN g % 4 = 0 THEN NULL ELSE l_extendedprice / 100 END AS DECIMAL(19,4)) AS taxes,
  CAST(NULL AS DOUBLE) AS country_inv_costs, CASE WHEN h % 3 = 0 THEN CAST(NULL AS DOUBLE) ELSE 15e-1 * (h % 7) END AS region_inv_costs,
  CASE WHEN h % 9 = 0 THEN CAST(NULL AS DOUBLE) ELSE p_retailprice + l_extendedprice / 100 END AS total_matl_cost
FROM {{sale}}""")

# inventory model
for _name, _skip in (("stock_start", 11), ("stock_end", 10)):
    _define(_name, f"""
SELECT region, {SPL} AS support_product_line, {pick('n_nationkey', 'North', 'South')} AS subregion, {pick('l_suppkey', 'Hub', 'Spoke', 'Field')} AS type,
  CASE n_nationkey WHEN 2 THEN 'China' WHEN 1 THEN 'United States' WHEN 6 THEN 'Canada' ELSE 'N' || {text('n_nationkey')} END AS country,
  'PL' || {text('l_suppkey % 9')} AS plant, {pick('l_partkey', 'FG01', 'CU02', 'RF03', 'QC04', '#')} AS location,
  CASE WHEN l_linestatus = 'F' THEN 'Good' ELSE 'Bad' END AS condition, CASE WHEN l_suppkey % 10 = 4 THEN 'DWIA LOTS' ELSE 'MAIN' END AS source,
  CASE WHEN p_brand = 'Brand#9' THEN 0e0 ELSE {total('l_extendedprice')} END AS value_current, {total('l_extendedprice')} / 10 AS reserve_current
FROM {{sale}} WHERE l_linenumber <> 0 AND o_custkey % {_skip} <> 0
GROUP BY region, p_brand, n_nationkey, l_suppkey, l_partkey % 5, l_linestatus, l_partkey""")
_define("special_keys", f"""
SELECT 'PL' || {text('n_nationkey % 9')} || {pick('n_nationkey', 'FG01', 'CU02', 'RF03')} AS inv_plant_location,
  'SPECIAL' || {text('n_nationkey')} AS special_alloc_key FROM {{nation}} WHERE n_nationkey < 9 AND n_nationkey % 2 = 0""")
_define("cube_cost", per_region(f"""
SELECT @R AS region_l2, {SPL} AS spl, 'Std Rev Costs' AS type, {total('p_retailprice')} AS adj_cube FROM {{part}} WHERE p_brand <> 'Brand#7' GROUP BY p_brand
UNION ALL SELECT @R, {SPL}, 'E&O Costs', {total('p_retailprice')} / 7 FROM {{part}} WHERE p_brand <> 'Brand#8' GROUP BY p_brand""",
    "APJeC", "EMEA", "NA", "LA"))

# interim, checks, shipments
_define("cost_adders", per_region(f"""
SELECT @R AS region, {SPL} AS event_spl, MAX(p_retailprice) / 10 AS non_nrs_rate, '{PERIOD}' AS data_period
FROM {{part}} WHERE p_brand <> 'Brand#3' AND p_brand <> 'Brand#14' GROUP BY p_brand
UNION ALL SELECT @R, 'All Others', 5e0 + @I, '{PREVIOUS}' FROM {{region}} WHERE r_regionkey < 2""", "APJ", "AME", "EMEA"))
_define("accounting", f"""
SELECT region, sale_month AS month, lpad({text('l_suppkey % 40 % 25 + 1')}, 2, '0') AS spl, SUM(qty) AS cons_qty
FROM {{sale}} WHERE l_orderkey % 10 <> 0 AND l_linestatus = 'F' GROUP BY region, sale_month, l_suppkey % 40 % 25""")
_define("accounting_named", f"""
SELECT region, 'M' || month AS month, spl, CAST(cons_qty AS BIGINT) AS cons_qty FROM {{accounting}}""")
_define("month_names", f"""
SELECT DISTINCT 'M' || {month('l_shipdate')} AS column_name, {month('l_shipdate')} AS month_transformed FROM {{lineitem}}
WHERE month(l_shipdate) <> 6""")
_define("shipments", f"""
SELECT unique_link_key, {pick('h', 'ZMUL', 'ZIC', 'ZZZZ', 'FLSO', 'QQ')} AS so_po_document_type, qty AS shipped_qty FROM {{sale}}
WHERE g % 4 <> 0""")


def dependencies(*names: str) -> list[str]:
    """The stand-ins needed for the given ones, in order of definition."""
    needed: set[str] = set()

    def visit(name: str) -> None:
        if name in needed or name in BASE_TABLES:
            return
        needed.add(name)
        for other in (*BASE_TABLES, *_SOURCES):
            if "{" + other + "}" in _SOURCES[name]:
                visit(other)

    for name in names:
        visit(name)
    return [n for n in _SOURCES if n in needed]


def ctes(*names: str) -> list[str]:
    """The stand-ins as common table expressions for the checking database."""
    own = {n: n for n in (*BASE_TABLES, *_SOURCES)}
    return [f"{n} AS ({_SOURCES[n].format(**own).strip()})" for n in dependencies(*names)]


# landed once per session and directory, when a query first needs it: the join that the others are projections of. Those are
# not landed themselves, as each query reads a few of their columns only
LANDED = ("sale",)
_ROWS_PER_FILE = 50_000
# bytes of lines and orders that are joined at once, so that the shuffles of one slice are gone before the next, and slices at most
_SLICE_BYTES, _SLICES = 64 << 20, 8
_beds: dict[tuple[str, str], Bed] = {}


def landed_bed(spark: SparkSession, directory: str) -> Bed:
    """The bed of a directory whose shared tables land in split files, as loads leave them; one for all queries of a session."""
    key = (spark.sparkContext.applicationId, directory)
    if key not in _beds or not _beds[key].stands():
        _beds[key] = Bed(spark, directory, LANDED)
    return _beds[key]


class Bed:
    """Stand-ins as DataFrames over one directory of benchmark tables. landed: those that are written when first used."""

    def __init__(self, spark: SparkSession, directory: str, landed: tuple[str, ...] = ()):
        self.spark, self.directory, self.landed = spark, directory, landed
        self._made: dict[str, DataFrame] = {}
        self._stored: set[str] = set()
        self._landed: dict[str, list[str]] = {}
        self._folder = Folder(spark, f"{checkpoint_dir(spark)}/bed-{uuid.uuid4().hex}")

    def store(self, *names: str) -> Bed:
        """Write stand-ins that many others are derived from, as landed tables would be; once each."""
        for name in names:
            if name not in self._stored or not self.stands():
                self._landed.pop(name, None)
                self._made[name] = self._sale() if name == "sale" else self._written(self._defined(name), name)
                self._stored.add(name)
        return self

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self._folder.path}/{name}"
        df.write.mode("overwrite").option("maxRecordsPerFile", _ROWS_PER_FILE).option("compression", "zstd").parquet(path)
        self._landed.setdefault(name.split("/")[0], []).append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def _sale(self) -> DataFrame:
        """Only what "sale" is made of is landed, slice by slice; keys, months and numbers are made again where it is read."""
        tables = Folder(self.spark, self.directory)
        slices = min(_SLICES, 1 + sum(tables.size(f"{t}.parquet") for t in ("lineitem", "orders")) // _SLICE_BYTES)
        for i in range(slices):
            rows = self._written(self._from(_SALE_SLICE.replace("@N", str(slices)).replace("@I", str(i))), f"sale/{i}")
        paths = [f"{self._folder.path}/{name}" for name in self._landed["sale"]]
        return self.spark.sql(f"{_SALE}{{landed}}", landed=self.spark.read.schema(rows.schema).parquet(*paths))

    def stands(self) -> bool:
        """Whether all that this bed has written is still there."""
        return all(self._folder.exists(f"{name}/_SUCCESS") for names in self._landed.values() for name in names)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in self.landed:
                self.store(name)
            else:
                self._made[name] = self._defined(name)
        return self._made[name]

    def _defined(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return read_table(self.spark, self.directory, name)
        return self._from(_SOURCES[name])

    def _from(self, sql: str) -> DataFrame:
        used = [n for n in (*BASE_TABLES, *_SOURCES) if "{" + n + "}" in sql]
        return self.spark.sql(_listed(sql), **{n: self[n] for n in used})


def _listed(sql: str) -> str:
    """The same values for Spark with lists that are split once: split_part splits its list again for every row.

    A null index gives null, as in split_part; element_at would be taken for never null.
    """
    return re.sub(r"split_part\('([^']*)', ';', ", r"try_element_at(split('\1', ';'), ", sql)
