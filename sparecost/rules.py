"""Business parameters of the cost model.

The codes, names, factors and labels below are fixed values: results depend on them, so they are
stated once, as data, and the plans read them from here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values ---------------------------------------------------------------

REGIONS = ("APJ", "AME", "EMEA")
EXCLUDED_REGION = "China"
EXCLUDED_COUNTRY = "CN"
SOURCE_SYSTEMS = ("SFDC", "WFM-IM", "CSN")
REPAIR_STATUSES = ("Valid", "Warning")

NO_RECEIPT = "No Receipt"
LOGICAL_RECEIPT = "Logical Receipt"
PHYSICAL_RECEIPT = "Physical Receipt"
LOGICAL_CODE = "SC99"
UNKNOWN_LOCATION = "XXXX"
HUB_PLANT = "H499"

HARD_DRIVE = "Hard Drive"
SOLID_STATE = "Solid State Drive"
MEMORY = "Memory"
PROCESSOR = "CPU"

ALL_ELSE = "All Else"
ALL_OTHERS = "All Others"
TOTAL_CREDIT = "Total Credit"

SHIPMENT_DOCUMENT_TYPES = (
    "ZMUL", "ZMLI", "ZSSB", "ZSKB", "ZSOE", "ZSPC", "ZSIU", "ZPPI", "ZPTP", "ZSTF", "FLSO", "ZSTE",
    "ZS1O", "ZSGR", "ZSOR", "ZDEF", "ZDFI", "ZSTD", "ZPHI", "ZPMI", "ZPTH", "ZPTM", "ZSEO", "ZSCB",
    "ZSTG", "ZPFI", "ZPTF", "ZSFD", "ZSCR", "ZSOB", "ZFTR", "ZSOF", "ZSOV", "ZIC", "ZI1O",
)

OOW_ORDER_TYPES = ("YI1P", "ZSR", "ZSRA")
ALL_ORDER_TYPES = ("YI1P", "ZSR", "ZSRA", "ZSX")

# contract vendors: cost type and plants by region
CONTRACT_COST_TYPE = {"APJ": "C", "AME": "F", "EMEA": "F"}
CONTRACT_PLANTS = {
    "APJ": ("H499",),
    "AME": ("C299", "C208", "C212", "C240"),
    "EMEA": ("AM02",),
}
CONTRACT_ORGS = ("AM02", "H499", "C299")

RFC_SUPPLIER = "CONVERGE INC"
CREDIT_SUPPLIER_PREFIXES = ("PCG", "CONVERGE")

SCRAP_CODES = ("SC01", "SC12", "SC02", "SCRU", "EC01", "EC02", "EC11")
TRANSIT_CODES = ("CD11", "IT21")
GOOD_UNUSED_PREFIXES_APJ = ("FG", "QC")
GOOD_UNUSED_PREFIXES = ("FG", "CU", "QC", "DS")
STANDARD_COST_DISPOSITIONS = ("Unknown", "WT02", "QT20", "In Transit")
FLAG_SUPPLIERS = ("Inventec", "Foxconn", "SPC")
FLAG_SUPPLIER_TYPES = ("RFC", "Repair")

CREDIT_FLAGS = ("IW Credit", "OOW Credit")
PRICED_FLAGS = ("IW Credit", "OOW Credit", "NFF", "Scrap at Supplier")
MEMORY_FACTOR = 0.88
SCRAP_FACTOR = 0.06
AGED_FACTOR = 0.5
AGE_LIMIT = 3.0

DRIVE_SUPPLIER = "RRD"
DRIVE_MAKER = "seagate"
POOLED_PAYERS = ("RRD", "Seagate")
POOLED_USERS = ("RRD", "Toshiba", "Seagate")
APJ_DRIVE_SUPPLIERS = ("RRD", "HITACHI GST", "TOSHIBA", "WESTERN DIGITAL")
APJ_NAMED_SUPPLIERS = ("RRD", "seagate", "HITACHI GST", "WESTERN DIGITAL", "TOSHIBA")

SAME_DAY_SUPPLIER = "Expresspoint"
SAME_DAY_SUPPLIER_L1 = "EXPRESSPOINT TECHNOLOGY SERVICES"
SAME_DAY_LEVEL = "Same Day"
SAME_DAY_COUNTRIES = ("CA", "US")
RESTRICTED_FLAGS = ("IW Credit", "NFF", "Scrap at Supplier", "Scrap in Central")

# per-part vendor charges: how each vendor is told from the second-level supplier
PART_CHARGE_PREFIXES = {"ACCTON": "ACCTON", "IQOR": "IQOR", "EATON": "EATON", "SPC": "SPC", "H3C": "H3C"}
PART_CHARGE_NAMES = {"REL": "RENFREWSHIRE ELECTRONICS LTD"}
SHARED_CREDIT_VENDOR = "SPC"

NORTH_AMERICA = ("Canada", "United States")
EVENT_LOCATION_TYPES = ("FG", "CU", "DS", "RF", "OR")
INVENTORY_EXCLUDED_SOURCE = "DWIA LOTS"
INVENTORY_EXCLUDED_COUNTRY = "China"
REVALUATION_COST = "Std Rev Costs"
RESERVE_COST = "E&O Costs"

# ---- what changes from quarter to quarter ---------------------------------------


@dataclass(frozen=True)
class Period:
    """Parameters of one quarterly run."""

    period: str = "2017Q1"
    start_month: str = "201611"
    end_month: str = "201701"
    cost_month: str = "201701"
    mid_quarter: str = "2016-12-15"
    repair_cutoff: str = "2017-06-09 00:00:00"
    return_cutoff_month: str = "201703"
    rma_cutoff_month: str = "201704"


    @classmethod
    def relative(cls, period: str, start_month: str, end_month: str, cost_month: str, mid_quarter: str, months: int = 2) -> Period:
        """Cut-offs that follow the cost month: what came up to `months` months after it counts."""
        last = add_months(cost_month, months)
        after = add_months(last, 1)
        return cls(
            period, start_month, end_month, cost_month, mid_quarter, repair_cutoff=f"{after[:4]}-{after[4:]}-01 00:00:00",
            return_cutoff_month=last, rma_cutoff_month=last,
        )


def add_months(month: str, n: int) -> str:
    """YYYYMM text n months later, by the calendar."""
    at = int(month[:4]) * 12 + int(month[4:]) - 1 + n
    return f"{at // 12:04d}{at % 12 + 1:02d}"


@dataclass(frozen=True)
class Options:
    """Choices between variants of the model.

    strict: keep two inherited quirks (first supplier assignment always types APJ lines 'Repair'); without it the input
    rfc_suppliers is needed.
    priced_by_consumed: older priced-credit rule, consumed quantity in place of received = 1.
    maker_credits: forecast credits by maker; without it the older rules: one forecast rule for the drive supplier, the kitting
    fee on its lines, and every other supplier by contract.
    line_inventory: inventory cost by region, with AME split, and the part's product line; without it the older pools: sub-region and
    country, then region by the event's product line, from the inputs subregion_inventory and country_inventory_cost.
    """

    strict: bool = True
    priced_by_consumed: bool = False
    maker_credits: bool = True
    line_inventory: bool = True
    interim_keys: tuple = field(default=("region", "part_number", "warranty_flag", "dmr_status"))


OLDER = Options(priced_by_consumed=True, maker_credits=False, line_inventory=False)
