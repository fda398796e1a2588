"""Business-unit differences as data."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SohPolicy:
    """How one business unit's on-hand file turns into a snapshot.

    ``codes`` are the type codes of credit, consign and perishable: ``None`` is always 0,
    ``"*"`` takes every row. ``total`` is ``"all"`` or ``"credit+perishable"``. ``kind_if_missing``
    stands in for a file without the type column; ``checked_date`` reads impossible dates as null.
    """

    bu: str
    value: str = "msstoh"
    kind: str | None = "mstype"
    codes: tuple[str | None, str | None, str | None] = ("1", "2", "3")
    total: str = "all"
    store: str = "msstor"
    date: str = "msasdt"
    add_century: bool = False
    null_to_zero: bool = False
    positive_only: bool = True
    kind_if_missing: str | None = None
    checked_date: bool = False
    vendor: str = "msvdno"
    sub_dept: str = "mssdpt"
    skip_sub_depts: tuple[str, ...] = ()
    blocks_vendors: bool = False
    audit_after_filter: bool = False


# Unit codes, column names, type codes and total rules of the on-hand files.
SOH_POLICIES: dict[str, SohPolicy] = {
    "PWB": SohPolicy("PWB"),
    "CHG": SohPolicy("CHG", null_to_zero=True),
    "CFW": SohPolicy("CFW", null_to_zero=True, positive_only=False, kind_if_missing="1", checked_date=True),
    "OFM": SohPolicy(
        "OFM",
        codes=("01", "02", "03"),
        total="credit+perishable",
        add_century=True,
        audit_after_filter=True,
    ),
    "SSP": SohPolicy(
        "SSP",
        value="soh",
        kind="sku_t",
        codes=("01", None, "03"),
        total="credit+perishable",
        store="store",
        date="as_of_date",
        add_century=True,
    ),
    "B2S": SohPolicy(
        "B2S",
        codes=("01", "02", "03"),
        add_century=True,
        skip_sub_depts=("600", "700"),
        blocks_vendors=True,
    ),
    "SSP-WDS": SohPolicy(
        "SSP", value="soh", kind=None, codes=("*", None, None), store="stcode", date="data_date"
    ),
}

# Vendor names that are reported as one outsource group.
OUTSOURCE_ALIASES = {"AJIS": "OUTSOURCE", "INNOVATION": "OUTSOURCE", "SSD": "OUTSOURCE", "PCS": "OUTSOURCE"}

# Checklist zones.
ZONES = {"B": "Back", "F": "Sale"}

# Header names of the checklist forms, cleaned.
FORM_NAMES = {
    "start time": "created",
    "รหัสสาขา": "stcode",
    "รหัสสาขา (store code)": "stcode",
    "วันที่ตรวจนับ": "check_date",
    "วันที่นับ full stock count": "check_date",
}

# Question codes of the checklist forms as prefix and highest number.
QUESTIONS = {
    "b2s": (("b2sv1f", 43), ("b2sv1b", 8)),
    "ofm": (("ofmv1a", 35), ("ofmv1b", 17), ("ofmv1f", 9)),
    "pwb": (("pwbv1f", 39), ("pwbv1b", 14)),
    "ssp": (("sspv1a", 35),),
    "chg": (("chgv01a", 41),),
    "cfr": (("cfrtmrv2b", 37), ("cfrtmrv2f", 31)),
    "cfr_cmk": (("cmk", 35),),
    "cfr_tca": (("cfrtca", 30),),
}

# Store types left out of the completeness check, by report family.
TYPES_NOT_REPORTED = {
    "J": ("Warehouse", "Online"),
    "other": ("Warehouse", "Frozen", "Wine", "Tops Care", "WHSVC", "Online"),
}

# Time-off request types that are not time off.
TIME_OFF_EXCLUDED = (
    "Off-Site Work (ปฏิบัติงานนอกสถานที่ )",
    "OT Request (ขออนุมัติเวลาการทำ OT)",
)

# Expiry-check fee by unit, store type and vendor.
EXPIRY_FEE_UNIT = "CFR"
EXPIRY_FEE_TYPES = ("TM", "FH")
EXPIRY_FEES = ((("PCS", "AJIS"), 1000), (("SSD",), 900))

# Metropolitan provinces of the day-rate area.
METRO_AREA = "BKK"
UPCOUNTRY_AREA = "UPC"
METRO_PROVINCES = (
    "กรุงเทพมหานคร",
    "นนทบุรี",
    "สมุทรปราการ",
    "นครปฐม",
    "สมุทรสาคร",
    "ปทุมธานี",
)
METRO_EXTRA = (("สุราษฎร์ธานี", "AJIS"),)


@dataclass(frozen=True)
class Rate:
    """One line of the day-rate tariff; empty fields do not restrict. The first match counts."""

    price: int
    vendor: str
    season: str | None = None
    area: str | None = None
    bu: str | None = None
    not_bu: str | None = None
    months: tuple[str, ...] = ()


# Day rates.
RATES = (
    Rate(500, "Store"),
    Rate(500, "PSTDIV"),
    Rate(600, "Daywork"),
    Rate(900, "SSD"),
    Rate(950, "HRoot"),
    Rate(575, "Smollan", season="Moon"),
    Rate(600, "Smollan", season="Night"),
    Rate(700, "Innovation", season="Moon"),
    Rate(780, "Innovation", season="Night"),
    Rate(1000, "PCS", area="BKK"),
    Rate(1500, "PCS", area="UPC"),
    Rate(1000, "AJIS", season="Moon", not_bu="CFW"),
    Rate(1100, "AJIS", season="Night", not_bu="CFW", months=("1", "4", "5", "6", "7", "12")),
    Rate(1200, "AJIS", season="Night", not_bu="CFW", months=("2", "3", "8", "9", "10", "11")),
    Rate(1500, "AJIS", bu="CFW"),
)

# Dimensions of the day-rate grid.
VENDORS = ("AJIS", "PCS", "SSD", "Innovation", "Smollan", "Daywork", "PSTDIV", "Store", "HRoot")
SEASONS = ("Moon", "Night")
MONTHS = (
    ("1", "January"),
    ("2", "February"),
    ("3", "March"),
    ("4", "April"),
    ("5", "May"),
    ("6", "June"),
    ("7", "July"),
    ("8", "August"),
    ("9", "September"),
    ("10", "October"),
    ("11", "November"),
    ("12", "December"),
)
