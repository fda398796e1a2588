"""Item masters, counting packages and the tables they refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import clean, maintain
from ..operators.gates import planned_only
from ..operators.ranking import distinct_on, keep_first
from ..operators.reshape import unpivot_barcodes, wide_barcodes
from ..operators.sets import concat_diagonal_unique, drop_dupes, union_all, union_distinct

# Barcode columns of the item master.
BARCODE_COLUMNS = ("ibc", "sbc#1", "sbc#2", "sbc#3", "sbc#4", "sbc#5")
UNCOUNTED_SKU_TYPE = "03"


def barcode_master(master: DataFrame) -> DataFrame:
    """(sku, upc, des, price, dept): one row per usable barcode of an item."""
    named = clean.rename_map(master, {"sku_descr": "des", "org_price": "price"})
    return unpivot_barcodes(named, "sku_no", BARCODE_COLUMNS, ["des", "price", "dept"])


def package_barcodes(barcodes: DataFrame) -> DataFrame:
    """Barcodes of a counting package: every upc, plus the padded item number once per item."""
    columns = [F.col("des").alias("productName"), F.lit(0).alias("stock"), F.col("price").alias("retailPrice"), F.lit("A").alias("status")]
    by_sku = barcodes.select(text.lpad_code("sku", 13).alias("ibc"), *columns).distinct()
    return union_all(barcodes.select(F.col("upc").alias("ibc"), *columns), by_sku)


def package_items(master: DataFrame, **stocktake: str) -> DataFrame:
    """Wide item rows of a counting package, tagged with its stocktake."""
    counted = master.filter(F.col("sku_type") != UNCOUNTED_SKU_TYPE)
    prepared = counted.select(
        F.col("vendor").alias("vendorCode"),
        F.col("v_name").alias("vendorName"),
        text.lpad_code("sku_no", 13).alias("sku"),
        text.lpad_code("sku_no", 13).alias("barcodeIBC"),
        *[F.col(f"`{c}`") for c in BARCODE_COLUMNS],
        text.scrub("sku_descr").alias("productName"),
        F.col("color_des").alias("color"),
        F.col("inner_pack").alias("unitOfMeasure"),
        F.col("size_des").alias("size"),
        F.col("reg_retail").alias("cost"),
        F.lit(0).alias("stock"),
        F.lit("A").alias("status"),
    )
    rest = [c for c in prepared.columns if c not in BARCODE_COLUMNS]
    return clean.with_constants(wide_barcodes(prepared, BARCODE_COLUMNS, rest), **stocktake)


def package_users(employees: DataFrame, fixed: DataFrame, today: str) -> DataFrame:
    """Users of a package: employees still working, and the fixed accounts, each once."""
    working = clean.active_as_of(employees, "last_work_date", F.lit(today).cast("date"))
    names = F.col("eng_name")
    users = working.select(
        F.col("employee_code").alias("username"),
        text.name_part(names, " ", 1).alias("firstName"),
        text.name_part(names, " ", 2).alias("lastName"),
        F.col("sub_hub").alias("hub"),
        "position",
    )
    return union_distinct(users, fixed.select(*users.columns))


def package_locations(locations: DataFrame) -> DataFrame:
    """Locations of every stocktake, each once."""
    return locations.select("location", F.col("cntnum").alias("stocktakeId")).distinct()


def scan_master(raw: DataFrame) -> DataFrame:
    """Master addressable by barcode and by sku, one row per stocktake, barcode and sku."""
    by_sku = raw.drop("barcode").withColumn("barcode", F.col("sku"))
    rest = [c for c in raw.columns if c not in ("stocktakeid", "barcode", "sku")]
    return concat_diagonal_unique(raw, by_sku, ["stocktakeid", "barcode", "sku"], rest)


def load_master(
    incoming: DataFrame, plan: DataFrame, registered: DataFrame, master: DataFrame
) -> dict[str, DataFrame]:
    """New master and register: unknown planned stocktakes are added, known ones replaced."""
    keys = ["stocktakeid", "bu", "stcode", "cntdate"]
    headers = incoming.select(*keys).distinct()
    states = maintain.registration_state(headers, plan, registered, master)
    accepted = states.filter(F.col("state") != maintain.REJECT)
    rows = planned_only(incoming, accepted, ["stocktakeid"])
    branches = distinct_on(plan.select("bu", "stcode", "cntdate", "branch"), ["bu", "stcode", "cntdate"], ["branch"])
    fresh = (
        states.filter(F.col("state") == maintain.REGISTER)
        .join(branches, ["bu", "stcode", "cntdate"], "inner")
        .select(*keys, "branch", F.lit("C1").alias("status"))
    )
    return {
        "master": maintain.replace_keys(master, rows, ["stocktakeid"]),
        "registered": maintain.insert_if_absent(registered, fresh, ["stocktakeid"]),
    }


def bilingual_items(items: DataFrame) -> DataFrame:
    """One row per barcode and item, a row with a Thai name before one without."""
    flagged = items.withColumn("has_thai", text.has_script("ItemNameTH"))
    order = [F.col("has_thai").desc_nulls_last(), F.col("ItemNameTH").asc_nulls_last()]
    return keep_first(flagged, ["Barcode", "Item"], order)


def reference_table(raw: DataFrame, keep: Sequence[str], key: Sequence[str] = ()) -> DataFrame:
    """Reference file as loaded: clean names and cells, chosen columns, no duplicate rows."""
    df = clean.keep(clean.clean_cells(clean.normalise_names(raw)), keep)
    return drop_dupes(clean.require(df, key) if key else df)


# Key groups by which the report families are archived.
ARCHIVE_KEYS = {
    "J": ("store", "cntdate", "skutype", "rpname"),
    "U": ("stmerch", "cntdate", "skutype", "rpname"),
    "C": ("stcode", "cntdate", "skutype", "rpname"),
    "J-var": ("countname", "store", "skutype", "rpname"),
    "U-var": ("cntnum", "rpname", "prtype"),
    "sale": ("mdstor", "cntdate"),
}


def archive_family(source: DataFrame, archive: DataFrame, family: str, lo: str, hi: str, date: str = "cntdate") -> DataFrame:
    """Rows to add to a family's archive; detail without a date column is dated by its count number."""
    rows = source
    if date not in source.columns:
        rows = source.withColumn(date, text.cntnum_date_right("cntnum" if "cntnum" in source.columns else "countname"))
    new = maintain.rows_to_archive(rows, archive, ARCHIVE_KEYS[family], date, lo, hi)
    return new.select(*source.columns)
