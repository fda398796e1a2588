"""Edits laid over scanned counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..functions.measures import as_double, exact
from .clean import prefixed
from .joins import barcode_lookup
from .ranking import latest_per_group

PLACE = ["stocktakeid", "location", "seq"]


def scan_lines(raw: DataFrame, prefix: str) -> DataFrame:
    """Scan lines of the stocktakes with the prefix; the item number sits inside the scanned code."""
    return prefixed(raw, "stocktakeid", prefix).withColumn("sku", F.substring("sku", 6, 8))


def dated_master(master: DataFrame, date: str = "sdate") -> DataFrame:
    """Package master with its ``dd/mm/yyyy`` date as the count date."""
    return master.withColumn("cntdate", date_key(date, "dd/MM/yyyy"))


def latest_edits(edits: DataFrame, master: DataFrame) -> DataFrame:
    """Newest edit per place, barcode and item; edits of unknown barcodes drop out."""
    found = edits.join(barcode_lookup(master, ["stocktakeid"]), ["stocktakeid", "barcode"], "inner")
    return latest_per_group(found, [*PLACE, "barcode", "sku"], ["id"]).select(*PLACE, "sku", "qnt")


def overlay_edits(
    scans: DataFrame,
    edits: DataFrame,
    master: DataFrame,
    known_only: bool = False,
    details: Sequence[str] = (),
) -> DataFrame:
    """Scan lines with the edited quantity where there is one, plus edits without a scan.

    scans(stocktakeid, location, seq, sku, qnt), edits(id, stocktakeid, location, seq, barcode,
    qnt), master(stocktakeid, sku, barcode, price, stcode, cntdate). ``known_only`` also drops
    scans whose item has no store in the master; ``details`` are further master columns to show.
    """
    edited = latest_edits(edits, master).withColumnRenamed("qnt", "__edit")
    items = master.select("stocktakeid", "sku", "price", "stcode", "cntdate", *details)
    # One line of one place is one key, so the full join has no large groups.
    lines = scans.withColumn("__scanned", F.lit(True)).join(edited, [*PLACE, "sku"], "full")
    scanned = F.col("__scanned").isNotNull()
    kept = scanned | F.col("price").isNotNull()
    if known_only:
        kept = kept & F.col("stcode").isNotNull()
    counted = F.when(scanned, F.coalesce("__edit", "qnt")).otherwise(F.col("__edit"))
    return (
        lines.join(items, ["stocktakeid", "sku"], "left")
        .filter(kept)
        .select(*PLACE, "sku", counted.alias("qnt"), "price", "stcode", "cntdate", *details)
    )


def overlay_totals(lines: DataFrame, details: Sequence[str] = ()) -> DataFrame:
    """Quantity and amount per stocktake, store, date and item (and its ``details``)."""
    amount = exact(lines, F.col("qnt") * F.col("price"))
    return lines.groupBy("stocktakeid", "stcode", "cntdate", "sku", *details).agg(
        as_double(F.sum(exact(lines, "qnt"))).alias("qnt"), as_double(F.sum(amount)).alias("amount")
    )


def overlay_store_totals(lines: DataFrame) -> DataFrame:
    """Items, quantity and amount per store and date, in the shape of the store report."""
    amount = exact(lines, F.col("qnt") * F.col("price"))
    items = lines.filter(F.col("stcode").isNotNull()).groupBy("stocktakeid", "stcode", "cntdate", "sku").agg(
        F.sum(exact(lines, "qnt")).alias("qnt"), F.sum(amount).alias("amount")
    )
    return items.groupBy("stcode", "cntdate").agg(
        F.lit("STK2").alias("rpname"),
        F.lit("Credit").alias("skutype"),
        F.count(F.lit(1)).alias("sku_count"),
        as_double(F.sum("qnt")).alias("qnt_physical"),
        as_double(F.sum("amount")).alias("retail_physical"),
    )
