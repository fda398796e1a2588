"""Miss rate: difference between first and final count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import as_double, exact
from .gates import exclude_blocked_sku


def first_final(
    df: DataFrame, keys: Sequence[str], first: str = "VAR1", final: str = "VAR2", qty: str = "qty_count"
) -> DataFrame:
    """Quantities of the first and the final report side by side."""
    value = exact(df, qty)

    def of(report: str) -> Column:
        return F.sum(F.when(F.col("rpname") == report, value).otherwise(F.lit(0)))

    return df.groupBy(*keys).agg(of(first).alias("first"), of(final).alias("final"))


def _roll_up(lines: DataFrame, bu: str, vendor: str = "PST") -> DataFrame:
    return (
        lines.dropna(subset=["stcode", "cntdate"])
        .groupBy("stcode", "cntdate")
        .agg(
            as_double(F.coalesce(F.sum("first"), F.lit(0))).alias("first"),
            as_double(F.coalesce(F.sum("missrate"), F.lit(0))).alias("missrate"),
        )
        .withColumns({"vendor": F.lit(vendor), "bu": F.lit(bu)})
    )


def missrate_simple(df: DataFrame, bu: str, group: str, qty: str = "qty_count") -> DataFrame:
    """Absolute difference per SKU and batch (or location), then summed per store and date."""
    lines = first_final(df, ["stcode", "cntdate", group, "sku"], qty=qty)
    return _roll_up(lines.withColumn("missrate", F.abs(F.col("first") - F.col("final"))), bu)


def missrate_reconciled(stk: DataFrame, block: DataFrame, reconcile: DataFrame, bu: str, qty: str = "qty_count") -> DataFrame:
    """Blocked SKUs left out; where the final count is higher, reconciled quantity counts as found.

    The block is keyed as the sums are, so the lines are summed before they meet it.
    """
    keys = ["bu", "stcode", "cntdate", "sku"]
    lines = exclude_blocked_sku(first_final(stk, keys, "STK1", "STK2", qty), block, keys)
    found = reconcile.groupBy(*keys).agg(F.sum(exact(reconcile, qty)).alias("rec"))
    zero = F.lit(0)
    first, final, rec = (F.coalesce(F.col(c), zero) for c in ("first", "final", "rec"))
    miss = F.when(first < final, F.abs(first + rec - final)).otherwise(F.abs(first - final))
    return _roll_up(lines.join(found, keys, "left").withColumn("missrate", miss), bu)


def missrate_vendor(view: DataFrame) -> DataFrame:
    """Own and outsourced figures of one row become one row per vendor, positive scans only."""
    own = F.struct(
        F.lit("PST").alias("vendor"), F.col("pst_scan").alias("first"), F.col("pst_miss").alias("missrate")
    )
    outsourced = F.struct(
        F.col("outsource_name").alias("vendor"),
        F.col("ost_scan").alias("first"),
        F.col("ost_miss").alias("missrate"),
    )
    return view.select("bu", "stcode", "cntdate", F.inline(F.array(own, outsourced))).filter(F.col("first") > 0)
