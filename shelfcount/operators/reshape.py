"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text


def unpivot_answers(
    df: DataFrame, ids: Sequence[str], answers: Sequence[str], name: str = "question_code", value: str = "point"
) -> DataFrame:
    """One row per question; unanswered questions stay with a null."""
    return df.unpivot(list(ids), list(answers), name, value)


def unpivot_barcodes(
    master: DataFrame, sku: str, others: Sequence[str], keep: Sequence[str], width: int = 13
) -> DataFrame:
    """One padded row per usable barcode; the row of the item number itself is always there."""
    own = F.struct(F.lit(True).alias("own"), F.col(sku).cast("string").alias("code"))
    rest = [F.struct(F.lit(False).alias("own"), F.col(f"`{c}`").cast("string").alias("code")) for c in others]
    rows = master.select(F.col(sku).alias("sku"), *keep, F.inline(F.array(own, *rest)))
    usable = F.col("own") | (F.col("code").isNotNull() & (F.trim("code") != "") & (F.col("code") != "0"))
    return rows.filter(usable).select("sku", text.zfill("code", width).alias("upc"), *keep)


def wide_barcodes(
    master: DataFrame, codes: Sequence[str], keep: Sequence[str], width: int = 13, prefix: str = "barcode"
) -> DataFrame:
    """barcode1..n with '0' read as none, padded the SQL way (longer codes are cut)."""
    padded = [
        F.when(F.col(f"`{c}`") == "0", F.lit(None)).otherwise(text.lpad_code(f"`{c}`", width)).alias(f"{prefix}{i}")
        for i, c in enumerate(codes, 1)
    ]
    return master.select(*keep, *padded)


def explode_files(df: DataFrame, json_col: str, name: str = "original_filename") -> DataFrame:
    """One row per file name of a JSON array of objects; unreadable JSON gives one row with null."""
    parsed = F.from_json(F.col(json_col), "array<struct<name:string>>", {"mode": "PERMISSIVE"})
    names = F.filter(F.transform(parsed, lambda item: item["name"]), lambda n: n.isNotNull())
    return df.withColumn(name, F.explode_outer(names))
