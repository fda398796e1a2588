"""On-hand jobs: snapshots, pre-aggregated sheets, year start."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures, text
from ..layouts import WHOLESALE_STOCK
from ..operators import clean, stock
from ..operators.joins import enrich
from ..operators.maintain import replace_range
from ..policy import SohPolicy
from ..sources.workbook import dated_titles, read_many, sheets_union, sheets_wanted, title_wanted


def snapshot_job(
    raw: DataFrame, policy: SohPolicy, sku: str = "mssku", block: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Audit rows and snapshot of one unit's on-hand file, all columns of which are text."""
    df = clean.to_number(raw, [policy.value], dtype=measures.MONEY)
    audited = df
    if policy.audit_after_filter and policy.positive_only:
        audited = clean.positive(df, policy.value)
    date = text.century(policy.date) if policy.add_century else F.col(policy.date)
    return {
        "record": stock.intake_record(audited, policy.bu, date, policy.store, policy.value, sku),
        "snapshot": stock.soh_snapshot(df, policy, block),
    }


def customer_snapshot(raw: DataFrame, customers: DataFrame, policy: SohPolicy) -> DataFrame:
    """On-hand of wholesale customers: the store comes from a customer map, unmapped ones drop out."""
    df = clean.to_number(clean.rename_map(raw, WHOLESALE_STOCK), [policy.value], dtype=measures.MONEY)
    return stock.soh_snapshot(enrich(df, customers, ["cuscode"]), policy)


# 0-based positions of the pre-aggregated store sheets.
STORE_SHEET_POSITIONS = {
    1: "stcode",
    7: "food_credit",
    9: "nonfood_consign",
    11: "perishable_nonmer",
    13: "totalsoh",
}


def store_summary(files: DataFrame, sheets: Sequence[str], bu: str, skip_rows: int = 3) -> DataFrame:
    """Store totals given by a workbook, dated by the title of its first sheet.

    A file without a date in its title gives no rows.
    """
    wanted = sheets_wanted(sheets, STORE_SHEET_POSITIONS, "A:O", skip_rows)
    *tables, titles = read_many(files, [*wanted, title_wanted(sheets[0])])
    dated = sheets_union(tables, sheets, STORE_SHEET_POSITIONS).join(dated_titles(titles), "file")
    return dated.select(
        text.store_code(F.lit(bu), "stcode").alias("code"),
        F.lit(bu).alias("bu"),
        *[STORE_SHEET_POSITIONS[i] for i in sorted(STORE_SHEET_POSITIONS)],
        "DATE",
    )


def year_start(soh: DataFrame, plan: DataFrame, floor: str, day: str) -> DataFrame:
    """Table with ``day`` replaced by every planned store's latest snapshot."""
    return replace_range(soh, stock.carry_forward(soh, plan, floor, day), "DATE", day, day)


def first_week_seed(codes: DataFrame, day: str) -> DataFrame:
    """Zero rows for a list of store codes; unit and store are cut from the code."""
    zeros = {c: F.lit(0) for c in ("food_credit", "nonfood_consign", "perishable_nonmer", "totalsoh")}
    return clean.drop_cols(codes, ["week_number"]).withColumns(
        {**text.split_store_code("code"), "DATE": F.lit(day), **zeros}
    )
