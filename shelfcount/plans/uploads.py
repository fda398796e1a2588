"""Upload inboxes: which files arrived, and the approved miss-rate workbooks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import clean, gates
from ..operators.joins import join_renamed
from ..operators.maintain import replace_keys
from ..operators.ranking import occurrence
from ..operators.reshape import explode_files
from ..operators.sets import drop_dupes
from ..policy import OUTSOURCE_ALIASES
from ..session import durable
from ..sources.workbook import Wanted, block_rows, block_wanted, read_many

SPREADSHEETS = (".xlsx", ".xls")


def upload_inbox(forms: DataFrame, report: str, since: Column, order: Sequence[str] = ("id",)) -> DataFrame:
    """Canonical file names of the uploads of one report column since a moment.

    ``unique_filename`` numbers repeats only, ``target`` (folder and name) every file.

    ``forms(id, bu, stcode, cntdate, start, <report>)``; the report column holds JSON. Repeated
    names are numbered after the extension filter.
    """
    column = report.lower()
    local = forms.withColumn("start", dates.shift_hours(F.col("start").try_cast("timestamp")))
    listed = explode_files(
        local.filter((F.col("start") >= since) & F.col(column).isNotNull()), column, "original_filename"
    ).withColumn("file_type", text.extension("original_filename"))
    sheets = clean.in_list(listed, "file_type", SPREADSHEETS)
    day = dates.date_key(F.col("cntdate").try_cast("date"))
    parts = [F.lit(report.upper()), F.col("bu"), F.col("stcode"), day]
    named = sheets.withColumn("base_filename", text.build_name(parts, None, "file_type"))
    numbered = occurrence(named, ["base_filename"], [*order, "original_filename"])
    stored = text.build_name([*parts, F.col("dup_count").cast("string")], None, "file_type")
    return numbered.withColumns(
        {
            "unique_filename": text.build_name(parts, "dup_count", "file_type"),
            "target": F.concat("bu", F.lit("/"), stored),
        }
    )


def approved_inbox(approved: DataFrame, prefix: str = "Missrate") -> DataFrame:
    """Approved rows with the file taken from their link and its canonical name."""
    file = text.query_param("file", "file")
    day = dates.date_key(F.col("cntdate").try_cast("date"))
    rows = approved.withColumns({"file": file, "modified": dates.shift_hours(F.col("modified").try_cast("timestamp"))})
    extension = F.regexp_extract("file", r"(\.[^.]+)$", 1)
    return rows.withColumn("file_type", F.nullif(extension, F.lit(""))).withColumn(
        "target", text.build_name([F.lit(prefix), "bu", "stcode", day], None, F.coalesce("file_type", F.lit("nan")))
    )


def approved_recent(approved: DataFrame, hours: int, now: Column) -> DataFrame:
    """Approved rows of the last hours; ``now`` is UTC like the stored time."""
    return approved_inbox(clean.recent(approved.withColumn("__ts", F.col("modified").try_cast("timestamp")), "__ts", hours, now).drop("__ts"))


def approved_for(approved: DataFrame, pairs: DataFrame) -> DataFrame:
    """Approved rows of the wanted (stcode, cntdate) pairs."""
    return approved_inbox(gates.planned_only(approved, pairs, ["stcode", "cntdate"]))


# Columns of the approved miss-rate sheet and of its side block.
APPROVED_COLUMNS = (
    "group",
    "department",
    "barcode",
    "name",
    "count",
    "add/edit",
    "scan error",
    "pst/store",
    "remark (root cause)",
    "note",
)
SIDE_NAMES = (
    ("all scan-pst", "all scan-outsource"),
    ("qty weight-pst", "qty weight-outsource"),
    ("sku weright-pst", "sku weright-outsource"),
)


def _approved(files: DataFrame, plan: DataFrame, sheet: str) -> tuple[DataFrame, DataFrame]:
    """Rows of approved workbooks, and the accepted files: planned, with a whole side block and no empty causes.

    Each check is on whole files, so the files are settled first, in one pass over what decides them.
    """
    wanted = [Wanted(APPROVED_COLUMNS, sheet, "A:J", 6), block_wanted(sheet, "L:M", 2, SIDE_NAMES)]
    raw, side = read_many(files, wanted)
    missing = F.col("`pst/store`").isNull() | F.col("`remark (root cause)`").isNull()
    whole = raw.groupBy("file").agg(F.max(missing).alias("__missing")).filter("NOT __missing").drop("__missing")
    # Stored: Spark would move the test of the names before the grouping, and take them apart for every row.
    whole = durable(whole)
    found = text.parse_filename("file", ["kind", "bu", "stcode", "cntdate"], exact=True)
    named = whole.withColumns({n: found[n] for n in ("bu", "stcode", "cntdate")})
    planned = gates.planned_only(named, gates.open_plan(plan), ["stcode", "cntdate"])
    block = block_rows(side, 2, SIDE_NAMES)
    block = clean.cast_map(block, {c: "double" for row in SIDE_NAMES for c in row})
    # Stored, so that its size is known: a few rows are sent to the rows of the books, which then stay where they are.
    return raw, durable(planned.join(block, "file", "inner"))


def _accepted_rows(raw: DataFrame, accepted: DataFrame) -> DataFrame:
    """Rows of the accepted files without duplicates, with what the file and its block say."""
    who = text.replace_values(F.upper(F.trim(F.col("`pst/store`"))), OUTSOURCE_ALIASES)
    rows = raw.drop("line").withColumn("pst/store", who).withColumnRenamed("remark (root cause)", "remark root cause")
    rows = clean.cast_map(rows, dict.fromkeys(["count", "add/edit", "scan error"], "double"))
    # What is added is the same for all rows of a file and plays no part in telling them apart.
    unique = drop_dupes(rows.join(accepted.select("file"), "file", "left_semi"))
    side = [c for row in SIDE_NAMES for c in row]
    shown = ["file", "stcode", "cntdate", *rows.columns[1:], "bu", *side]
    return unique.join(accepted, "file").select(*[F.col(f"`{c}`") for c in shown])


def approved_rows(files: DataFrame, plan: DataFrame, sheet: str = "Summary") -> DataFrame:
    """Checked rows of approved workbooks: planned, with a whole side block and no empty causes."""
    return _accepted_rows(*_approved(files, plan, sheet))


def import_approved(files: DataFrame, plan: DataFrame, target: DataFrame) -> DataFrame:
    """Target with the counts of the accepted files replaced; a rejected file deletes nothing."""
    raw, accepted = _approved(files, plan, "Summary")
    # Every accepted file has rows, so the files tell the keys that come in.
    return replace_keys(target, _accepted_rows(raw, accepted).drop("file"), ["stcode", "cntdate"], accepted)


def hold_list(hold: DataFrame, counted: DataFrame, store: str, sku: str, decimals: Sequence[str]) -> DataFrame:
    """Hold list with decimals read and the final counted quantity per location added."""
    final = counted.filter(
        (F.col("rpname") == "VAR2") & (F.col("location") != "") & (F.col("cntqnt") > 0)
    ).select("stcode", "location", "skcode", "cntqnt")
    return join_renamed(clean.to_decimal(hold, decimals), final, [store, sku], ["stcode", "skcode"])
