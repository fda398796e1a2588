"""Sources and sinks: the tables are written as files by Spark and read back by the library."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Sequence
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import shelfcount
import shelfcount_checks
from shelfcount import layouts
from shelfcount.operators import clean
from shelfcount.plans import masters, reports, soh, staffing, uploads
from shelfcount.policy import SOH_POLICIES
from shelfcount.session import scratch_path
from shelfcount.sources import delimited, sinks, tables, workbook

from .inputs import Inputs, check, text_of
from .summaries import item_master

LATIN = {"encoding": "ISO-8859-1"}

# Python workers get the functions themselves, wherever the session was started from.
for package in (shelfcount, shelfcount_checks):
    cloudpickle.register_pickle_by_value(package)


def written(i: Inputs, df: DataFrame, **options) -> str:
    path = scratch_path(i.spark, "files")
    df.write.options(**{"escape": '"', **options}).csv(path)
    return path


@check("""SELECT sku, des || ' ก,"' AS des, dept, nullif(trim(sbc2), '') AS sbc2 FROM v_master""")
def scan_positional(i: Inputs):
    # chr(161) written as Latin-1 is the byte that the Thai code page reads as U+0E01.
    df = i.master.select("sku", F.concat("des", F.lit(' ¡,"')).alias("des"), "dept", F.nullif(F.trim("sbc2"), F.lit("")))
    return delimited.scan_positional(i.spark, written(i, df, **LATIN), ["sku", "des", "dept", "sbc2"], encoding="cp874")


@check("""SELECT sku, des || 'กบ' AS des, des || 'ก' || chr(65533) || 'บ' AS kept FROM v_master""")
def decode_bad_bytes(i: Inputs):
    df = i.master.select("sku", F.concat("des", F.lit("¡ÿº")).alias("des"))
    path, names = written(i, df, **LATIN), ["sku", "des"]
    dropped = delimited.scan_positional(i.spark, path, names, encoding="cp874", errors="ignore")
    kept = delimited.scan_positional(i.spark, path, names, encoding="cp874")
    return dropped.join(kept.withColumnRenamed("des", "kept"), "sku")


@check("SELECT stcode AS msstor, mstype, substring(as_date, 3) AS msasdt, CAST(msstoh AS VARCHAR) AS msstoh, sku AS mssku FROM v_soh")
def scan_headered(i: Inputs):
    quoted = [F.concat(F.lit("'"), c, F.lit("'")).alias(f"'{c.upper()}'") for c in ("msstor", "mstype", "msasdt", "msstoh", "mssku")]
    return delimited.scan_headered(i.spark, written(i, i.soh_file.select(*quoted), header=True))


@check("""SELECT CASE WHEN length(dept) >= 9 THEN dept ELSE lpad(dept, 9, '0') END AS stcode, sku, des, 'T1' AS stocktakeid FROM v_master""")
def scan_pipe(i: Inputs):
    path = written(i, i.master.select("dept", "sku", "des"), sep="|", **LATIN)
    return delimited.scan_pipe(i.spark, path, ["stcode", "sku", "des"], store_width=9, stocktakeid="T1")


@check("SELECT sku, des, sbc1 FROM v_master WHERE sbc1 IS NOT NULL")
def scan_skip_one(i: Inputs):
    path = written(i, i.master.select("sku", "des", "sbc1"), header=True)
    return delimited.scan_skip(i.spark, path, ["sku", "des", "sbc1"], skip=1, key="sbc1")


@check("SELECT sku, des || ',x' AS des, sbc1 FROM v_master WHERE sbc1 IS NOT NULL")
def scan_skip_many(i: Inputs):
    title = "report,of\nthe day\nsku,des,sbc1"
    line = F.concat("sku", F.lit(',"'), "des", F.lit(',x",'), F.coalesce("sbc1", F.lit("")))
    top = i.master.repartition("dept").select(line.alias(title))
    path = scratch_path(i.spark, "lines")
    top.write.options(header=True, quote="\u0001", sep="\u0002", escape="\u0003").csv(path)
    return delimited.scan_skip(i.spark, path, ["sku", "des", "sbc1"], skip=3, key="sbc1")


REORDERED = "SELECT sku, des, CASE WHEN sku LIKE '%1' THEN NULL ELSE dept END AS dept FROM v_master"


def reordered(i: Inputs) -> str:
    """Files of three layouts in one folder: columns in another order, a missing and a surplus one."""
    path = scratch_path(i.spark, "files")
    last = F.right("sku", F.lit(1))
    rows = i.master.select("sku", "des", "dept", last.alias("last"))
    layouts = (("last < '1'", ["sku", "des", "dept"]), ("last = '1'", ["des", "sku"]), ("last > '1'", ["dept", "last", "SKU", " Des"]))
    for condition, names in layouts:
        part = rows.filter(condition).select(*[F.col(n.strip().lower()).alias(n) for n in names])
        part.write.mode("append").options(header=True, escape='"').csv(path)
    return path


@check(REORDERED)
def scan_headered_reordered(i: Inputs):
    return delimited.scan_headered(i.spark, reordered(i)).select("sku", "des", "dept")


@check(REORDERED)
def scan_folder_reordered(i: Inputs):
    return delimited.scan_folder(i.spark, reordered(i), ["sku", "des", "dept"]).drop("file")


@check("""SELECT sku, des || chr(1) || 'y' AS des, dept FROM v_master UNION ALL SELECT sku, des || chr(10) || '"y', dept FROM v_master""")
def scan_skip_blank_lines(i: Inputs):
    # A title, a blank line and the header are three lines. Five hundred items to a file.
    rows = i.master.select("sku", "des", "dept", F.floor(F.col("sku").cast("bigint") / 500).alias("part"))
    out = []
    for cell, multiline in ((F.concat("des", F.lit("\x01y")), False), (F.concat("des", F.lit('\n""y')), True)):
        line = F.concat("sku", F.lit(',"'), cell, F.lit('",'), "dept")
        files = rows.groupBy("part").agg(F.concat_ws("\n", F.lit("title\n\nsku,des,dept"), F.collect_list(line)).alias("value"))
        path = scratch_path(i.spark, "lines")
        files.write.partitionBy("part").text(path)
        out.append(delimited.scan_skip(i.spark, path, ["sku", "des", "dept"], skip=3, multiline=multiline))
    return out[0].unionByName(out[1])


def laid_out(i: Inputs, layout: Sequence[str], **cells) -> DataFrame:
    """Item rows in the columns of a file format; the others are empty."""
    return i.master.select(*[cells.get(c, F.lit("-")).alias(c) for c in layout])


@check("""SELECT sku, dept, CAST(price AS DOUBLE) AS soh FROM v_master""")
def scan_store_stock(i: Inputs):
    rows = laid_out(i, layouts.STORE_STOCK_FILE, sku=F.col("sku"), dept=F.col("dept"), soh=F.col("price").cast("string"))
    df = delimited.scan_positional(i.spark, written(i, rows, **LATIN), layouts.STORE_STOCK_FILE, encoding="cp874")
    return df.select("sku", "dept", F.col("soh").cast("double").alias("soh"))


@check("""SELECT lpad(right(sku, 2), 3, '0') AS stcode, sku AS barcode, des AS description, 'T1' AS stocktakeid FROM v_master""")
def scan_stocktake_master(i: Inputs):
    rows = laid_out(i, layouts.STOCKTAKE_MASTER, stcode=F.right("sku", F.lit(2)), barcode=F.col("sku"), description=F.col("des"))
    df = delimited.scan_pipe(i.spark, written(i, rows, sep="|", **LATIN), layouts.STOCKTAKE_MASTER, stocktakeid="T1")
    return df.select("stcode", "barcode", "description", "stocktakeid")


@check("""SELECT sku, des AS description, CAST(price AS DOUBLE) AS price FROM v_master""")
def scan_count_master(i: Inputs):
    rows = laid_out(i, layouts.SCAN_MASTER, sku=F.col("sku"), description=F.col("des"), price=F.col("price").cast("string"))
    df = delimited.scan_skip(i.spark, written(i, rows, header=True), layouts.SCAN_MASTER, skip=1, key="sku")
    return df.select("sku", "description", F.col("price").cast("double").alias("price"))


@check("SELECT stcode, cntdate, sku, 1 AS files FROM v_stk")
def scan_folder(i: Inputs):
    path = written(i, i.stk.select("stcode", "cntdate", "sku"), header=True)
    df = delimited.scan_folder(i.spark, path, ["stcode", "cntdate", "sku"])
    return df.select("stcode", "cntdate", "sku", F.when(F.col("file").endswith(".csv"), 1).alias("files"))


@check("""SELECT 'B2S' || stcode AS code, 'B2S' AS bu, stcode, '20' || substring(as_date, 3) AS "DATE",
    CAST(sum(CASE WHEN mstype = '01' THEN msstoh ELSE 0 END) AS DOUBLE) AS food_credit, CAST(sum(CASE WHEN mstype = '02' THEN msstoh ELSE 0 END) AS DOUBLE) AS nonfood_consign,
    CAST(sum(CASE WHEN mstype = '03' THEN msstoh ELSE 0 END) AS DOUBLE) AS perishable_nonmer, CAST(sum(msstoh) AS DOUBLE) AS totalsoh FROM v_soh s
    WHERE msstoh > 0 AND sdpt NOT IN ('600', '700') AND vendor NOT IN (SELECT veno FROM v_block WHERE sdpt = 'all') AND NOT EXISTS
    (SELECT 1 FROM v_block b WHERE b.sdpt <> 'all' AND b.veno = s.vendor AND b.sdpt = s.sdpt) GROUP BY stcode, as_date""")
def snapshot_from_file(i: Inputs):
    names = i.soh_file.columns
    raw = delimited.scan_positional(i.spark, written(i, i.soh_file, **LATIN), names, encoding="cp874")
    return soh.snapshot_job(raw, SOH_POLICIES["B2S"], block=i.block)["snapshot"]


def _xlsx(sheets: dict[str, list[list]]) -> bytes:
    """A minimal workbook: {sheet: rows of text, numbers or None}."""

    def letters(n: int) -> str:
        return (letters(n // 26 - 1) if n >= 26 else "") + chr(65 + n % 26)

    def line(r: int, row: list) -> str:
        # A number as it is, a text escaped; only few texts need it.
        return "".join(
            [
                f'<c r="{at}{r}"><v>{v}</v></c>'
                if not isinstance(v, str)
                else f'<c r="{at}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(v) if special(v) else v}</t></is></c>'
                for at, v in zip(columns, row)
                if v is not None
            ]
        )

    special = re.compile("[&<>]").search
    columns = [letters(c) for c in range(max((len(row) for rows in sheets.values() for row in rows), default=0))]
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        names = list(sheets)
        listed = "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        for k, n in enumerate(names, 1):
            rows = "".join([f'<row r="{r}">{line(r, row)}</row>' for r, row in enumerate(sheets[n], 1) if row])
            book.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>')
    return out.getvalue()


BOOK_LINES = 5000

#: Stored books by what they are made from, if a caller sets a dict: a bench measures jobs and not the making of books.
kept_books: dict[tuple, str] | None = None


def books(
    i: Inputs,
    df: DataFrame,
    file: str,
    header: Sequence[str],
    sheet: str = "Sheet1",
    top: Sequence[Sequence] = (),
    order: Sequence[str] = (),
    hidden: Sequence[str] = (),
    named: str = "{file}_{part}",
) -> DataFrame:
    """(file, content): workbooks holding the rows of ``df``, made by tasks and stored as a table.

    A ``file`` with many rows becomes several books of about ``BOOK_LINES`` lines, so that no
    book grows with the data; ``named`` says where the number of the book goes in its name.
    Rows with an ``order`` are not divided: their ``file`` must bound them already.
    """
    made_from = (df.semanticHash(), file, *header, sheet, repr(top), *order, *hidden, named)
    if kept_books is not None and made_from in kept_books:
        return i.spark.read.parquet(kept_books[made_from])
    names = [c for c in df.columns if c != file]
    shown = [c for c in names if c not in hidden]
    above = [list(r) for r in top]
    parted = df.withColumn("__part", F.lit(0).cast("bigint"))
    if not order:
        sizes = df.groupBy(file).agg(F.ceil(F.count(F.lit(1)) / BOOK_LINES).alias("__parts"))
        spread = F.pmod(F.xxhash64(*names, F.monotonically_increasing_id()), F.col("__parts"))
        parted = df.join(sizes, file).withColumn("__part", spread).drop("__parts")

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order)) if order else pdf
        rows = zip(*(pdf[c].astype(object).where(pdf[c].notna(), None).tolist() for c in shown))
        name = named.format(file=key[0], part=key[1]) + ".xlsx"
        return pd.DataFrame({"file": [name], "content": [_xlsx({sheet: [*above, list(header), *rows]})]})

    path = scratch_path(i.spark, "books")
    parted.groupBy(file, "__part").applyInPandas(build, "file string, content binary").write.parquet(path)
    if kept_books is not None:
        kept_books[made_from] = path
    return i.spark.read.parquet(path)


DISTRICT = "right(stcode, 1)"
YEAR = "left(cntdate, 4) || '0101'"
# Report lines by district and year: a store of the book is the last digit of the stand-in store.
BOOKED = f"(SELECT {DISTRICT} AS stcode, {YEAR} AS cntdate, skutype, rpname, sku, soh, qty_var FROM v_stk)"
PLANNED = f"(SELECT {DISTRICT} AS stcode, {YEAR} AS cntdate FROM v_planm GROUP BY 1, 2 HAVING count(*) % 3 > 0)"
# Planned with a branch, whatever the visit.
VISITED = f"(SELECT {DISTRICT} AS stcode, {YEAR} AS cntdate FROM v_planm GROUP BY 1, 2 HAVING count(*) % 3 > 0 OR {DISTRICT} NOT IN ('0', '2', '6', '8'))"


def by_district(df: DataFrame) -> DataFrame:
    year = F.concat(F.left("cntdate", F.lit(4)), F.lit("0101"))
    return df.withColumns({"stcode": F.right("stcode", F.lit(1)), "cntdate": year})


def booked(i: Inputs, report: str = "STK1") -> DataFrame:
    file = F.concat_ws("_", F.lit(report), F.lit("BU"), "stcode", "cntdate")
    return by_district(i.stk).withColumn("file", file)


def planned(i: Inputs) -> DataFrame:
    """Plan of the books: some visits are planned three times, some lack a branch, some are 4V only."""
    counted = by_district(i.planm).groupBy("stcode", "cntdate").agg((F.count(F.lit(1)) % 3).alias("n"))
    full, bare, other = ("3F", "b"), ("3F", None), ("4V", "b")

    def rows(*pairs: tuple[str, str | None]):
        return F.array(*[F.struct(F.lit(a).alias("atype"), F.lit(b).cast("string").alias("branch")) for a, b in pairs])

    visits = F.when(F.col("n") > 0, rows(full, bare, other)).when(F.col("stcode").isin("0", "2", "6", "8"), rows(bare)).otherwise(rows(other))
    return counted.select(F.lit("BU").alias("bu"), "stcode", "cntdate", F.explode(visits).alias("v")).select("bu", "stcode", "cntdate", "v.*")


def done(i: Inputs, report: str = "STK1") -> DataFrame:
    keys = by_district(i.planm).filter("stcode = '4'").select("stcode", "cntdate").distinct()
    return keys.select(F.lit("BU").alias("bu"), "*", F.explode(F.array(F.lit("Credit"), F.lit("Consign"))).alias("skutype"), F.lit(report).alias("rpname"))


GATED = f"EXISTS (SELECT 1 FROM {PLANNED} p WHERE p.stcode = s.stcode AND p.cntdate = s.cntdate) AND s.stcode <> '4'"


@check(f"""SELECT 'STK1_BU_' || stcode || '_' || cntdate AS file, stcode AS store, sku, CAST(CAST(soh AS INTEGER) AS VARCHAR) AS soh, NULL AS remark FROM {BOOKED}""")
def read_workbooks(i: Inputs):
    lines = booked(i).select("file", "sku", "stcode", F.col("soh").cast("int").alias("soh"))
    files = books(i, lines, "file", ["SKU", " Store\n", "'SOH'"], "Sheet 1", top=[["title"], []])
    df = workbook.read_workbooks(files, ["store", "sku", "soh", "remark"], sheet="sheet1", usecols="A:V", skip_rows=2)
    return df.drop("line").withColumn("file", F.regexp_replace("file", r"_[0-9]+\.xlsx$", ""))


@check(f"""SELECT bu, stcode, cntdate, rpname, skutype, sku, CAST(qty_count AS DOUBLE) AS qty_count FROM (SELECT DISTINCT 'BU' AS bu, stcode, cntdate, 'VAR1' AS rpname, skutype,
    CASE WHEN sku LIKE '%3' THEN '' ELSE sku END AS sku, soh + qty_var AS qty_count FROM {BOOKED} WHERE sku NOT LIKE '%5') s WHERE {GATED}""")
def report_import(i: Inputs):
    named = F.when(F.col("skutype") == "Credit", "AB1").otherwise("AX1")
    sku = F.when(~F.col("sku").endswith("3"), F.col("sku"))
    store = F.when(F.col("sku").endswith("5"), "other").otherwise(F.col("stcode"))
    counted = (F.col("soh") + F.col("qty_var")).cast("double").alias("qty")
    lines = booked(i).select("file", store.alias("store"), named.alias("countname"), sku.alias("sku"), counted).distinct()
    files = books(i, lines, "file", ["STORE", "COUNTNAME", "SKU", "QTY_COUNT"])
    raw = workbook.read_workbooks(files, ["store", "countname", "sku", "qty_count"])
    out = reports.import_report(raw, reports.STORE_BOOK, planned(i), done(i, "VAR1"), report="VAR1")
    return clean.to_number(out, ["qty_count"]).select("bu", "stcode", "cntdate", "rpname", "skutype", "sku", "qty_count")


@check(f"""SELECT DISTINCT stcode, cntdate, sku, CAST(coalesce(round_even(q, 3), 0) AS DOUBLE) AS qty_count, CAST(coalesce(q, 0) * 3 AS DOUBLE) AS phycnt_rtl, 'Credit' AS skutype FROM
    (SELECT *, CASE WHEN sku NOT LIKE '%9' THEN soh + qty_var END AS q FROM {BOOKED}) s WHERE {GATED}""")
def report_import_credit(i: Inputs):
    counted = F.when(~F.col("sku").endswith("9"), (F.col("soh") + F.col("qty_var")).cast("double"))
    lines = booked(i).select("file", "stcode", "sku", F.lit(3).alias("retail"), F.lit("x").alias("cost"), counted.alias("qty")).distinct()
    files = books(i, lines, "file", ["STORE", "SKU", "RETAIL", "COST", "QTY_COUNT"], "STK1")
    raw = workbook.read_workbooks(files, ["store", "sku", "retail", "cost", "qty_count"], sheet="STK1")
    out = reports.import_report(raw, reports.STORE_BOOK_CREDIT, planned(i), done(i))
    return out.select("stcode", "cntdate", "sku", *[F.col(c).cast("double").alias(c) for c in ("qty_count", "phycnt_rtl")], "skutype")


@check(f"""SELECT DISTINCT lpad(stcode, 5, '0') AS stcode, '20' || substring(cntdate, 3) AS cntdate, sku AS skcode, skutype AS prtype FROM {BOOKED} s WHERE skutype <> 'Credit' OR stcode <> '4'""")
def report_import_detail(i: Inputs):
    # The count number names the store and the day (two-digit year of this century).
    store = F.lpad("stcode", 5, "0")
    short = F.concat(F.lit("0101"), F.substring("cntdate", 3, 2))
    cntnum = F.concat(store, F.lit("F"), short, F.lit("001"))
    day = F.concat(F.lit("20"), F.substr("cntdate", F.lit(3)))
    base = by_district(i.stk)
    lines = base.select(F.concat(F.lit("VAR1_BU_"), store, F.lit("_x")).alias("file"), cntnum.alias("cntnum"), F.concat(F.lit(" "), "sku").alias("skcode"), F.col("skutype").alias("prtype")).distinct()
    files = books(i, lines, "file", ["cntnum", "skcode", "prtype"])
    raw = workbook.read_workbooks(files, ["cntnum", "skcode", "prtype"])
    keys = base.select(F.lit("BU").alias("bu"), store.alias("stcode"), day.alias("cntdate"), F.col("skutype").alias("prtype"), F.lit("VAR1").alias("rpname"))
    plan = keys.withColumns({"atype": F.lit("3F"), "branch": F.lit("b")})
    out = reports.import_report(raw, reports.COUNT_DETAIL_CLEAN, plan, keys.filter("stcode = '00004' AND prtype = 'Credit'"))
    return out.select("stcode", "cntdate", "skcode", "prtype")


@check(f"""SELECT DISTINCT stcode, cntdate, sku, CAST(CASE WHEN sku LIKE '%1' THEN 0 ELSE soh END AS DOUBLE) AS qnt FROM {BOOKED} s WHERE {GATED} AND NOT (sku LIKE '%11')""")
def report_import_sheet_book(i: Inputs):
    blank = F.col("sku").endswith("1")
    stock = F.when(F.col("sku").endswith("11"), 0.0).otherwise(1.0)
    lines = booked(i).select("file", "sku", stock.alias("stock"), F.when(~blank, F.col("soh").cast("double")).alias("qnt")).distinct()
    files = books(i, lines, "file", ["SKU", "STOCK", "QNT"], "STK")
    raw = workbook.read_workbooks(files, ["sku", "stock", "qnt"], sheet="STK", usecols="A:Z")
    out = reports.import_report(raw, reports.SHEET_BOOK, planned(i), done(i))
    return out.select("stcode", "cntdate", "sku", F.col("qnt").cast("double").alias("qnt"))


@check(f"""SELECT DISTINCT stcode, cntdate, sku, 'Consign' AS skutype, 'd' AS dpt FROM {BOOKED} s WHERE {GATED} AND skutype = 'Consign' AND sku NOT LIKE '%5'""")
def report_import_count_book(i: Inputs):
    store = F.when(F.col("sku").endswith("5"), "other").otherwise(F.col("stcode"))
    sku = F.concat(F.lit(" '"), "sku", F.lit("' "))
    lines = booked(i).filter("skutype = 'Consign'").select("file", store.alias("store"), sku.alias("sku"), F.lit("d").alias("dept")).distinct()
    files = books(i, lines, "file", ["STMERCH", "SKU", "DEPT"], "STK")
    raw = workbook.read_workbooks(files, ["stmerch", "sku", "dept"], sheet="STK")
    raw = clean.rename_map(raw, reports.STORE_BOOK_CREDIT_NAMES)
    out = reports.import_report(raw, reports.COUNT_BOOK_CONSIGN, planned(i), done(i))
    return out.select("stcode", "cntdate", "sku", "skutype", "dpt")


@check(f"""SELECT DISTINCT stcode, cntdate, sku, CAST(soh AS DOUBLE) AS soh, CAST(qty_var AS DOUBLE) AS qty_var, CAST(qty_var * 2 AS DOUBLE) AS extrtl_var, 'Credit' AS skutype
    FROM {BOOKED} s WHERE {GATED}""")
def report_import_wholesale(i: Inputs):
    counted = (F.col("soh") + F.col("qty_var")).cast("double")
    lines = booked(i).select("file", "sku", F.col("soh").cast("double").alias("soh"), counted.alias("qty"), F.lit(2).alias("retail"), F.lit(1).alias("cost")).distinct()
    files = books(i, lines, "file", ["PR_CODE", "Quantity", "Physical  Count", "Unit Retail", "Unit Cost"], "STK")
    raw = clean.rename_map(workbook.read_workbooks(files, list(reports.WHOLESALE_NAMES), sheet="STK"), reports.WHOLESALE_NAMES)
    out = reports.import_report(raw, reports.WHOLESALE_BOOK, planned(i), done(i))
    numbers = [F.col(c).cast("double").alias(c) for c in ("soh", "qty_var", "extrtl_var")]
    return out.select("stcode", "cntdate", "sku", *numbers, "skutype")


COUNTS = f"(SELECT DISTINCT lpad(stcode, 5, '0') AS stcode, cntdate, sku, skutype AS prtype FROM {BOOKED})"


@check(f"""SELECT stcode, cntdate, prtype, count(*) AS rows, max(version) AS version FROM (SELECT *, 'new' AS version FROM {COUNTS} s WHERE stcode NOT IN ('00003')
    UNION ALL SELECT *, 'old' FROM {COUNTS} WHERE stcode IN ('00003', '00005') AND prtype = 'Credit') x
    WHERE NOT (version = 'new' AND stcode = '00005' AND prtype = 'Credit') GROUP BY 1, 2, 3""")
def report_reload(i: Inputs):
    # District 3 has foreign rows in its books, so they are rejected; district 5 holds its Credit
    # rows already, so only Consign is added; the others are new.
    store = F.lpad("stcode", 5, "0")
    wrong = (F.col("stcode") == "3") & F.col("sku").endswith("1")
    base = booked(i, "VAR1")
    cntnum = F.concat(F.when(wrong, "99999").otherwise(store), F.lit("F"))
    lines = base.select(
        F.concat_ws("_", F.lit("VAR1"), F.lit("BU"), store, "cntdate").alias("file"), cntnum.alias("cntnum"), F.col("sku").alias("skcode"), F.col("skutype").alias("prtype")
    ).distinct()
    files = books(i, lines, "file", ["cntnum", "skcode", "prtype"])
    raw = workbook.read_workbooks(files, ["cntnum", "skcode", "prtype"], usecols="A:AD")
    held = by_district(i.stk).filter("stcode IN ('3', '5') AND skutype = 'Credit'").select(
        F.lit("BU").alias("bu"), store.alias("stcode"), "cntdate", F.col("sku").alias("skcode"), F.col("skutype").alias("prtype"),
        F.lit("VAR1").alias("rpname"), F.concat(store, F.lit("F")).alias("cntnum"),
    ).distinct().withColumn("version", F.lit("old"))
    plan = lines.select(
        F.lit("BU").alias("bu"), F.split_part("file", F.lit("_"), F.lit(3)).alias("stcode"), F.split_part("file", F.lit("_"), F.lit(4)).alias("cntdate"),
        F.lit("3F").alias("atype"), F.lit("b").alias("branch"),
    )
    out = reports.reload_report(raw, reports.STORE_COUNT, plan, held, ["rpname", "cntnum", "prtype"])
    version = F.coalesce("version", F.lit("new"))
    return out.groupBy("stcode", "cntdate", "prtype").agg(F.count(F.lit(1)).alias("rows"), F.max(version).alias("version"))


@check(f"""SELECT DISTINCT stcode, cntdate, rpname AS remark, sku, 'Credit' AS skutype FROM {BOOKED} s WHERE {GATED}""")
def reconcile_sheet(i: Inputs):
    lines = booked(i).select("file", "sku", F.lit("XB").alias("countname"), "rpname").distinct()
    files = books(i, lines, "file", ["SKU", "CountName", "Reason"], "Block")
    raw = workbook.read_workbooks(files, ["sku", "countname", "reason"], sheet="Block")
    out = reports.reconcile_sheet(raw, "Block", planned(i), done(i), "reason")
    return out.select("stcode", "cntdate", "remark", "sku", "skutype")


@check(f"""SELECT DISTINCT {DISTRICT} AS mdstor, {YEAR} AS cntdate, CAST(credit AS DOUBLE) AS credit, CAST(consignment AS DOUBLE) AS consignment FROM
    (SELECT mdstor AS stcode, * FROM v_sale) x WHERE mdstor NOT LIKE '%22' AND EXISTS (SELECT 1 FROM {PLANNED} p WHERE p.stcode = {DISTRICT.replace('stcode', 'x.stcode')}
    AND p.cntdate = {YEAR.replace('cntdate', 'x.cntdate')}) AND {DISTRICT.replace('stcode', 'x.stcode')} <> '4'""")
def sales_sheet(i: Inputs):
    sale = by_district(i.sale.withColumn("stcode", F.col("mdstor")))
    store = F.when(F.col("mdstor").endswith("22"), "other").otherwise(F.col("stcode"))
    file = F.concat_ws("_", F.lit("S"), F.lit("BU"), "stcode", "cntdate").alias("file")
    amounts = [F.col(c).cast("double").alias(c) for c in ("credit", "consignment")]
    files = books(i, sale.select(file, store.alias("store"), *amounts), "file", ["MDSTOR2", "CREDIT", "CONSIGNMENT"], "Sale")
    raw = workbook.read_workbooks(files, ["mdstor2", "credit", "consignment"], sheet="Sale", usecols="A:I")
    loaded = done(i).withColumnRenamed("stcode", "mdstor")
    out = clean.to_number(reports.sales_sheet(raw, planned(i), loaded), ["credit", "consignment"])
    return out.select("mdstor", "cntdate", "credit", "consignment")


@check("""SELECT 'CFR' || stcode AS code, 'CFR' AS bu, stcode, CAST(n AS VARCHAR) AS food_credit, CAST(n + 1 AS VARCHAR) AS nonfood_consign, '0' AS perishable_nonmer,
    CAST(2 * n + 1 AS VARCHAR) AS totalsoh, '20260309' AS "DATE" FROM (SELECT stcode, count(*) AS n FROM v_stk GROUP BY 1), (VALUES (1), (2)) t(x)""")
def store_summary(i: Inputs):
    n = F.col("n")
    counted = i.stk.groupBy("stcode").agg(F.count(F.lit(1)).alias("n"))
    gap = [F.lit("-").alias(f"g{k}") for k in range(10)]
    cells = [gap[0], F.col("stcode"), *gap[1:6], n, gap[6], (n + 1).alias("b"), gap[7], F.lit(0).alias("c"), gap[8], (2 * n + 1).alias("t"), gap[9]]
    lines = counted.select(F.concat(F.lit("soh"), F.left("stcode", F.lit(1))).alias("file"), *cells)
    title = [["Stock of all stores on 09-Mar-2026"], []]
    files = books(i, lines, "file", ["h"] * 15, "V 12", top=title)
    return soh.store_summary(files, ["V 12", "v12"], "CFR", skip_rows=3)


APPROVED = f"""SELECT DISTINCT stcode, cntdate, sku AS barcode, CAST(soh AS DOUBLE) AS count, CASE skutype WHEN 'Credit' THEN 'OUTSOURCE' ELSE 'PST' END AS who,
    10.0::DOUBLE AS scan_own, 21.0::DOUBLE AS qty_other, 0.0::DOUBLE AS sku_other FROM {BOOKED} s
    WHERE EXISTS (SELECT 1 FROM {VISITED} p WHERE p.stcode = s.stcode AND p.cntdate = s.cntdate)
    AND NOT EXISTS (SELECT 1 FROM {BOOKED} x WHERE x.stcode = '6' AND x.stcode = s.stcode AND x.cntdate = s.cntdate AND x.sku LIKE '%0')"""


def approved_files(i: Inputs) -> DataFrame:
    who = F.when(F.col("skutype") == "Credit", " ajis ").otherwise("Pst")
    cause = F.when(~((F.col("stcode") == "6") & F.col("sku").endswith("0")), "lost")
    file = F.concat_ws("_", F.lit("BU"), "stcode", "cntdate")
    empty = F.lit(None).cast("string")
    cells = booked(i).select(
        file.alias("file"), F.lit("G").alias("group"), F.left("sku", F.lit(2)).alias("department"), "sku", F.lit("n").alias("name"),
        F.col("soh").cast("double").alias("count"), F.lit(1).alias("add"), empty.alias("scan"), who.alias("who"), cause.alias("cause"),
    ).distinct()
    header = ["Group", "Department", "Barcode", "Name", "Count", "Add/Edit", "Scan Error", "PST/Store", "Remark (Root Cause)", "Note"]
    pad = [None] * 11
    top = [["Summary"], [*pad, "PST", "AJIS"], [*pad, 10, 20], [*pad, 11, 21], [*pad, 12, None], []]
    return books(i, cells, "file", header, "Summary", top=top, named="Missrate{part}_{file}")


@check(APPROVED)
def approved_rows(i: Inputs):
    out = uploads.approved_rows(approved_files(i), planned(i))
    return out.select(
        "stcode", "cntdate", "barcode", F.col("count"), F.col("`pst/store`").alias("who"), F.col("`all scan-pst`").alias("scan_own"),
        F.col("`qty weight-outsource`").alias("qty_other"), F.col("`sku weright-outsource`").alias("sku_other"),
    )


@check(f"""SELECT stcode, cntdate, count(DISTINCT barcode) AS items, 'new' AS version FROM ({APPROVED}) GROUP BY 1, 2 UNION ALL
    SELECT stcode, cntdate, 1, 'old' FROM (SELECT DISTINCT {DISTRICT} AS stcode, {YEAR} AS cntdate FROM v_planm) o
    WHERE NOT EXISTS (SELECT 1 FROM ({APPROVED}) a WHERE a.stcode = o.stcode AND a.cntdate = o.cntdate)""")
def import_approved(i: Inputs):
    held = by_district(i.planm).distinct().withColumns({"barcode": F.lit("x"), "version": F.lit("old")})
    out = uploads.import_approved(approved_files(i), planned(i), held)
    version = F.coalesce("version", F.lit("new")).alias("version")
    return out.groupBy("stcode", "cntdate", version).agg(F.count_distinct("barcode").alias("items"))


@check("""SELECT DISTINCT 'E' || CAST(conv_id AS VARCHAR) AS employee_id, 'Leave' AS time_off_type, strftime(DATE '2024-01-01' + CAST(turn AS INTEGER), '%Y-%m-%d') AS time_off_date
    FROM conversations WHERE conv_id % 4 <> 0""")
def time_off_books(i: Inputs):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int"))
    # Twenty people to a book, a thousand lines of each: no book grows with the data.
    first = F.col("turn") % 1000 == 0
    book = F.concat_ws("_", F.floor(F.col("conv_id") / 20).cast("string"), F.floor(F.col("turn") / 1000).cast("string"))
    rows = i.table("conversations").select(
        F.concat(F.lit("off"), book).alias("file"),
        F.when(first, "N").alias("n"),
        F.when(first, F.concat(F.lit("E"), text_of("conv_id"))).alias("e"),
        F.lit("Leave ").alias("t"),
        F.date_format(day, "EEEE d/MM/yyyy").alias("d"),
        "conv_id",
        "turn",
    )
    header = ["Employee Name", "Employee ID", "Time Off Type", "Time Off Date", "Value"]
    files = books(i, rows, "file", header, top=[*[["x"]] * 6, ["unused", "names"]], order=["conv_id", "turn"], hidden=["conv_id", "turn"], named="{file}")
    raw = workbook.read_workbooks(files, list(staffing.TIME_OFF_NAMES), sheet="Sheet1", usecols="A:AA", skip_rows=6, promote=1)
    stored = i.table("conversations").filter("conv_id % 4 = 0").select(
        F.concat(F.lit("E"), text_of("conv_id")).alias("employee_id"), F.date_format(day, "yyyy-MM-dd").alias("time_off_date")
    )
    return staffing.time_off(raw, stored).select("employee_id", "time_off_type", "time_off_date")


@check("SELECT stcode, cntdate, sku, count(*) AS n FROM (SELECT * FROM v_stk UNION ALL SELECT * FROM v_stk WHERE rpname = 'STK2') GROUP BY 1, 2, 3")
def sink_append(i: Inputs):
    path = scratch_path(i.spark, "table")
    sinks.full_refresh(i.stk.filter("stcode = '1'"), path)
    sinks.full_refresh(i.stk, path)
    sinks.append(i.stk.filter("rpname = 'STK2'"), path)
    return i.spark.read.parquet(path).groupBy("stcode", "cntdate", "sku").agg(F.count(F.lit(1)).alias("n"))


@check("""SELECT stcode, cntdate, sku, CASE WHEN cntdate IN ('19980101', '19980201') THEN 'new' ELSE 'old' END AS version FROM v_stk
    WHERE cntdate NOT IN ('19980101', '19980201') OR rpname = 'STK2'""")
def sink_replace_partitions(i: Inputs):
    path = scratch_path(i.spark, "table")
    rows = i.stk.select("stcode", "sku", "cntdate", "rpname")
    sinks.append(rows.drop("rpname").withColumn("version", F.lit("old")), path, ["cntdate"])
    fresh = rows.filter("cntdate IN ('19980101', '19980201') AND rpname = 'STK2'").drop("rpname")
    sinks.replace_partitions(fresh.withColumn("version", F.lit("new")), path, ["cntdate"])
    stored = "stcode string, sku string, version string, cntdate string"
    return i.spark.read.schema(stored).parquet(path).select("stcode", "cntdate", "sku", "version")


PADDED = "(SELECT cntdate, lpad(stcode, 5, '0') AS stcode, sku, skutype FROM v_stk)"


def padded(i: Inputs) -> DataFrame:
    """Report lines with store codes as they are stored: text with leading zeros."""
    return i.stk.select("cntdate", F.lpad("stcode", 5, "0").alias("stcode"), "sku", "skutype")


@check(f"""SELECT cntdate, stcode, sku, 'old' AS version FROM {PADDED} o
    WHERE NOT EXISTS (SELECT 1 FROM {PADDED} n WHERE n.skutype = 'Credit' AND n.stcode < '00003' AND n.cntdate = o.cntdate AND n.stcode = o.stcode)
    UNION ALL SELECT cntdate, stcode, sku, 'new' FROM {PADDED} WHERE skutype = 'Credit' AND stcode < '00003'""")
def sink_replace_keys(i: Inputs):
    path = scratch_path(i.spark, "table")
    rows = padded(i)
    sinks.append(sinks.clustered(rows.drop("skutype").withColumn("version", F.lit("old")), ["stcode"]), path, ["stcode"])
    fresh = rows.filter("skutype = 'Credit' AND stcode < '00003'").drop("skutype").withColumn("version", F.lit("new"))
    sinks.replace_keys(fresh, path, ["cntdate", "stcode"], ["stcode"])
    return tables.read_table(i.spark, path).select("cntdate", "stcode", "sku", "version")


@check(f"SELECT cntdate, stcode, sku, 'copy' AS version FROM {PADDED} WHERE cntdate BETWEEN '19970101' AND '19971231'")
def sink_copy_partitioned(i: Inputs):
    source, target = scratch_path(i.spark, "source"), scratch_path(i.spark, "target")
    rows = padded(i).drop("skutype").withColumn("version", F.lit("copy"))
    sinks.append(sinks.clustered(rows, ["stcode"]), source, ["stcode"])
    sinks.copy_table(i.spark, source, target, ("cntdate", "19970101", "19971231"), ["stcode"])
    return tables.read_table(i.spark, target).select("cntdate", "stcode", "sku", "version")


@check("""SELECT stcode, cntdate, sku, 'old' AS version FROM v_stk WHERE NOT cntdate BETWEEN '19970101' AND '19970601'
    UNION ALL SELECT stcode, cntdate, sku, 'new' FROM v_stk WHERE cntdate BETWEEN '19970101' AND '19970601' AND rpname = 'STK2'""")
def sink_replace_range(i: Inputs):
    path, rows = stored_by_month(i)
    fresh = rows.filter("cntdate BETWEEN '19970101' AND '19970601' AND rpname = 'STK2'").drop("rpname")
    sinks.replace_range(path, fresh.withColumn("version", F.lit("new")), "cntdate", "19970101", "19970601", ["cntdate"])
    return tables.read_table(i.spark, path).select("stcode", "cntdate", "sku", "version")


def stored_by_month(i: Inputs, condition: str = "true") -> tuple[str, DataFrame]:
    """A table of report lines partitioned by count date, and the lines themselves."""
    path = scratch_path(i.spark, "table")
    rows = i.stk.select("stcode", "sku", "cntdate", "rpname", "skutype")
    old = rows.filter(condition).drop("rpname", "skutype").withColumn("version", F.lit("old"))
    sinks.append(sinks.clustered(old, ["cntdate"]), path, ["cntdate"])
    return path, rows.drop("skutype") if condition == "true" else rows


@check("""SELECT stcode, cntdate, sku, 'old' AS version FROM v_stk WHERE NOT (cntdate IN ('19970101', '19980301') AND stcode = '1')
    UNION ALL SELECT stcode, cntdate, sku, 'new' FROM v_stk WHERE cntdate IN ('19970101', '19980301') AND stcode = '1' AND rpname = 'STK1'""")
def sink_replace_in_list(i: Inputs):
    path, rows = stored_by_month(i)
    source = rows.filter("rpname = 'STK1'").drop("rpname").withColumn("version", F.lit("new"))
    sinks.replace_in_list(path, source, "cntdate", ["19970101", "19980301"], ["cntdate"], stcode="1")
    return tables.read_table(i.spark, path).select("stcode", "cntdate", "sku", "version")


# Months from 1997 on are stored for even ones only; Credit lines of two years come in, by month.
RELOADED = "substring(cntdate, 5, 2) IN ('02', '04', '06', '08', '10', '12')"


@check(f"""SELECT stcode, cntdate, sku, 'old' AS version FROM v_stk o WHERE {RELOADED} AND NOT (cntdate BETWEEN '19970101' AND '19981231' AND
    EXISTS (SELECT 1 FROM v_stk n WHERE n.skutype = 'Credit' AND n.cntdate = o.cntdate AND n.stcode = o.stcode))
    UNION ALL SELECT stcode, cntdate, sku, 'new' FROM v_stk WHERE skutype = 'Credit' AND cntdate BETWEEN '19970101' AND '19981231'""")
def sink_insert_or_reload(i: Inputs):
    path, rows = stored_by_month(i, RELOADED)
    incoming = rows.filter("skutype = 'Credit' AND cntdate BETWEEN '19970101' AND '19981231'").select("stcode", "sku", "cntdate", F.lit("new").alias("version"), F.col("cntdate").alias("file"))
    sinks.insert_new_or_reload(path, incoming, "file", ["cntdate", "stcode", "sku"], ["cntdate", "stcode"], ["cntdate"])
    return tables.read_table(i.spark, path).select("stcode", "cntdate", "sku", "version")


@check("""SELECT stcode, cntdate, sku, 'source' AS place FROM v_stk WHERE NOT cntdate BETWEEN '19970101' AND '19971231'
    UNION ALL SELECT stcode, cntdate, sku, 'archive' FROM v_stk WHERE stcode = '1' AND cntdate = '19970201'
    UNION ALL SELECT stcode, cntdate, sku, 'archive' FROM v_stk WHERE cntdate BETWEEN '19970101' AND '19971231' AND NOT (stcode = '1' AND cntdate = '19970201')""")
def sink_archive_move(i: Inputs):
    source, rows = stored_by_month(i)
    archive = scratch_path(i.spark, "archive")
    held = rows.filter("stcode = '1' AND cntdate = '19970201'").drop("rpname").withColumn("version", F.lit("held"))
    sinks.append(held, archive, ["cntdate"])
    for _ in range(2):  # a repeated run adds nothing
        sinks.archive_move(i.spark, source, archive, ["stcode", "cntdate"], "cntdate", "19970101", "19971231", ["cntdate"])
    left, moved = (tables.read_table(i.spark, p).select("stcode", "cntdate", "sku", F.lit(n).alias("place")) for p, n in ((source, "source"), (archive, "archive")))
    return left.unionByName(moved)


@check("SELECT stcode, cntdate, sku FROM v_stk WHERE cntdate BETWEEN '19970101' AND '19971231'")
def sink_rewrite_and_copy(i: Inputs):
    source, target = scratch_path(i.spark, "source"), scratch_path(i.spark, "target")
    sinks.full_refresh(i.stk.select("stcode", "cntdate", "sku", "rpname"), source)
    sinks.rewrite(tables.read_table(i.spark, source).drop("rpname"), source)
    sinks.copy_table(i.spark, source, target, ("cntdate", "19970101", "19971231"))
    return tables.read_table(i.spark, target)


@check("SELECT sku, des, dept FROM v_master")
def export_csv(i: Inputs):
    path = scratch_path(i.spark, "export")
    sinks.export_csv(i.master.select("sku", "des", "dept"), path, bom=True)
    back = i.spark.read.csv(path, header=True)
    return back.withColumnsRenamed({c: c.lstrip("﻿") for c in back.columns})


@check("""SELECT sku, des || ' "x",' AS des, dept FROM v_master""")
def export_csv_file(i: Inputs):
    path = scratch_path(i.spark, "export") + ".csv"
    rows = i.master.select("sku", F.concat("des", F.lit(' "x",')).alias("des"), "dept").orderBy(F.col("sku").cast("bigint"))
    sinks.export_csv(rows, path, bom=True, single=True)
    back = i.spark.read.csv(path, header=True, escape='"')
    return back.withColumnsRenamed({c: c.lstrip("\ufeff") for c in back.columns})


@check("SELECT 'stk' AS job, count(*) AS record FROM v_stk UNION ALL SELECT 'plan', count(*) FROM v_planm")
def append_log(i: Inputs):
    path = scratch_path(i.spark, "log")
    sinks.append_log(i.spark, path, job="stk", record=i.stk.count())
    sinks.append_log(i.spark, path, job="plan", record=i.planm.count())
    return i.spark.read.schema("job string, record long").json(path)


@check("""SELECT "stocktakeId", "productName", count(*) AS items FROM (SELECT des AS "productName", unnest(['T1', 'T2']) AS "stocktakeId" FROM v_master
    WHERE CAST(sku AS BIGINT) % 4 <> 3) GROUP BY 1, 2""")
def sink_packages(i: Inputs):
    path = scratch_path(i.spark, "packages")
    items = item_master(i)
    for stocktake in ("T1", "T2", "T1"):  # writing a package again replaces it
        sinks.replace_partitions(masters.package_items(items, stocktakeId=stocktake), path, ["stocktakeId"])
    return i.spark.read.parquet(path).groupBy("stocktakeId", "productName").agg(F.count(F.lit(1)).alias("items"))
