"""Small hand-written files through sources and jobs."""

import csv
import decimal
import gzip
import io
import os
import random
import re
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from shelfcount import layouts
from shelfcount.functions import text
from shelfcount.operators import clean, gates, maintain, stock, variance
from shelfcount.plans import reports, soh, uploads
from shelfcount.policy import SOH_POLICIES
from shelfcount.sources import delimited, keyed, lines, sinks, tables, workbook
from shelfcount_checks.files import _xlsx


def values(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def put(folder, name, data):
    with open(os.path.join(folder, name), "wb") as target:
        target.write(data)


def test_thai_code_page(spark, tmp_path):
    put(tmp_path, "a.csv", "1,ข้าวสาร,\"x,y\"\n2,,z\n".encode("cp874") + b"3,\xdb\xa1,w\n")
    kept = delimited.scan_positional(spark, str(tmp_path), ["id", "name", "note"], encoding="cp874")
    assert values(kept, "*") == [("1", "ข้าวสาร", "x,y"), ("2", None, "z"), ("3", "�ก", "w")]
    cut = delimited.scan_positional(spark, str(tmp_path), ["id", "name", "note"], encoding="cp874", errors="ignore")
    assert ("3", "ก", "w") in values(cut, "*")


def test_whole_code_page(spark, tmp_path):
    every = bytes(b for b in range(0x80, 0x100))
    put(tmp_path, "a.csv", b"x," + every + b"\n")
    got = delimited.scan_positional(spark, str(tmp_path), ["k", "v"], encoding="cp874").first()["v"]
    assert got == every.decode("cp874", errors="replace")


def test_headered_with_quotes(spark, tmp_path):
    put(tmp_path, "a.csv", b"'MSSTOR','MSTYPE',MSASDT,MSSTOH\n'001','1',20260101,5\n'001','3',20260101,' '\n")
    df = delimited.scan_headered(spark, str(tmp_path))
    assert df.columns == ["msstor", "mstype", "msasdt", "msstoh"]
    out = soh.snapshot_job(df.withColumn("mssku", F.lit("s")), SOH_POLICIES["PWB"])
    assert values(out["snapshot"], "code", "food_credit", "totalsoh") == [("PWB001", 5.0, 5.0)]


def test_stock_file_layout(spark, tmp_path):
    cells = dict.fromkeys(layouts.STOCK_FILE, "")
    cells.update(msstor="50001", mstype="01", msasdt="260101", msstoh="7", mssku="s", mssdpt="100", msvdno="v")
    put(tmp_path, "a.csv", (",".join(cells.values()) + "\n").encode())
    raw = delimited.scan_positional(spark, str(tmp_path), layouts.STOCK_FILE, encoding="cp874")
    out = soh.snapshot_job(raw, SOH_POLICIES["OFM"])
    assert values(out["snapshot"], "code", "DATE", "totalsoh") == [("OFM50001", "20260101", 7.0)]
    assert (len(layouts.STOCK_FILE), len(layouts.ITEM_MASTER)) == (67, 186)


def test_pipe_master(spark, tmp_path):
    put(tmp_path, "m.txt", "9|7|0012345678905|น้ำ|5\n".encode("cp874"))
    df = delimited.scan_pipe(spark, str(tmp_path), ["cyclecount", "stcode", "barcode", "description", "soh"], stocktakeid="T")
    assert values(df, "stcode", "barcode", "description", "stocktakeid") == [("007", "0012345678905", "น้ำ", "T")]


def test_skip_lines_of_every_file(spark, tmp_path):
    for n in range(3):
        put(tmp_path, f"f{n}.txt", f"title\nmore\nsku,qty\ns{n},1\n,2\nt{n},\"3,4\"\n".encode())
    df = delimited.scan_skip(spark, str(tmp_path), ["sku", "qty"], skip=3, key="sku")
    assert values(df, "*") == sorted([(f"s{n}", "1") for n in range(3)] + [(f"t{n}", "3,4") for n in range(3)], key=str)
    one = delimited.scan_skip(spark, str(tmp_path), ["sku", "qty"], skip=1)
    assert ("more", None) in values(one, "*") and ("title", None) not in values(one, "*")


def test_every_file_has_its_own_header(spark, tmp_path):
    put(tmp_path, "a.csv", b"sku,stoh\n1,10\n")
    put(tmp_path, "b.csv", b"'STOH' ,sku,more\n2,20,x\n")
    put(tmp_path, "c.csv", b"\nsku\n30\n")
    df = delimited.scan_headered(spark, str(tmp_path))
    assert values(df, "sku", "stoh") == sorted([("1", "10"), ("20", "2"), ("30", None)], key=str)
    named = delimited.scan_folder(spark, str(tmp_path), ["stoh", "SKU", "other"])
    assert named.columns == ["stoh", "SKU", "other", "file"]
    assert values(named, "*") == sorted([("10", "1", None, "a.csv"), ("2", "20", None, "b.csv"), (None, "30", None, "c.csv")], key=str)


def test_skip_counts_physical_lines(spark, tmp_path):
    put(tmp_path, "a.csv", b"title\n\nsku,des\n1,x\x01y\n\n2,b\n")
    for skip, want in ((3, [("1", "x\x01y"), ("2", "b")]), (1, [("1", "x\x01y"), ("2", "b"), ("sku", "des")])):
        for multiline in (False, True):
            df = delimited.scan_skip(spark, str(tmp_path), ["sku", "des"], skip=skip, multiline=multiline)
            assert values(df, "*") == want


def test_line_ends_in_quoted_cells(spark, tmp_path):
    put(tmp_path, "a.csv", b't\nsku,des\r\n1,"a ""q""\r\nb"\r\n2,c\n')
    df = delimited.scan_skip(spark, str(tmp_path), ["sku", "des"], skip=2, multiline=True)
    assert values(df, "*") == [("1", 'a "q"\r\nb'), ("2", "c")]
    put(tmp_path, "a.csv", b'sku,des\n1,"a\nb"\n')
    assert values(delimited.scan_headered(spark, str(tmp_path), multiline=True), "*") == [("1", "a b")]  # cells are cleaned


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_skipping_is_one_scan(spark, tmp_path, small_splits):
    put(tmp_path, "a.csv", b"t\n" + b"".join(b"%d,x\n" % k for k in range(20000)))
    put(tmp_path, "b.csv", b"t\n20000,x\n")
    put(tmp_path, "c.csv", b"t")
    df = delimited.scan_skip(spark, str(tmp_path), ["k", "v"], skip=1)
    assert df.rdd.getNumPartitions() > 20
    assert sorted(int(r.k) for r in df.collect()) == list(range(20001))
    plan = executed(df)
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan


def test_skipped_lines_beyond_the_first_split_are_an_error(spark, tmp_path, small_splits):
    put(tmp_path, "a.csv", b"title\n" * 2000 + b"1,x\n")
    with pytest.raises(Exception, match="first split"):
        delimited.scan_skip(spark, str(tmp_path), ["k", "v"], skip=1999).collect()


def test_layouts_are_read_by_one_scan(spark, tmp_path):
    for n in range(9):
        head = [b"sku,stoh", b"STOH ,more,sku", b"x,'sku',y,stoh"][n % 3]
        row = [b"%d,7", b"7,m,%d", b"x,%d,y,7"][n % 3]
        put(tmp_path, f"f {n}+é%.csv", b"\xef\xbb\xbf"[: 3 * (n % 2)] + head + b"\n" + b"\n".join(row % k for k in range(50)) + b"\n")
    df = delimited.scan_headered(spark, str(tmp_path)).select("sku", "stoh")
    assert values(df, "*") == sorted([(str(k), "7") for k in range(50)] * 9, key=str)
    assert executed(df).count("FileScan") == 1
    folder = delimited.scan_folder(spark, str(tmp_path), ["sku"])
    assert {r.file for r in folder.select("file").distinct().collect()} == {f"f {n}+é%.csv" for n in range(9)}
    one = delimited.scan_headered(spark, f"{tmp_path}/f 0*.csv")
    assert "Join" not in executed(one) and one.count() == 50


def test_headers_are_read_from_the_first_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lines, "HEAD_BYTES", 3)
    put(tmp_path, "a.csv", b"\n \r\nlong name,b\r\n1,2\r\n")
    put(tmp_path, "b.csv", b"long name,b")
    put(tmp_path, "c.csv", b"\n\n")
    put(tmp_path, "d.csv.gz", gzip.compress(b"b,long name\n3,4\n"))
    found = dict(zip("abcd", lines.heads(spark, sorted(spark.read.text(str(tmp_path)).inputFiles()), "UTF-8")))
    assert found == {"a": "long name,b", "b": "long name,b", "c": None, "d": "b,long name"}
    assert values(delimited.scan_headered(spark, str(tmp_path)), "long name", "b") == [("1", "2"), ("4", "3")]


def cells_of(text, skip, width):
    """Records of a text read as a whole, by the csv module."""
    for _ in range(skip):
        text = re.sub(r"^[^\r\n]*(\r\n|\r|\n|$)", "", text)
    rows = csv.reader(io.StringIO(text, newline=""), strict=False)
    return sorted([tuple((c or None) for c in (r + [None] * width)[:width]) for r in rows if any(c.strip() for c in r)], key=str)


@pytest.mark.parametrize("seed", range(4))
def test_quotes_that_span_splits(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    want = []
    for n in range(4):
        rows = ['odd " title', "", "k,v,w"]
        for k in range(rng.randrange(1, 150)):
            long = "\n".join("x" * rng.randrange(0, 90) for _ in range(rng.choice([1, 1, 1, 2, 9, 80])))
            cell = long.replace("x\n", rng.choice(["x\n", 'q""\n', "\r\n", ",\n"]))
            rows.append(f'{n}-{k},"{cell}",{rng.choice(["a", "", chr(34) + "b,c" + chr(34)])}')
        text = rng.choice(["\n", "\r\n"]).join(rows) + rng.choice(["", "\n"])
        put(tmp_path, f"f{n}.csv", text.encode())
        want += cells_of(text, 3, 3)
    df = delimited.scan_skip(spark, str(tmp_path), ["k", "v", "w"], skip=3, multiline=True)
    assert values(df, "*") == sorted(want, key=str)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    headered = delimited.scan_positional(spark, str(tmp_path), ["k", "v", "w"], multiline=True)
    assert headered.filter("k = '0-0'").count() <= 1  # the odd mark of the title shifts every record after it


def test_headered_records_span_splits(spark, tmp_path, small_splits):
    text = '"k", V\n' + "".join(f'{k},"line one of {k}\nline two"\n' for k in range(500))
    put(tmp_path, "a.csv", text.encode())
    put(tmp_path, "b.csv", b"\nv,z,k\n" + b'"m\nn",2,500\n')
    df = delimited.scan_folder(spark, str(tmp_path), ["k", "v"], multiline=True)
    assert sorted((int(r.k), r.v) for r in df.collect()) == [(k, f"line one of {k}\nline two") for k in range(500)] + [(500, "m\nn")]


def test_a_mark_left_open_takes_the_rest_of_the_file(spark, tmp_path, small_splits):
    rest = "\n".join(f"row {k},x" for k in range(900))
    put(tmp_path, "a.csv", f'1,a\n2,"{rest}'.encode())
    put(tmp_path, "b.csv", b"3,c\n")
    rows = lines.records(spark.read, str(tmp_path), 0).collect()
    assert sorted(r.value for r in rows) == ["1,a", f'2,"{rest}', "3,c"]


def test_title_with_a_one_digit_day(spark, tmp_path):
    put(tmp_path, "a.xlsx", _xlsx({"S": [["Stock on 9-Mar-2026"]]}))
    put(tmp_path, "b.xlsx", _xlsx({"S": [["Stock on 19-Mar-2026"]]}))
    put(tmp_path, "c.xlsx", _xlsx({"S": [["Stock of some day"]]}))
    dates = workbook.title_date(workbook.workbooks(spark, str(tmp_path)), "S")
    assert values(dates, "file", "DATE") == [("a.xlsx", "20260309"), ("b.xlsx", "20260319")]


def test_folder_skips_empty_and_other_files(spark, tmp_path):
    put(tmp_path, "a.csv", b"k\n1\n")
    put(tmp_path, "b.txt", b"k\n2\n")
    put(tmp_path, "c.csv", b"")
    put(tmp_path, "d.log", b"k\n9\n")
    df = delimited.scan_folder(spark, str(tmp_path), ["k"])
    assert values(df, "k", "file") == [("1", "a.csv"), ("2", "b.txt")]


def test_workbook_cells(spark, tmp_path):
    put(tmp_path, "b.xlsx", _xlsx({"Other": [["x"]], " Sheet 1": [["t"], [], ["Sku ", "Qty\nCounted", None, "Z"], ["001", 5, "gap", "é"], [None, None], ["002", 2.5]]}))
    put(tmp_path, "empty.xlsx", b"")
    df = workbook.scan_workbook(spark, str(tmp_path), ["z", "sku", "qty counted", "none"], sheet="SHEET1", skip_rows=2)
    assert values(df, "line", "sku", "qty counted", "z", "none") == [(4, "001", "5", "é", None), (6, "002", "2.5", None, None)]
    capped = workbook.scan_workbook(spark, str(tmp_path), ["a", "b"], sheet="sheet1", usecols="A:B", skip_rows=3, max_rows=1, header=False)
    assert values(capped, "a", "b") == [("001", "5")]
    assert workbook.scan_workbook(spark, str(tmp_path), ["a"], sheet="missing").count() == 0


def sheet_book(sheet: str) -> bytes:
    """A workbook whose only sheet is the given XML, with shared texts and a date style."""
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as out:
        out.writestr("xl/workbook.xml", '<workbook xmlns:r="x"><sheets><sheet name="S" sheetId="1" r:id="a"/></sheets></workbook>')
        out.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="worksheets/sheet1.xml"/></Relationships>')
        out.writestr("xl/sharedStrings.xml", "<sst><si><t>first</t></si><si><r><t>sec</t></r><r><t>ond</t></r></si></sst>")
        out.writestr("xl/styles.xml", '<styleSheet><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        out.writestr("xl/worksheets/sheet1.xml", sheet)
    return book.getvalue()


PLAIN_ROWS = (
    '<row r="2" spans="1:4" ht="15"><c r="A2" t="s"><v>1</v></c><c r="B2" s="1"><v>45292.5</v></c><c r="C2" s="0" t="n"><v>5</v></c><c r="D2" t="b"><v>1</v></c></row>\n'
    '<row r="3"/><row r="4" spans="1:2"/><row r="5"><c r="A5" s="1"/><c r="B5" t="e"><v>#N/A</v></c></row>'
    '<row r="7"><c r="A7" t="str"><f>B1&amp;"x"</f><v>a &amp;lt; &lt;&quot;b&quot;&gt;</v></c><c r="D7" t="inlineStr"><is><t xml:space="preserve"> é </t></is></c><c r="AA7"><v>9</v></c></row>'
)
PLAIN = [(2, ["second", "2024-01-01 12:00:00", "5", "True"]), (7, ['a &lt; <"b">', None, None, " é "])]
# A row without a number, rich text, a numbered character, a comment with a row in it, marked text.
ODD_ROWS = (
    '<row><c t="inlineStr"><is><r><t>ri</t></r><r><t>ch</t></r></is></c><c><v>7</v></c></row>',
    '<row r="8"><c r="A8" t="inlineStr"><is><t>rich</t></is></c><!-- </row><row r="9"> --><c r="B8"><v>7</v></c></row>',
    '<row r="8"><c r="A8" t="str"><v>ri&#99;h</v></c><c r="B8"><v><![CDATA[7]]></v></c></row>',
)


@pytest.mark.parametrize("chunk", [40, 1 << 20])
def test_sheet_rows_of_every_form(monkeypatch, chunk):
    monkeypatch.setattr(workbook, "CHUNK", chunk)
    whole = '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="m"><sheetData>{}</sheetData><x/></worksheet>'
    if chunk == 40:
        whole = whole.replace('<?xml version="1.0" encoding="UTF-8"?>', "").replace(' xmlns="m"', "")
    for odd in ODD_ROWS:
        content = sheet_book(whole.format(PLAIN_ROWS + odd + PLAIN_ROWS.replace('r="2"', 'r="10"').replace('r="7"', 'r="17"')))
        rows = list(workbook.sheet_rows(content, "s", range(4)))
        assert rows == [*PLAIN, (8, ["rich", "7", None, None]), (10, PLAIN[0][1]), (17, PLAIN[1][1])]
    with pytest.raises(ElementTree.ParseError):
        list(workbook.sheet_rows(sheet_book(whole.format(PLAIN_ROWS)[:-30]), "S", range(4)))
    assert list(workbook.sheet_rows(sheet_book("<worksheet><sheetData/></worksheet>"), "S", range(4))) == []


def test_plain_sheets_are_not_built_as_trees(monkeypatch):
    # F1 to F4, F6: an element for every tag of every cell was most of the time of the workbook jobs.
    parts = workbook._parts
    monkeypatch.setattr(workbook, "_parts", lambda book, name, wanted: pytest.fail("tree") if wanted == "row" else parts(book, name, wanted))
    content = sheet_book(f"<worksheet><sheetData>{PLAIN_ROWS}</sheetData></worksheet>")
    assert list(workbook.sheet_rows(content, "S", range(4))) == PLAIN
    made = _xlsx({"S": [["a", 1.5, None, "<&>"], [], ["b"]]})
    assert list(workbook.sheet_rows(made, "S", range(4))) == [(1, ["a", "1.5", None, "<&>"]), (3, ["b", None, None, None])]


def test_title_date_and_two_sheets(spark, tmp_path):
    rows = [["Stock on 09-Mar-2026"], [], [], [None, "101", *[None] * 5, 5, None, 6, None, 7, None, 18]]
    put(tmp_path, "s.xlsx", _xlsx({"V 1": rows, "V 2": rows}))
    out = soh.store_summary(workbook.workbooks(spark, str(tmp_path)), ["V 1", "V 2"], "CFR")
    assert values(out, "*") == [("CFR101", "CFR", "101", "5", "6", "7", "18", "20260309")] * 2


HEAD = ["Group", "Department", "Barcode", "Name", "Count", "Add/Edit", "Scan Error", "PST/Store", "Remark (Root Cause)", "Note"]
LINE = ["G", "D", "885", "n", 4, None, 1, " ssd", "lost", None]
PAD = [None] * 11


def test_approved_workbooks(spark, tmp_path):
    whole = [["t"], [*PAD, "a", "b"], [*PAD, 1, 2], [*PAD, 3, 4], [*PAD, 5, 6], [], HEAD, LINE, LINE]
    put(tmp_path, "Missrate_B2S_50001_20260101.xlsx", _xlsx({"Summary": whole}))
    put(tmp_path, "Missrate_B2S_50002_20260101.xlsx", _xlsx({"Summary": [["t"], [], [], [], [], [], HEAD, LINE]}))
    null = [*LINE[:8], None, None]
    put(tmp_path, "Missrate_B2S_50003_20260101.xlsx", _xlsx({"Summary": [*whole, null]}))
    put(tmp_path, "Missrate_B2S_50009_20260101.xlsx", _xlsx({"Summary": whole}))
    put(tmp_path, "odd_name.xlsx", _xlsx({"Summary": whole}))
    put(tmp_path, "Missrate_B2S_50004_20260101.xlsx", _xlsx({"Summary": whole}))
    visits = [(s, "20260101", "b") for s in ("50001", "50002", "50003")] + [("50004", "20260101", None)]
    plan = spark.createDataFrame(visits, "stcode string, cntdate string, branch string")
    files = workbook.workbooks(spark, str(tmp_path))
    rows = uploads.approved_rows(files, plan)
    assert values(rows, "stcode", "`pst/store`", "count", "`all scan-pst`", "`sku weright-outsource`") == [("50001", "OUTSOURCE", 4.0, 1.0, 6.0)]
    target = rows.drop("file").withColumn("name", F.lit("old")).unionByName(rows.drop("file").withColumn("stcode", F.lit("50002")))
    out = uploads.import_approved(files, plan, target)
    assert values(out, "stcode", "name") == [("50001", "n"), ("50002", "n")]


def test_rows_of_approved_workbooks_are_moved_once(spark, tmp_path, monkeypatch):
    # files are settled by themselves; their rows were joined, grouped and shuffled for each check.
    monkeypatch.setattr(uploads, "replace_keys", lambda target, incoming, keys, coming: (incoming, coming))
    whole = [["t"], [*PAD, "a", "b"], [*PAD, 1, 2], [*PAD, 3, 4], [*PAD, 5, 6], [], HEAD, LINE, [*LINE[:4], "4.0", *LINE[5:]]]
    put(tmp_path, "Missrate_B2S_50001_20260101.xlsx", _xlsx({"Summary": whole}))
    plan = spark.createDataFrame([("50001", "20260101", "b")], "stcode string, cntdate string, branch string")
    rows, keys = uploads.import_approved(workbook.workbooks(spark, str(tmp_path)), plan, None)
    assert values(keys, "stcode", "cntdate") == [("50001", "20260101")]
    assert values(rows, "barcode", "count") == [("885", 4.0)]
    moves = rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert moves == 1


def test_file_stem_of_odd_names(spark):
    names = ["/x/y.z/a_b.tar.gz", "c:\\d\\e.csv", "none", ".hid", "a.", "x/", "a.b/c", None]
    df = spark.createDataFrame([(n,) for n in names], "p string").select(text.file_stem("p").alias("s"))
    assert [r.s for r in df.collect()] == ["a_b.tar", "e", "none", "", "a", "", "c", None]
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_file_names_of_reports_are_taken_apart_once(spark):
    # the keys' tests, moved below them, took the name of every row apart once for each key.
    raw = spark.createDataFrame([("a_b_50001_20260101_0.xlsx", 3, "885", "1", "2")], "file string, line long, sku string, soh string, qty_count string")
    raw = raw.withColumns({"cost": F.lit("1"), "retail": F.lit("2")}).unionByName(raw.withColumns({"file": F.lit("odd.xlsx"), "cost": F.lit("1"), "retail": F.lit("2")}))
    plan = spark.createDataFrame([("b", "50001", "20260101", "3F", "x")], "bu string, stcode string, cntdate string, atype string, branch string")
    loaded = spark.createDataFrame([("50009", "20260101", "Credit", "a")], "stcode string, cntdate string, skutype string, rpname string")
    out = reports.import_report(raw, reports.WHOLESALE_BOOK, plan, loaded)
    assert values(out, "rpname", "stcode", "sku", "qty_var") == [("a", "50001", "885", decimal.Decimal("1.000"))]
    plan_lines = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("split(" in line for line in plan_lines if "Filter " in line)
    # The keys of a gate have a known size, so the report rows stay where they are.
    assert out._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 2


def test_report_families(spark, tmp_path):
    book = [["STORE", "COUNTNAME", "SKU"], ["50001", "XB1", "a"], ["50001", "XB1", "a"], ["50002", "XB1", "b"], ["50001", None, "c"], ["50001", "XB1", None]]
    put(tmp_path, "STK1_B2S_50001_20260101_0.xlsx", _xlsx({"s": book}))
    put(tmp_path, "STK1_B2S_50007_20260101_0.xlsx", _xlsx({"s": book}))
    raw = workbook.scan_workbook(spark, str(tmp_path), ["store", "countname", "sku"])
    for store in ("50003", "50004"):
        put(tmp_path, f"STK1_B2S_{store}_20260101_0.xlsx", _xlsx({"s": [book[0], [store, "XB1", "a"]]}))
    visits = [("50001", "3F", "b"), ("50001", "3F", "b"), ("50001", "4V", None), ("50003", "4V", "b"), ("50004", "3F", None)]
    plan = spark.createDataFrame([("B2S", s, "20260101", a, b) for s, a, b in visits], "bu string, stcode string, cntdate string, atype string, branch string")
    loaded = spark.createDataFrame([], "bu string, stcode string, cntdate string, skutype string, rpname string")
    out = reports.import_report(raw, reports.STORE_BOOK, plan, loaded)
    kept = [("50001", "", "Credit", "STK1"), ("50001", "a", "Credit", "STK1"), ("50001", "a", "Credit", "STK1"), ("50001", "c", "Consign", "STK1")]
    assert values(out, "stcode", "sku", "skutype", "rpname") == kept
    whole = reports.prepare_report(raw, reports.STORE_BOOK_FILE)
    assert whole.count() == 0


def test_count_families(spark, tmp_path):
    head = ["cntnum", "skcode", "prtype"]
    good = [head, ["60001F010126001", "a", "Credit"], ["60001F010126001", "b", "Consign"]]
    bad = [head, ["60002F010126001", "a", "Credit"], ["60001F010126001", "b", "Credit"]]
    put(tmp_path, "VAR1_CFW_60001_20260101_0.xlsx", _xlsx({"Sheet1": good}))
    put(tmp_path, "VAR1_CFW_60002_20260101_0.xlsx", _xlsx({"Sheet1": bad}))
    raw = workbook.scan_workbook(spark, str(tmp_path), head)
    visits = [("CFW", s, "20260101", "3F", "b") for s in ("60001", "60002")]
    plan = spark.createDataFrame(visits, "bu string, stcode string, cntdate string, atype string, branch string")
    loaded = spark.createDataFrame([("CFW", "60001", "20260101", "VAR1", "Credit")], "bu string, stcode string, cntdate string, rpname string, prtype string")
    out = reports.import_report(raw, reports.STORE_COUNT, plan, loaded)
    assert values(out, "cntnum", "skcode") == [("60001F010126001", "b")]
    var = spark.createDataFrame([("60001F010126001", "Credit")], "cntnum string, prtype string")
    stk = spark.createDataFrame(
        [("STK1_CFW_60001_20260101_0.xlsx", 2, "60001F010126001", "60001", "a", "20260109"), ("STK1_CFW_60003_20260101_0.xlsx", 2, "x", "60003", "a", "20260109")],
        "file string, line int, cntnum string, stmerch string, sku string, cntdate string",
    )
    typed = reports.prepare_report(stk, reports.COUNT_BOOK, var)
    assert values(typed, "stcode", "skutype", "cntdate") == [("60001", "Credit", "20260109")]
    detail = reports.prepare_report(raw, reports.COUNT_DETAIL)
    assert ("60001", "20260101", "VAR1", "b") in values(detail, "stcode", "cntdate", "rpname", "skcode")


def test_wholesale_short_names(spark):
    schema = "file string, line int, sku string, soh string, qty_count string, retail string, cost string"
    raw = spark.createDataFrame([("CUST123456_2026-01-31_x.xlsx", 7, None, "2", "2.5005", "10", "4"), ("odd.xlsx", 7, "a", "1", "1", "1", "1")], schema)
    rows = reports.prepare_report(raw, reports.WHOLESALE_SHORT_NAME, report="STK2").filter("stcode is not null")
    assert values(rows, "stcode", "cntdate", "rpname", "sku", "skutype") == [("W123456", "20260131", "STK2", "", "Credit")]
    assert [float(v) for v in rows.select("qty_var", "extrtl_var", "extcst_var").first()] == [0.5, 5.0, 2.0]


def test_estimate_load(spark):
    raw = spark.createDataFrame([(1, "2026-01-02"), (0, "2026-01-02"), (2, "x"), (3, None)], "empcode int, date string")
    from shelfcount.plans import staffing

    assert values(staffing.estimate_rows(raw), "empcode") == [(1,)]


def test_csv_export_marks_every_part(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.export_csv(spark.createDataFrame([(1, 'a"b'), (2, "c,d")], "id int, v string").repartition(2), path, bom=True)
    parts = [p for p in os.listdir(path) if p.endswith(".csv")]
    assert all(open(os.path.join(path, p), "rb").read().startswith("﻿id,v".encode()) for p in parts)


def test_one_file_of_csv(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    rows = [(k, ["a,b", 'q"q', "", None, "plain", "two\nlines"][k % 6]) for k in range(3000)]
    df = spark.createDataFrame(rows, "id int, `v, w` string").repartition(7).orderBy("id")
    for _ in range(2):  # the second export takes the place of the first
        sinks.export_csv(df, path, bom=True, single=True)
    data = open(path, "rb").read()
    assert data.count("﻿".encode()) == 1 and data.startswith("﻿".encode())
    read = list(csv.reader(io.StringIO(data.decode("utf-8-sig"), newline="")))
    assert read == [["id", "v, w"], *[[str(k), v or ""] for k, v in rows]]
    assert [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["out.csv"]
    sinks.export_csv(df.limit(0), path, single=True)
    assert open(path, "rb").read() == b'id,"v, w"\n'


def test_partition_keys_open_no_file(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = [("00123", "a b"), ("1+1", "x/y=z"), (None, "100%"), ("é", "{[^:?*]}")]
    spark.createDataFrame([(*k, n) for k in keys for n in range(3)], "s string, d string, v int").write.partitionBy("s", "d").parquet(path)
    found = keyed.partition_keys(spark, path, ["d", "s"])
    assert values(found, "s", "d") == sorted(keys, key=str)
    plan = executed(found)
    assert "FileScan binaryFile" in plan and "parquet" not in plan.lower().replace(".parquet", "") and "content" not in plan
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                put(folder, name, b"no table")
    assert found.count() == 4


def test_gates_read_keys_and_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200).selectExpr("CAST(id % 5 AS STRING) AS store", "id % 3 AS kind", "id AS line")
    keys = ["store", "kind"]
    keyed.prepare_keyed(spark, path, rows.schema, keys)
    assert keyed.loaded_keys(spark, path).count() == 0
    keyed.append_load(rows.filter("store < '2'"), path, "one", keys)
    gate = gates.not_loaded(rows, keyed.loaded_keys(spark, path), keys)
    assert not any(f"{path}/" in f for f in gate.inputFiles()) and any("t_keys/" in f for f in gate.inputFiles())
    assert values(gate.select("store").distinct(), "store") == [("2",), ("3",), ("4",)]
    # A load that failed between its rows and its keys, and one that failed after both.
    for _ in range(2):
        fresh = gates.not_loaded(rows, keyed.loaded_keys(spark, path, "two"), keys)
        keyed.append_load(fresh, path, "two", keys)
    assert values(keyed.loaded_rows(spark, path), "line") == sorted([(k,) for k in range(200)], key=str)
    keyed.sum_keys(spark, path)
    assert values(keyed.loaded_keys(spark, path), *keys) == sorted([(str(a), b) for a in range(5) for b in range(3)], key=str)
    assert sorted(f.split("-")[0] for f in os.listdir(f"{path}_keys") if f.startswith("load_id=")) == ["load_id=none", "load_id=sum"]
    assert gates.not_loaded(rows, keyed.loaded_keys(spark, path), keys).count() == 0


def test_highest_id_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(500).selectExpr("CASE WHEN id % 7 > 0 THEN id END AS id", "CAST(id AS STRING) AS store", "'00' AS p").write.partitionBy("p").parquet(path)
    plan = tables._footers_only(spark).read.parquet(path).agg(F.max("id"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(id)]" in plan
    assert tables.stored_max(spark, path, "id") == 499
    empty, nulls = str(tmp_path / "e"), str(tmp_path / "n")
    spark.range(0).write.parquet(empty)
    spark.range(9).selectExpr("CAST(NULL AS BIGINT) AS id").write.parquet(nulls)
    assert tables.stored_max(spark, empty, "id") is None and tables.stored_max(spark, nulls, "id") is None
    rows = spark.range(505).toDF("id")
    assert stock.high_water(rows, tables.stored_max(spark, path, "id"), "id").count() == 5
    assert stock.high_water(rows, tables.stored_max(spark, nulls, "id"), "id").count() == 505


def test_archive_is_read_in_its_range_only(spark, tmp_path):
    source = spark.range(40).selectExpr("CAST(2000 + id % 4 AS STRING) AS day", "id")
    path = str(tmp_path / "archive")
    source.filter("id < 20").write.partitionBy("day").parquet(path)
    archive = tables.read_table(spark, path)
    fresh = maintain.rows_to_archive(source, archive, ["id", "day"], "day", "2001", "2002")
    assert values(fresh, "id") == sorted([(k,) for k in range(20, 40) if k % 4 in (1, 2)], key=str)
    scans = [x for x in executed(fresh).splitlines() if "FileScan" in x]
    assert len(scans) == 1 and "PartitionFilters: [isnotnull(day" in scans[0]


def test_both_report_levels_from_one_scan(spark, tmp_path):
    path = str(tmp_path / "lines")
    cells = ["stock", "qnt", "variance", "qnt_retail", "qnt_cost", "var_retail", "var_cost"]
    rows = spark.range(400).selectExpr(
        "CAST(id % 3 AS STRING) AS stcode", "'d' AS cntdate", "CASE WHEN id % 2 = 0 THEN 'STK1' ELSE 'STK2' END AS rpname", "'Credit' AS skutype",
        "CASE WHEN id % 5 > 0 THEN CAST(id % 5 AS STRING) END AS dept", "'s' AS sub_dept", *[f"(id * {n + 3}) % 11 - 5 AS {c}" for n, c in enumerate(cells)],
    )
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    both = variance.reports_by_level(stored)
    assert executed(both).count("FileScan") == 1
    for level, want in (("store", variance.store_report(stored)), ("dept", variance.dept_report(stored))):
        got = both.filter(F.col("level") == level).select(*want.columns)
        assert values(got, "*") == values(want, "*")


def test_rewrite_reads_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(spark.range(10), path)
    sinks.rewrite(spark.read.parquet(path).filter("id > 6"), path)
    assert values(spark.read.parquet(path), "id") == [(7,), (8,), (9,)]


def test_replace_keys_touches_few_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "day string, k int, v string"
    sinks.append(spark.createDataFrame([("a", 1, "o"), ("a", 2, "o"), ("b", 1, "o"), (None, 1, "o"), (None, 3, "o")], schema), path, ["day"])
    untouched = sorted(os.listdir(os.path.join(path, "day=b")))
    fresh = spark.createDataFrame([("a", 1, "n"), (None, 1, "n"), ("c", 1, "n")], schema)
    sinks.replace_keys(fresh.filter("day is not null"), path, ["day", "k"], ["day"])
    want = [("a", 1, "n"), ("a", 2, "o"), ("b", 1, "o"), ("c", 1, "n"), (None, 1, "o"), (None, 3, "o")]
    assert values(spark.read.parquet(path), "day", "k", "v") == sorted(want, key=str)
    assert sorted(os.listdir(os.path.join(path, "day=b"))) == untouched
    picked = sinks.touched_partitions(spark.read.parquet(path), fresh, ["day"])
    assert values(picked, "day", "k") == sorted([("a", 1), ("a", 2), ("c", 1), (None, 1), (None, 3)], key=str)
    assert "isnull(day" in picked._jdf.queryExecution().toString()


def test_owned_scratch_is_deleted(spark):
    from shelfcount.session import durable, owned_scratch

    with owned_scratch(spark) as folder:
        kept = durable(spark.range(5))
        assert kept.count() == 5 and os.listdir(folder.removeprefix("file:").replace("//", "/"))
    assert not os.path.exists(folder.removeprefix("file:").replace("//", "/"))
    assert durable(spark.range(3)).count() == 3


def files_of(path, part):
    return sorted(f for f in os.listdir(os.path.join(path, part)) if f.endswith(".parquet"))


def test_partition_keys_stay_text(spark, tmp_path):
    path, copy = str(tmp_path / "t"), str(tmp_path / "c")
    schema = "stcode string, k string, v string"
    sinks.append(spark.createDataFrame([("00123", "a", "o"), ("00123", "z", "o"), ("00124", "a", "o")], schema), path, ["stcode"])
    sinks.replace_keys(spark.createDataFrame([("00123", "a", "n")], schema), path, ["stcode", "k"], ["stcode"])
    want = [("00123", "a", "n"), ("00123", "z", "o"), ("00124", "a", "o")]
    assert values(tables.read_table(spark, path), "stcode", "k", "v") == want
    assert {p for p in os.listdir(path) if "=" in p} == {"stcode=00123", "stcode=00124"}
    sinks.copy_table(spark, path, copy, partition_by=["stcode"])
    assert values(tables.read_table(spark, copy), "stcode", "k", "v") == want
    assert {p for p in os.listdir(copy) if "=" in p} == {"stcode=00123", "stcode=00124"}


def test_scan_is_bounded_however_many_partitions_are_touched(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(2200).selectExpr("lpad(cast(id as string), 5, '0') AS day", "id AS k")
    sinks.append(rows.coalesce(1), path, ["day"])
    for low, high in ((100, 105), (100, 2100)):
        fresh = rows.filter(F.col("k").between(low, high - 1))
        picked = sinks.touched_partitions(tables.read_table(spark, path), fresh, ["day"])
        assert picked.count() == high - low
        plan = picked._jdf.queryExecution().executedPlan().toString()
        assert "(day" in plan and f">= {low:05d}" in plan and f"<= {high - 1:05d}" in plan


def test_delta_writers_leave_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "day string, k int"
    rows = spark.createDataFrame([(f"d{d}", k) for d in range(6) for k in range(5)], schema)
    sinks.append(sinks.clustered(rows, ["day"]), path, ["day"])
    kept = {p: files_of(path, p) for p in ("day=d0", "day=d5")}
    assert all(len(f) == 1 for f in kept.values())
    sinks.replace_range(path, spark.createDataFrame([("d2", 9)], schema), "day", "d2", "d3", ["day"])
    assert values(tables.read_table(spark, path), "day", "k") == sorted([(f"d{d}", k) for d in (0, 1, 4, 5) for k in range(5)] + [("d2", 9)], key=str)
    sinks.replace_in_list(path, spark.createDataFrame([("d1", 8), ("d4", 8), ("d0", 8)], schema), "day", ["d1", "d4"], ["day"])
    assert values(tables.read_table(spark, path), "day", "k") == sorted([(f"d{d}", k) for d in (0, 5) for k in range(5)] + [("d1", 8), ("d2", 9), ("d4", 8)], key=str)
    archive = str(tmp_path / "a")
    sinks.append(spark.createDataFrame([("d9", 1)], schema), archive, ["day"])
    before = files_of(archive, "day=d9")
    sinks.archive_move(spark, path, archive, ["day", "k"], "day", "d1", "d4", ["day"])
    assert values(tables.read_table(spark, path), "day", "k") == sorted([(f"d{d}", k) for d in (0, 5) for k in range(5)], key=str)
    assert values(tables.read_table(spark, archive), "day", "k") == [("d1", 8), ("d2", 9), ("d4", 8), ("d9", 1)]
    assert files_of(archive, "day=d9") == before
    assert {p: files_of(path, p) for p in kept} == kept


def test_query_parameters_are_bound(spark):
    rows = tables.literal_relation(spark, [("a'b", 1), ("c", 2)], ["k", "v"])
    out = tables.scan_query(spark, "SELECT v FROM bound_rows WHERE k = :k", {"k": "a'b"}, bound_rows=rows)
    assert values(out, "v") == [(1,)]


def test_names(spark):
    assert clean.clean_name(" 'Cost\n per  Pieces' ") == "cost per pieces"
    assert clean.numbered("F", 9, 11) == ["F09", "F10", "F11"]


def test_folders_of_a_table_are_listed_once_in_few_tasks(spark, tmp_path):
    # a copy listed each table twice, with a task for every partition.
    path, context = str(tmp_path / "t"), spark.sparkContext
    sinks.append(spark.range(70).selectExpr("id", "lpad(id, 5, '0') AS stcode").coalesce(1), path, ["stcode"])
    context.setJobGroup("listing", "folders")
    try:
        stored = tables.read_table(spark, path)
    finally:
        context.setJobGroup("other", "")
    status = context.statusTracker()
    tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("listing") for s in status.getJobInfo(j).stageIds]
    assert len([n for n in tasks if n > 1]) == 1 and max(tasks) <= 4 * context.defaultParallelism < 70
    assert stored.schema["stcode"].dataType.simpleString() == "string"
    assert values(stored, "stcode", "id") == [(f"{k:05d}", k) for k in range(70)]
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    typed = tables.read_table(spark, path, "id long, stcode int")
    assert typed.agg(F.sum("stcode")).first()[0] == sum(range(70))
