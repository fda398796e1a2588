"""Semantics in which Spark differs from the rules of the jobs, one test each."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcount.functions import dates, measures, text
from shelfcount.operators import clean, gates, joins, maintain, missrate, ranking, reshape, stock, variance
from shelfcount.plans import analysis, checklist, masters, staffing
from shelfcount.policy import SOH_POLICIES


def values(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("code", ["7", "", "-5", "+12", "12345678901234", "abc", "-"])
def test_zfill_is_not_lpad(spark, code):
    assert one(spark, text.zfill(F.lit(code), 5)) == code.zfill(5)


def test_lpad_cuts(spark):
    assert one(spark, text.lpad_code(F.lit("12345678901234"), 13)) == "1234567890123"


@pytest.mark.parametrize("value,expected", [("12", 12.0), (" 1.5 ", 1.5), ("1e3", 1000.0), ("x", None), ("", None), ("1,000", None), ("5d", None), (None, None)])
def test_number(spark, value, expected):
    assert one(spark, measures.number(F.lit(value).cast("string"))) == expected


def test_decimal_strips_commas(spark):
    assert one(spark, measures.decimal(F.lit("1,234.50"))) == Decimal("1234.50")
    assert one(spark, measures.decimal(F.lit(""))) is None


def test_rounding_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-0.5,)], "soh double")
    assert [r[0] for r in df.select(measures.mandays("soh", F.lit(1.0))).collect()] == [2.0, 4.0, 0.0]
    assert one(spark, measures.mandays(F.lit(10.0), F.lit(0.0))) == 0.0
    assert one(spark, measures.mandays(F.lit(10.0), F.lit(None).cast("double"))) == 0.0
    assert one(spark, measures.mandays(F.lit(None).cast("double"), F.lit(5.0))) is None


def test_exclusion_keeps_null(spark):
    df = spark.createDataFrame([("600",), (None,), ("300",)], "d string")
    assert values(clean.exclude_null_safe(df, "d", ["600"]), "d") == [("300",), (None,)]


def test_sum_by_drops_null_keys_and_reads_empty_as_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 5.0), ("b", 2.0)], "k string, v double")
    assert values(stock.sum_by(df, ["k"]), "k", "v") == [("a", 0.0), ("b", 2.0)]


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([("s", 0.0, 1.0, 2.0)], "k string, soh double, cost double, extcst_var double")
    assert variance.variance_kpi(df, ["k"]).first()["acc"] is None


def test_text_range_need_not_be_a_date(spark):
    df = spark.createDataFrame([("20250228",), ("20250301",)], "d string")
    assert values(clean.between_dates(df, "d", "20250101", "20250231"), "d") == [("20250228",)]
    assert one(spark, dates.parse_date(F.lit("20250231"))) is None


def test_weekday_dates(spark):
    assert one(spark, dates.weekday_date(F.lit("Monday 01/06/2026"))) == dt.date(2026, 6, 1)
    assert one(spark, dates.weekday_date(F.lit("Tuesday 01/06/2026"), month_first=True)) == dt.date(2026, 1, 6)
    assert one(spark, dates.weekday_date(F.lit("01/06/2026"))) is None


def test_gate_does_not_multiply(spark):
    rows = spark.createDataFrame([("1", "x")], "k string, v string")
    plan = spark.createDataFrame([("1",), ("1",)], "k string")
    assert gates.planned_only(rows, plan, ["k"]).count() == 1


def test_blocked_vendor_keeps_null_sub_dept(spark):
    rows = spark.createDataFrame([("v1", "1"), ("v2", None), ("v2", "300"), ("v3", "300")], "vendor string, sdpt string")
    block = spark.createDataFrame([("v1", "all"), ("v2", "300")], "veno string, sdpt string")
    kept = gates.exclude_blocked_vendor(rows, block)
    assert values(kept, "vendor", "sdpt") == [("v2", None), ("v3", "300")]


def test_unpivot_keeps_null(spark):
    df = spark.createDataFrame([(1, 5, None)], "id int, a int, b int")
    assert values(reshape.unpivot_answers(df, ["id"], ["a", "b"]), "question_code", "point") == [("a", 5), ("b", None)]


def test_unpivot_barcodes_rules(spark):
    df = spark.createDataFrame([("7", "0", " ", None, "99000000000001")], "sku string, a string, b string, c string, d string")
    out = reshape.unpivot_barcodes(df, "sku", ["a", "b", "c", "d"], [])
    assert values(out, "upc") == [("0000000000007",), ("99000000000001",)]


def test_files_of_bad_json(spark):
    df = spark.createDataFrame([(1, '[{"name":"a.XLSX"},{"id":1}]'), (2, "oops"), (3, "[]")], "id int, j string")
    assert values(reshape.explode_files(df, "j"), "id", "original_filename") == [(1, "a.XLSX"), (2, None), (3, None)]


def test_file_name_parts(spark):
    found = text.parse_filename(F.lit("/a/STK1_B2S_50001_20260101_0.xlsx"), ["r", "bu", "st", "day"])
    strict = text.parse_filename(F.lit("STK1_B2S_50001_20260101_0.xlsx"), ["r", "bu", "st", "day"], exact=True)
    assert [one(spark, c) for c in found.values()] == ["STK1", "B2S", "50001", "20260101"]
    assert [one(spark, c) for c in strict.values()] == [None] * 4


def test_link_file(spark):
    assert one(spark, text.query_param(F.lit("x?file=a%20b.xlsx&amp;z=1"), "file")) == "a b.xlsx"
    assert one(spark, text.query_param(F.lit("x?file=a.xls"), "file")) == "a.xls"
    assert one(spark, text.query_param(F.lit("x?q=1"), "file")) is None


def test_drop_uncounted(spark):
    df = spark.createDataFrame([(0, None), (5, None), (None, None), (0, 3)], "stock int, qnt int")
    assert values(clean.drop_uncounted(df), "stock", "qnt") == [(0, 3), (5, 0), (None, 0)]


def test_snapshot_keeps_null_sub_dept_and_blocks(spark):
    rows = [
        ("50001", "01", "260101", "10", "v1", None, "s1"),
        ("50001", "02", "260101", "5", "v1", "600", "s2"),
        ("50001", "02", "260101", "bad", "v1", "100", "s3"),
        ("50001", "03", "260101", "2.5", "v1", "100", "s4"),
        ("50001", "01", "260101", "99", "v9", "100", "s5"),
        ("50001", "01", "260101", "-4", "v1", "100", "s6"),
    ]
    raw = spark.createDataFrame(rows, "msstor string, mstype string, msasdt string, msstoh string, msvdno string, mssdpt string, mssku string")
    block = spark.createDataFrame([("v9", "all")], "veno string, sdpt string")
    from shelfcount.plans.soh import snapshot_job

    out = snapshot_job(raw, SOH_POLICIES["B2S"], block=block)
    snap = out["snapshot"].first()
    assert tuple(snap) == ("B2S50001", "B2S", "50001", "20260101", 10.0, 0.0, 2.5, 12.5)
    assert tuple(out["record"].first()) == ("B2S", "20260101", "50001", 112.5, 6)


def test_missrate_nulls_read_as_zero(spark):
    schema = "bu string, stcode string, cntdate string, sku string, rpname string, qty_count double"
    stk = spark.createDataFrame(
        [("B", "1", "d", "a", "STK1", 2.0), ("B", "1", "d", "a", "STK2", 10.0), ("B", "1", "d", "b", "STK1", 9.0), ("B", "1", "d", "b", "STK2", None)], schema
    )
    rec = spark.createDataFrame([("B", "1", "d", "a", 5.0)], "bu string, stcode string, cntdate string, sku string, qty_count double")
    out = missrate.missrate_reconciled(stk, stk.filter("sku = 'zz'"), rec, "B").first()
    assert (out["first"], out["missrate"]) == (11.0, 3.0 + 9.0)


def test_two_step_lookup_prefers_exact(spark):
    scans = spark.createDataFrame([(1, "0012"), (2, "12"), (3, "999")], "id int, barcode string")
    master = spark.createDataFrame([("012", "low"), ("12", "exact")], "barcode string, sku string")
    out = joins.lookup_two_step(scans, master)
    assert values(out, "id", "sku", "master_barcode") == [(1, "low", "012"), (2, "exact", "12"), (3, None, None)]


def test_business_days_match_numpy(spark):
    holidays = ["2026-01-01", "2026-01-03", "2026-04-06", "2026-05-01"]
    free = spark.createDataFrame([(h,) for h in holidays], "date string")
    days = [dt.date(2025, 12, 20) + dt.timedelta(days=7 * k % 190) for k in range(60)]
    pairs = [(a, b) for a in days[:12] for b in days]
    df = analysis.business_days(spark.createDataFrame(pairs, "a date, b date"), "a", "b", free)
    for a, b, n in df.collect():
        assert n == int(np.busday_count(a, b, holidays=holidays)), (a, b)


def test_business_days_of_any_date(spark):
    free = spark.createDataFrame([("2026-01-01",), ("2206-01-01",)], "date string")
    days = [dt.date(1900, 1, 3), dt.date(2026, 1, 5), dt.date(2206, 1, 6), dt.date(9999, 12, 30), dt.date(1, 1, 1)]
    pairs = [(a, b) for a in days for b in days] + [(None, days[0]), (days[0], None)]
    for a, b, n in analysis.business_days(spark.createDataFrame(pairs, "a date, b date"), "a", "b", free).collect():
        want = None if a is None or b is None else int(np.busday_count(a, b, holidays=["2026-01-01", "2206-01-01"]))
        assert n == want, (a, b)


def test_posting_age_without_post_date(spark):
    plan = spark.createDataFrame(
        [
            ("B", "1", "20260105", "3F", 1, None),
            ("B", "2", "20260601", "3F", 1, None),
            ("B", "3", "20260105", "3Q", 1, "20260107"),
            ("B", "3", "20260102", "4V", 1, None),
            ("B", "3", "20260104", "4V", 1, None),
        ],
        "bu string, stcode string, cntdate string, atype string, round int, post_date string",
    )
    out = analysis.posting_age(plan, spark.createDataFrame([("2026-01-02",)], "date string"), F.lit("2026-02-01").cast("date"))
    assert values(out, "stcode", "start_date", "age", "group") == [
        ("1", "20260105", None, "Pending"),
        ("2", "20260601", None, "Not Yet"),
        ("3", "20260102", 2, "G 2-3"),
    ]


def test_reload_decision_is_per_file(spark):
    schema = "bu string, k string, v string"
    target = spark.createDataFrame([("B", "1", "old"), ("B", "2", "old")], schema)
    incoming = spark.createDataFrame([("f1", "B", "1", "new"), ("f2", "B", "2", "new"), ("f2", "B", "3", "new")], "file string, " + schema)
    out = maintain.insert_new_or_reload(target, incoming, "file", ["bu", "k"], ["bu", "k"])
    assert values(out, "k", "v") == [("1", "new"), ("2", "old"), ("3", "new")]


def test_backfill_sets_both(spark):
    df = spark.createDataFrame([(None, "x", "9"), ("A", "x", "9")], "bu string, stcode string, store string")
    assert values(maintain.backfill_keys(df, "B"), "bu", "stcode") == [("A", "x"), ("B", "9")]


def test_checklist_newest_entry_and_unmapped_question(spark):
    answers = spark.createDataFrame(
        [(1, "d", "s", "20260101", 1, 2), (2, "d", "s", "20260101", 3, None), (3, "d", "s", "20260901", 5, 5)],
        "id int, checkdate string, stcode string, cntdate string, q1 int, q9 int",
    )
    mapping = spark.createDataFrame([("q1", "B", "F", 2)], "question_code string, bu string, zone string, weight int")
    plan = spark.createDataFrame([("B", "s", "20260101", "b"), ("B", "s", "20260901", "b")], "bu string, stcode string, cntdate string, branch string")
    out = checklist.score(answers, ["q1", "q9"], mapping, plan, plan.filter("false"), "20260801")
    assert values(out, "question_code", "point", "full", "act", "zone") == [("q1", 3, 10, 6, "Sale")]
    bare = plan.withColumn("branch", F.lit(None).cast("string"))
    assert checklist.score(answers, ["q1", "q9"], mapping, bare, plan.filter("false"), "20260801").count() == 0


def test_prepare_answers(spark):
    raw = spark.createDataFrame([("4", "2026-01-02 08:00:00", "s", "2026-01-01 00:00:00", "3", "x")], "id string, created string, stcode string, check_date string, q1 string, q2 string")
    assert values(checklist.prepare_answers(raw, ["q1", "q2"]), "*") == [(4, "20260102", "s", "20260101", 3, None)]


def test_bilingual_prefers_thai(spark):
    df = spark.createDataFrame([("b", "i", "zebra"), ("b", "i", "ม้า"), ("c", "i", None)], "Barcode string, Item string, ItemNameTH string")
    assert values(masters.bilingual_items(df), "Barcode", "ItemNameTH") == [("b", "ม้า"), ("c", None)]


def test_rates_first_match(spark):
    rows = spark.createDataFrame([("นนทบุรี",), ("เชียงใหม่",), ("สุราษฎร์ธานี",)], "province string")
    out = staffing.day_rates(rows, ["CFW", "CFR"])
    assert out.count() == 3 * 9 * 2 * 12 * 2
    found = out.filter("vendorname = 'AJIS' AND mindex = '2' AND province = 'สุราษฎร์ธานี'")
    assert values(found, "bu", "seasonindex", "darea", "price") == [
        ("CFR", "Moon", "BKK", 1000), ("CFR", "Night", "BKK", 1200), ("CFW", "Moon", "BKK", 1500), ("CFW", "Night", "BKK", 1500)
    ]
    pcs = out.filter("vendorname = 'PCS' AND mindex = '1' AND bu = 'CFR' AND seasonindex = 'Moon'")
    assert values(pcs, "province", "price") == sorted([("นนทบุรี", 1000), ("เชียงใหม่", 1500), ("สุราษฎร์ธานี", 1500)], key=str)


def test_expiry_fee(spark):
    rows = [("CFR", "TM", "PCS"), ("CFR", "FH", "SSD"), ("CFR", "TM", "Store"), ("B2S", "TM", "PCS"), ("CFR", None, "PCS")]
    df = spark.createDataFrame(rows, "bu string, st_type string, outsource_name string").withColumn("fee", staffing.expiry_fee())
    assert [r["fee"] for r in df.collect()] == [1000, 900, 0, 0, 0]


def test_latest_with_null_order_loses(spark):
    df = spark.createDataFrame([("a", None, "n"), ("a", 1, "x"), ("a", 3, "y")], "k string, id int, v string")
    assert values(ranking.latest_per_group(df, ["k"], ["id"]), "v") == [("y",)]
    assert values(ranking.distinct_on(df, ["k"], ["id"]), "v") == [("x",)]


def test_high_water_of_empty_target(spark):
    df = spark.createDataFrame([(0,), (5,)], "id int")
    assert stock.high_water(df, df.filter("false"), "id").count() == 2
    assert values(stock.high_water(df, df.filter("id = 0"), "id"), "id") == [(5,)]


def test_next_run(spark):
    ids = spark.createDataFrame([("AB001",), ("AB010",), ("CD999",)], "id string")
    wanted = spark.createDataFrame([("AB",), ("XX",)], "prefix string")
    assert values(stock.next_run_for(wanted, ids, "id", 2), "prefix", "next_run") == [("AB", "011"), ("XX", "001")]


def test_scan_lines_and_dated_master(spark):
    from shelfcount.operators import overlay

    raw = spark.createDataFrame([("IU1", "0000012345678"), ("XX1", "0000012345678")], "stocktakeid string, sku string")
    assert values(overlay.scan_lines(raw, "IU"), "stocktakeid", "sku") == [("IU1", "12345678")]
    master = spark.createDataFrame([("31/12/2025",), ("2025-12-31",)], "sdate string")
    assert values(overlay.dated_master(master), "cntdate") == [("20251231",), (None,)]


def test_mapping_sheet_names(spark):
    raw = spark.createDataFrame([("q1", "B", "F", "2", "1", "s", "d", "x")], ["Code", "BU", "Zone", "Weight", "No", "Subject", "Desceiption", "SubDescription"])
    out = checklist.rename_mapping(raw).first().asDict()
    assert (out["question_code"], out["section"], out["subject"], out["weight"]) == ("q1", "s", "d", 2.0)


def test_form_headers(spark):
    raw = spark.createDataFrame([("4", "2026-01-02 08:00:00", "s", "2026-01-01", "3")], ["Id", "Start time", "รหัสสาขา (Store Code)", "วันที่นับ\xa0Full stock count", "CMK01"])
    assert values(checklist.prepare_answers(raw, ["CMK01"]), "*") == [(4, "20260102", "s", "20260101", 3)]
    assert checklist.questions("cfr_cmk")[-1] == "CMK35"


def test_quote_modes(spark):
    assert one(spark, text.clean_cell(F.lit("'O'Neil\n'"), "edges")) == "O'Neil"
    assert one(spark, text.clean_cell(F.lit("'O'Neil\n'"))) == "ONeil"
    assert one(spark, text.clean_cell(F.lit("' '"))) is None
