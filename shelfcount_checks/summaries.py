"""Stock on hand, variance, miss rate, overlay and table maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.functions import text
from shelfcount.operators import clean, maintain, missrate, overlay, ranking, stock, variance
from shelfcount.plans import analysis, checklist, masters, soh, uploads
from shelfcount.policy import SOH_POLICIES, TYPES_NOT_REPORTED
from shelfcount.session import scratch_path
from shelfcount.sources import tables

from .inputs import Inputs, check, text_of


def doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@check("""SELECT stcode, mstype, CAST(sum(msstoh) AS DOUBLE) AS msstoh, sum(n)::BIGINT AS n FROM
    (SELECT CASE WHEN stcode = '7' THEN NULL ELSE stcode END AS stcode, mstype, msstoh, 1 AS n FROM v_soh)
    WHERE stcode IS NOT NULL GROUP BY 1, 2""")
def sum_by(i: Inputs):
    store = F.when(F.col("stcode") != "7", F.col("stcode"))
    df = i.soh.select(store.alias("stcode"), "mstype", "msstoh", "sku", F.lit(1).cast("bigint").alias("n"))
    return stock.sum_by(df, ["stcode", "mstype"])


def snapshot_sql(bu: str, rows: str, codes: tuple[str, str, str], total: str) -> str:
    credit, consign, perishable = (
        f"sum(CASE WHEN mstype = '{c}' THEN msstoh ELSE 0 END)" if c else "0" for c in codes
    )
    return f"""SELECT '{bu}' || stcode AS code, '{bu}' AS bu, stcode, as_date AS "DATE",
        CAST({credit} AS DOUBLE) AS food_credit, CAST({consign} AS DOUBLE) AS nonfood_consign,
        CAST({perishable} AS DOUBLE) AS perishable_nonmer, CAST({total} AS DOUBLE) AS totalsoh
        FROM (SELECT * REPLACE ('20' || substring(as_date, 3) AS as_date) FROM v_soh) s {rows} GROUP BY stcode, as_date"""


FULL_TOTAL = "sum(msstoh)"
PART_TOTAL = "sum(CASE WHEN mstype IN ('01', '03') THEN msstoh ELSE 0 END)"
BLOCKED = """AND vendor NOT IN (SELECT veno FROM v_block WHERE sdpt = 'all') AND NOT EXISTS
    (SELECT 1 FROM v_block b WHERE b.sdpt <> 'all' AND b.veno = s.vendor AND b.sdpt = s.sdpt)"""


def snapshot(i: Inputs, bu: str, **rename: str) -> dict[str, DataFrame]:
    df = i.soh_file.withColumnsRenamed(rename)
    return soh.snapshot_job(df, SOH_POLICIES[bu], block=i.block)


@check(snapshot_sql("B2S", f"WHERE msstoh > 0 AND sdpt NOT IN ('600', '700') {BLOCKED}", ("01", "02", "03"), FULL_TOTAL))
def snapshot_blocked_vendors(i: Inputs):
    return snapshot(i, "B2S")["snapshot"]


@check(snapshot_sql("OFM", "WHERE msstoh > 0", ("01", "02", "03"), PART_TOTAL))
def snapshot_credit_and_perishable(i: Inputs):
    return snapshot(i, "OFM")["snapshot"]


@check(snapshot_sql("SSP", "WHERE msstoh > 0", ("01", "", "03"), PART_TOTAL))
def snapshot_without_consign(i: Inputs):
    return snapshot(i, "SSP", msstor="store", mstype="sku_t", msasdt="as_of_date", msstoh="soh")["snapshot"]


@check(snapshot_sql("CFW", "", ("1", "2", "3"), FULL_TOTAL).replace("sum(CASE WHEN mstype = '1' THEN msstoh ELSE 0 END)", FULL_TOTAL))
def snapshot_without_type(i: Inputs):
    dated = i.soh_file.drop("mstype").withColumn("msasdt", text.century("msasdt"))
    return soh.snapshot_job(dated, SOH_POLICIES["CFW"])["snapshot"]


@check(snapshot_sql("PWB", "WHERE msstoh > 0", ("1", "2", "3"), FULL_TOTAL).replace("mstype = '", "mstype = '0"))
def snapshot_all_types(i: Inputs):
    short = i.soh_file.withColumns({"mstype": F.right("mstype", F.lit(1)), "msasdt": text.century("msasdt")})
    return soh.snapshot_job(short, SOH_POLICIES["PWB"])["snapshot"]


@check("""SELECT 'B2S' AS bu, '20' || substring(as_date, 3) AS as_date, stcode, CAST(sum(msstoh) AS DOUBLE) AS soh,
    count(sku) AS record FROM v_soh GROUP BY 2, 3""")
def intake_record(i: Inputs):
    return snapshot(i, "B2S")["record"]


@check("""SELECT 'SSP' || st AS code, 'SSP' AS bu, st AS stcode, as_date AS "DATE", CAST(sum(msstoh) AS DOUBLE) AS food_credit,
    0.0::DOUBLE AS nonfood_consign, 0.0::DOUBLE AS perishable_nonmer, CAST(sum(msstoh) AS DOUBLE) AS totalsoh FROM
    (SELECT *, CASE WHEN CAST(stcode AS BIGINT) % 6 <> 0 THEN 'W' || CAST(CAST(stcode AS BIGINT) % 6 AS VARCHAR) END AS st FROM v_soh)
    WHERE msstoh > 0 AND st IS NOT NULL GROUP BY st, as_date""")
def customer_snapshot(i: Inputs):
    raw = i.soh.select(
        F.col("stcode").alias("cuscode"), F.col("as_date").alias("data_date"), F.col("msstoh").cast("string").alias("soh")
    )
    number = F.col("s_suppkey") % 6
    store = F.concat(F.lit("W"), number.cast("string"))
    customers = i.table("supplier").filter(number != 0).select(text_of("s_suppkey").alias("cuscode"), store.alias("stcode"))
    return soh.customer_snapshot(raw, customers, SOH_POLICIES["SSP-WDS"])


SNAP = """(SELECT 'BU0' || stcode AS code, 'BU0' AS bu, stcode, as_date AS "DATE", CAST(sum(msstoh) AS DOUBLE) AS totalsoh
    FROM v_soh GROUP BY stcode, as_date)"""


def snap(i: Inputs) -> DataFrame:
    keys = [F.concat(F.lit("BU0"), "stcode").alias("code"), F.lit("BU0").alias("bu"), "stcode", F.col("as_date").alias("DATE")]
    return i.soh.groupBy(*keys).agg(F.sum("msstoh").cast("double").alias("totalsoh"))


@check(f"""SELECT code, bu, stcode, '20020101' AS "DATE", arg_max(totalsoh, "DATE") AS totalsoh FROM {SNAP} s
    WHERE "DATE" >= '19980701' AND stcode IN (SELECT stcode FROM v_plan WHERE bu = 'BU0' AND branch IS NOT NULL) GROUP BY 1, 2, 3
    UNION ALL SELECT code, bu, stcode, "DATE", totalsoh FROM {SNAP} WHERE "DATE" <> '20020101'""")
def year_start(i: Inputs):
    return soh.year_start(snap(i), i.plan, "19980701", "20020101")


@check("""SELECT stcode, as_date, CAST(msstoh AS DOUBLE) AS msstoh FROM v_soh a WHERE NOT EXISTS (SELECT 1 FROM v_planm p WHERE p.stcode = a.stcode
    AND p.cntdate = a.as_date)""")
def snapshot_diff(i: Inputs):
    out = stock.snapshot_diff(i.soh, i.planm, ["stcode", "as_date"], ["stcode", "cntdate"], ["msstoh"])
    return doubles(out, "msstoh")


@check("""SELECT bu || stcode AS code, bu, substring(bu || stcode, 4) AS stcode, '20260101' AS "DATE", 0 AS food_credit, 0 AS nonfood_consign,
    0 AS perishable_nonmer, 0 AS totalsoh FROM (SELECT DISTINCT bu, stcode FROM v_plan)""")
def first_week_seed(i: Inputs):
    codes = i.plan.select(F.concat("bu", "stcode").alias("code"), F.lit(1).alias("week_number")).distinct()
    return soh.first_week_seed(codes, "20260101")


@check("SELECT scan_id, sku FROM v_scan WHERE scan_id > (SELECT max(id) FROM v_edit WHERE id < 5000)")
def high_water(i: Inputs):
    stored = i.edit.filter("id < 5000").withColumnRenamed("id", "scan_id")
    return stock.high_water(i.scan, stored, "scan_id").select("scan_id", "sku")


@check("SELECT scan_id, sku FROM v_scan WHERE scan_id > (SELECT max(id) FROM v_edit WHERE id < 5000)")
def high_water_stored(i: Inputs):
    """The highest stored id comes from the footers of the stored table."""
    path = scratch_path(i.spark, "stored")
    i.edit.filter("id < 5000").select(F.col("id").alias("scan_id"), "qty").write.parquet(path)
    return stock.high_water(i.scan, tables.stored_max(i.spark, path, "scan_id"), "scan_id").select("scan_id", "sku")


@check("""SELECT p.prefix, coalesce(lpad(CAST(top + 1 AS VARCHAR), 3, '0'), '001') AS next_run FROM
    (SELECT DISTINCT left(atype || bu || lpad(stcode, 5, '0'), 10) AS prefix FROM v_plan) p LEFT JOIN
    (SELECT left(atype || bu || lpad(stcode, 5, '0'), 10) AS prefix, max(plan_id % 400) AS top FROM v_plan
    WHERE cntdate < '19980101' GROUP BY 1) r ON p.prefix = r.prefix""")
def next_run_number(i: Inputs):
    prefix = F.concat("atype", "bu", F.lpad("stcode", 5, "0"))
    run = F.lpad((F.col("plan_id") % 400).cast("string"), 3, "0")
    ids = i.plan.filter("cntdate < '19980101'").select(F.concat(prefix, run).alias("id"))
    return stock.next_run_for(i.plan.select(prefix.alias("prefix")).distinct(), ids, "id", 10)


KPI = """SELECT {keys}, CAST(sum(soh * cost) AS DOUBLE) AS vsoh,
    CAST(sum(CASE WHEN extcst_var > 0 THEN extcst_var ELSE 0 END) AS DOUBLE) AS vgain,
    CAST(sum(CASE WHEN extcst_var < 0 THEN extcst_var ELSE 0 END) AS DOUBLE) AS vloss, CAST(sum(extcst_var) AS DOUBLE) AS vnet,
    CAST(sum(abs(extcst_var)) AS DOUBLE) AS vabs,
    round(1 - CAST(sum(abs(extcst_var)) AS DOUBLE) / nullif(CAST(sum(soh * cost) AS DOUBLE), 0), 6) AS acc
    FROM {rows} GROUP BY ALL"""


@check(KPI.format(keys="stcode, cntdate, skutype", rows="v_valued WHERE rpname = 'STK2'"))
def variance_kpi(i: Inputs):
    final = i.valued.filter("rpname = 'STK2'")
    return rounded(variance.variance_kpi(final, ["stcode", "cntdate", "skutype"]), "acc")


KPI_ROWS = KPI.format(keys="stcode, cntdate, skutype", rows="v_valued WHERE rpname = 'STK2'")
SALE_ROWS = """SELECT mdstor AS stcode, cntdate, 'Credit' AS skutype, CAST(credit AS DOUBLE) AS amount FROM v_sale UNION ALL
    SELECT mdstor, cntdate, 'Consign', CAST(consignment AS DOUBLE) FROM v_sale"""


@check(f"""SELECT k.*, round(k.vnet / nullif(s.amount, 0), 6) AS vnet_to_sale, s.amount FROM ({KPI_ROWS}) k LEFT JOIN ({SALE_ROWS}) s
    USING (stcode, cntdate, skutype)""")
def variance_to_sales(i: Inputs):
    kpi = variance.variance_kpi(i.valued.filter("rpname = 'STK2'"), ["stcode", "cntdate", "skutype"])
    return rounded(variance.variance_to_sales(kpi, i.sale), "acc", "vnet_to_sale")


@check(KPI.format(keys="skutype, dpt, max(dept_name) AS dept_name",
    rows="""(SELECT v.*, left(sku, 2) AS dpt FROM v_valued v WHERE rpname = 'STK2') LEFT JOIN
    (SELECT left(sku, 2) AS dpt, max(des) AS dept_name FROM v_master WHERE CAST(sku AS BIGINT) % 7 > 0 GROUP BY 1) USING (dpt)"""))
def variance_by_dept(i: Inputs):
    named = i.master.filter(F.col("sku").cast("bigint") % 7 > 0)
    dept = named.groupBy(F.left("sku", F.lit(2)).alias("dpt")).agg(F.max("des").alias("dept_name"))
    final = i.valued.filter("rpname = 'STK2'").withColumn("dpt", F.left("sku", F.lit(2)))
    return rounded(variance.variance_by_dept(final, dept, ["skutype"], ["dpt"]), "acc")


@check(f"""SELECT k.*, 'BU1' AS bu, round(k.vnet / nullif(s.amount, 0), 6) AS vnet_to_sale, s.amount, p.atype, p.type1, p.branch, p.plan_id, p.running
    FROM ({KPI_ROWS}) k LEFT JOIN ({SALE_ROWS}) s USING (stcode, cntdate, skutype) LEFT JOIN
    (SELECT * EXCLUDE (bu), row_number() OVER (PARTITION BY bu, stcode ORDER BY cntdate DESC, plan_id DESC) AS running FROM
      (SELECT bu, stcode, left(cntdate, 6) || '01' AS cntdate, '3F' AS atype, min(type1) AS type1, min(branch) AS branch, min(plan_id) AS plan_id
       FROM v_plan WHERE bu = 'BU1' AND atype = '3F' GROUP BY 1, 2, 3)) p ON p.stcode = k.stcode AND p.cntdate = k.cntdate""")
def variance_analysis(i: Inputs):
    month = F.concat(F.left("cntdate", F.lit(6)), F.lit("01")).alias("cntdate")
    counted = i.plan.filter("bu = 'BU1' AND atype = '3F'")
    plan = counted.groupBy("bu", "stcode", month).agg(
        F.lit("3F").alias("atype"),
        F.min("type1").alias("type1"),
        F.min("branch").alias("branch"),
        F.min("plan_id").alias("plan_id"),
    )
    this_year = F.col("cntdate") >= "19980101"
    periods = [(i.valued.filter(this_year), i.sale.filter(this_year)), (i.valued.filter(~this_year), i.sale.filter(~this_year))]
    return rounded(analysis.variance_analysis(periods, plan, "BU1"), "acc", "vnet_to_sale")


def report_sql(keys: str, rows: str) -> str:
    def total(expr: str, name: str) -> str:
        return f"CAST(sum({expr}) AS DOUBLE) AS {name}"

    def part(c: str, sign: str) -> str:
        return f"CASE WHEN {c} {sign} 0 THEN {c} ELSE 0 END"

    measures = [
        "count(*) AS sku_count",
        "count(*) FILTER (variance = 0) AS sku_eq",
        "count(*) FILTER (variance > 0) AS sku_gain",
        "count(*) FILTER (variance < 0) AS sku_loss",
        total("stock", "qnt_soh"),
        total("qnt", "qnt_physical"),
        total(part("variance", ">"), "qnt_gain"),
        total(part("variance", "<"), "qnt_loss"),
        total("variance", "qnt_variance"),
        total("qnt_retail - var_retail", "retail_soh"),
        total("qnt_cost - var_cost", "cost_soh"),
        total("qnt_retail", "retail_physical"),
        total("qnt_cost", "cost_physical"),
        total(part("var_retail", ">"), "retail_gain"),
        total(part("var_cost", ">"), "cost_gain"),
        total(part("var_retail", "<"), "retail_loss"),
        total(part("var_cost", "<"), "cost_loss"),
        total("var_retail", "retail_net"),
        total("var_cost", "cost_net"),
    ]
    return f"SELECT {keys}, {', '.join(measures)} FROM {rows} GROUP BY ALL"


@check(report_sql("stcode, cntdate, rpname, skutype", "v_book"))
def store_report(i: Inputs):
    return variance.store_report(i.book)


@check(report_sql("stcode, cntdate, rpname, skutype, dept, sub_dept", "v_book WHERE rpname = 'STK2'"))
def dept_report(i: Inputs):
    return variance.dept_report(i.book)


@check(f"""SELECT 'store' AS level, * FROM ({report_sql("stcode, cntdate, rpname, skutype", "v_book")}) UNION ALL BY NAME
    SELECT 'dept' AS level, * FROM ({report_sql("stcode, cntdate, rpname, skutype, dept, sub_dept", "v_book WHERE rpname = 'STK2'")})""")
def reports_by_level(i: Inputs):
    # The lines are read twice, so parts would be sent to the driver twice.
    return variance.reports_by_level(i.shuffled.book)


OUTCOMES = """SELECT sku, any_value(prname) AS prname, count(*) FILTER (qty_var = 0) AS eq0, count(*) FILTER (qty_var > 0) AS gain,
    count(*) FILTER (qty_var < 0) AS loss, count(*) AS overall FROM (SELECT s.*, m.des AS prname FROM v_stk s JOIN v_master m USING (sku))
    WHERE rpname = 'STK2' AND cntdate BETWEEN '19960101' AND '20001231' {stores} GROUP BY sku"""


def ranked(i: Inputs, stores: list[str] | None) -> DataFrame:
    named = i.stk.join(i.master.select("sku", F.col("des").alias("prname")), "sku")
    named = named.withColumnsRenamed({"qty_var": "varianceqnt", "stcode": "stmerch"})
    return analysis.sku_ranking(named, "19960101", "20001231", stores)


@check(OUTCOMES.format(stores=""))
def sku_ranking(i: Inputs):
    return ranked(i, None)


@check(OUTCOMES.format(stores="AND stcode IN ('1', '2', '3', '5', '8')"))
def sku_ranking_of_stores(i: Inputs):
    return ranked(i, ["1", "2", "3", "5", "8"])


FIRST_FINAL = """SELECT {keys}, sum(CASE WHEN rpname = '{a}1' THEN qty_count ELSE 0 END) AS first,
    sum(CASE WHEN rpname = '{a}2' THEN qty_count ELSE 0 END) AS final FROM {rows} GROUP BY ALL"""


@check("SELECT stcode, sku, CAST(first AS DOUBLE) AS first, CAST(final AS DOUBLE) AS final FROM ("
       + FIRST_FINAL.format(keys="stcode, sku", a="VAR", rows="v_var") + ")")
def first_final(i: Inputs):
    return doubles(missrate.first_final(i.var, ["stcode", "sku"]), "first", "final")


@check("SELECT stcode, cntdate, CAST(sum(first) AS DOUBLE) AS first, CAST(sum(abs(first - final)) AS DOUBLE) AS missrate, "
       "'PST' AS vendor, 'OFM' AS bu FROM ("
       + FIRST_FINAL.format(keys="stcode, cntdate, batch, sku", a="VAR", rows="v_var WHERE left(batch, 1) = 'A'")
       + ") GROUP BY 1, 2")
def missrate_simple(i: Inputs):
    return missrate.missrate_simple(clean.not_prefixed(i.var, "batch", ["D", "R"]), "OFM", "batch")


COUNTED = "(SELECT 'BU' AS bu, stcode, cntdate, sku, replace(rpname, 'VAR', 'STK') AS rpname, qty_count FROM v_var)"


@check("SELECT stcode, cntdate, CAST(sum(first) AS DOUBLE) AS first, CAST(sum(CASE WHEN first < final THEN "
       "abs(first + coalesce(rec, 0) - final) ELSE abs(first - final) END) AS DOUBLE) AS missrate, 'PST' AS vendor, 'B2S' AS bu FROM ("
       + FIRST_FINAL.format(keys="bu, stcode, cntdate, sku", a="STK", rows=f"{COUNTED} WHERE CAST(sku AS BIGINT) % 50 <> 0")
       + ") LEFT JOIN (SELECT 'BU' AS bu, stcode, cntdate, sku, sum(soh) AS rec FROM v_stk WHERE rpname = 'STK1' GROUP BY ALL) "
       "USING (bu, stcode, cntdate, sku) GROUP BY 1, 2")
def missrate_reconciled(i: Inputs):
    counted = i.var.withColumns({"bu": F.lit("BU"), "rpname": F.replace("rpname", F.lit("VAR"), F.lit("STK"))})
    keys = ["bu", "stcode", "cntdate", "sku"]
    block = counted.filter(F.col("sku").cast("bigint") % 50 == 0).select(*keys)
    found = i.stk.filter("rpname = 'STK1'").withColumn("bu", F.lit("BU")).withColumnRenamed("soh", "qty_count")
    return missrate.missrate_reconciled(counted, block, found, "B2S")


@check("""SELECT * FROM (SELECT 'BU' AS bu, mdstor AS stcode, cntdate, 'PST' AS vendor, CAST(credit AS DOUBLE) AS first, CAST(credit * 2 AS DOUBLE) AS missrate FROM v_sale
    UNION ALL SELECT 'BU', mdstor, cntdate, 'X' || right(mdstor, 1), CAST(consignment - 100000 AS DOUBLE), CAST(consignment AS DOUBLE) FROM v_sale)
    WHERE first > 0 AND CAST(stcode AS BIGINT) % 4 <> 0""")
def missrate_vendor(i: Inputs):
    view = i.sale.select(
        F.lit("BU").alias("bu"),
        F.col("mdstor").alias("stcode"),
        "cntdate",
        F.col("credit").cast("double").alias("pst_scan"),
        (F.col("credit") * 2).cast("double").alias("pst_miss"),
        F.concat(F.lit("X"), F.right("mdstor", F.lit(1))).alias("outsource_name"),
        (F.col("consignment") - 100000).cast("double").alias("ost_scan"),
        F.col("consignment").cast("double").alias("ost_miss"),
    )
    stored = missrate.missrate_vendor(view).filter(F.col("stcode").cast("bigint") % 4 == 0)
    return analysis.missrate_job(view, stored)


SEQ = """SELECT stocktakeid, location, row_number() OVER (PARTITION BY stocktakeid, location ORDER BY ts, scan_id) AS seq,
    sku, qty AS qnt, scan_id FROM v_scan"""
EDITS = f"""SELECT scan_id AS id, stocktakeid, location, seq, '99' || sku AS barcode, qnt + 1 AS qnt FROM ({SEQ}) WHERE scan_id % 11 = 0
    UNION ALL SELECT scan_id + 1000000000, stocktakeid, location, seq, '99' || sku, qnt + 2 FROM ({SEQ}) WHERE scan_id % 22 = 0
    UNION ALL SELECT scan_id + 2000000000, stocktakeid, location, seq + 100000000, sku, qnt + 3 FROM ({SEQ}) WHERE scan_id % 13 = 0"""
LATEST = f"""SELECT stocktakeid, location, seq, sku, arg_max(qnt, id) AS qnt FROM (SELECT e.*, b.sku FROM ({EDITS}) e JOIN
    (SELECT stocktakeid, sku AS barcode, sku FROM v_package UNION ALL SELECT stocktakeid, barcode, sku FROM v_package) b
    USING (stocktakeid, barcode)) GROUP BY stocktakeid, location, seq, barcode, sku"""
LINES = f"""SELECT c.stocktakeid, c.location, c.seq, c.sku, coalesce(e.qnt, c.qnt) AS qnt, p.price, p.stcode, p.cntdate FROM ({SEQ}) c
    LEFT JOIN ({LATEST}) e USING (stocktakeid, location, seq, sku) LEFT JOIN v_package p ON p.stocktakeid = c.stocktakeid AND p.sku = c.sku
    UNION ALL SELECT e.stocktakeid, e.location, e.seq, e.sku, e.qnt, p.price, p.stcode, p.cntdate FROM ({LATEST}) e
    JOIN v_package p ON p.stocktakeid = e.stocktakeid AND p.sku = e.sku
    WHERE NOT EXISTS (SELECT 1 FROM ({SEQ}) c WHERE c.stocktakeid = e.stocktakeid AND c.location = e.location AND c.seq = e.seq AND c.sku = e.sku)"""


def overlay_inputs(i: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    numbered = ranking.sequence_in_group(i.scan, ["stocktakeid", "location"], ["ts", "scan_id"]).select(
        "stocktakeid", "location", "seq", "sku", F.col("qty").alias("qnt"), "scan_id"
    )
    path = scratch_path(i.spark, "scans")
    numbered.write.parquet(path)
    scans = i.spark.read.parquet(path)

    def edits(every: int, shift: int, seq: int, code: F, add: int) -> DataFrame:
        return scans.filter(F.col("scan_id") % every == 0).select(
            (F.col("scan_id") + shift).alias("id"),
            "stocktakeid",
            "location",
            (F.col("seq") + seq).alias("seq"),
            code.alias("barcode"),
            (F.col("qnt") + add).alias("qnt"),
        )

    barcode = F.concat(F.lit("99"), "sku")
    changed = edits(11, 0, 0, barcode, 1).unionByName(edits(22, 1000000000, 0, barcode, 2))
    changed = changed.unionByName(edits(13, 2000000000, 100000000, F.col("sku"), 3))
    return scans.drop("scan_id"), changed, i.package


@check(f"""SELECT stocktakeid, location, seq, sku, CAST(qnt AS DOUBLE) AS qnt, CAST(price AS DOUBLE) AS price, stcode, cntdate FROM ({LINES})""")
def overlay_edits(i: Inputs):
    return doubles(overlay.overlay_edits(*overlay_inputs(i)), "qnt", "price")


@check(f"""SELECT stocktakeid, stcode, cntdate, sku, CAST(sum(qnt) AS DOUBLE) AS qnt, CAST(sum(qnt * price) AS DOUBLE) AS amount
    FROM ({LINES}) GROUP BY 1, 2, 3, 4""")
def overlay_totals(i: Inputs):
    return overlay.overlay_totals(overlay.overlay_edits(*overlay_inputs(i)))


@check(f"""SELECT stocktakeid, stcode, cntdate, sku, '99' || sku AS barcode, CAST(sum(qnt) AS DOUBLE) AS qnt, CAST(sum(qnt * price) AS DOUBLE) AS qnt_retail,
    'Credit' AS skutype, 'STK2' AS rpname, 'All' AS dept, 'All' AS sub_dept FROM ({LINES}) WHERE stcode IN ('1', '2', '4') AND stocktakeid <> 'ST3'
    GROUP BY 1, 2, 3, 4""")
def overlay_count(i: Inputs):
    stores = i.package.filter(F.col("stcode").isin("1", "2", "4")).select("stcode", "cntdate")
    done = i.package.filter("stocktakeid = 'ST3'").select("stocktakeid")
    return analysis.overlay_count(*overlay_inputs(i), stores, done, details=["barcode"])


@check(f"""SELECT stocktakeid, location, seq, sku, CAST(qnt AS DOUBLE) AS qnt, CAST(price AS DOUBLE) AS retail, stcode, cntdate, '99' || sku AS barcode,
    'All' AS dept, 'All' AS sub_dept, 'VAR2' AS rpname, 'Credit' AS skutype FROM ({LINES}) WHERE stcode IN ('1', '2', '4') AND stocktakeid <> 'ST3'""")
def overlay_detail(i: Inputs):
    stores = i.package.filter(F.col("stcode").isin("1", "2", "4")).select("stcode", "cntdate")
    done = i.package.filter("stocktakeid = 'ST3'").select("stocktakeid")
    out = analysis.overlay_detail(*overlay_inputs(i), stores, done, details=["barcode"])
    return doubles(out, "qnt", "retail")


STORE_LINES = f"""SELECT stcode, cntdate, 'STK2' AS rpname, 'Credit' AS skutype, count(*) AS sku_count, CAST(sum(q) AS DOUBLE) AS qnt_physical,
    CAST(sum(a) AS DOUBLE) AS retail_physical FROM (SELECT stcode, cntdate, sum(qnt) AS q, sum(qnt * price) AS a FROM ({LINES})
    WHERE stcode IS NOT NULL GROUP BY stocktakeid, stcode, cntdate, sku) GROUP BY 1, 2"""


@check(f"""SELECT p.*, r.* EXCLUDE (stcode, cntdate) FROM (SELECT DISTINCT stcode, cntdate FROM (SELECT stcode, cntdate FROM v_planm UNION ALL
    SELECT CAST(n_nationkey AS VARCHAR), '20240101' FROM nation)) p LEFT JOIN ({report_sql("stcode, cntdate, rpname, skutype", "v_book")}
    UNION ALL BY NAME {STORE_LINES}) r USING (stcode, cntdate)""")
def count_report_by_store(i: Inputs):
    extra = i.table("nation").select(text_of("n_nationkey").alias("stcode"), F.lit("20240101").alias("cntdate"))
    plan = i.planm.unionByName(extra).distinct()
    return analysis.count_reports(i.book, overlay.overlay_edits(*overlay_inputs(i)), plan)["store"]


@check(f"""SELECT p.*, r.* EXCLUDE (stcode, cntdate) FROM v_planm p LEFT JOIN
    ({report_sql("stcode, cntdate, rpname, skutype, dept, sub_dept", "v_book WHERE rpname = 'STK2'")}
    UNION ALL BY NAME SELECT *, 'ALL' AS dept, 'ALL' AS sub_dept FROM ({STORE_LINES})) r USING (stcode, cntdate)""")
def count_report_by_dept(i: Inputs):
    return analysis.count_reports(i.book, overlay.overlay_edits(*overlay_inputs(i)), i.planm)["dept"]


@check(f"""SELECT p.*, r.* EXCLUDE (stcode, cntdate) FROM v_planm p LEFT JOIN
    (SELECT 'store' AS level, * FROM ({report_sql("stcode, cntdate, rpname, skutype", "v_book")} UNION ALL BY NAME {STORE_LINES})
    UNION ALL BY NAME SELECT 'dept' AS level, * FROM ({report_sql("stcode, cntdate, rpname, skutype, dept, sub_dept", "v_book WHERE rpname = 'STK2'")}
    UNION ALL BY NAME SELECT *, 'ALL' AS dept, 'ALL' AS sub_dept FROM ({STORE_LINES}))) r USING (stcode, cntdate)""")
def count_report_levels(i: Inputs):
    i = i.shuffled
    return analysis.count_report_levels(i.book, overlay.overlay_edits(*overlay_inputs(i)), i.planm)


@check(f"""SELECT bu, stcode, cntdate, plan_id, type1, branch, atype FROM v_plan p WHERE bu = 'BU2' AND atype = '3F' AND type1 NOT IN ('5-LOW', '3-MEDIUM')
    AND cntdate BETWEEN '19960101' AND '19991231' AND NOT EXISTS (SELECT 1 FROM v_answers a WHERE a.q01 < 3 AND a.stcode = p.stcode AND a.cntdate = p.cntdate)""")
def completeness(i: Inputs):
    result = i.answers.select("stcode", "cntdate", F.when(F.col("q01") < 3, "STK2").otherwise("STK1").alias("rpname"))
    # Two priorities stand for the store types of the policy.
    named = dict(zip(("5-LOW", "3-MEDIUM"), TYPES_NOT_REPORTED["J"]))
    plan = i.plan.withColumn("type1", text.replace_values("type1", named))
    out = analysis.completeness(plan, result, "BU2", TYPES_NOT_REPORTED["J"], "19960101", "19991231")
    return out.withColumn("type1", text.replace_values("type1", {v: k for k, v in named.items()}))


AGE = """SELECT plan_id, bu, stcode, cntdate, start_date, post_date, CASE WHEN n >= 0 THEN n END AS age,
    CASE WHEN n > -1 AND n <= 1 THEN 'G 0-1' WHEN n BETWEEN 2 AND 3 THEN 'G 2-3' WHEN n BETWEEN 4 AND 5 THEN 'G 4-5'
    WHEN n BETWEEN 6 AND 7 THEN 'G 6-7' WHEN n BETWEEN 8 AND 9 THEN 'G 8-9' WHEN n BETWEEN 10 AND 15 THEN 'G 10-15'
    WHEN n BETWEEN 16 AND 30 THEN 'G 16-30' WHEN n > 30 THEN 'G >30' WHEN start_date <= '20000101' THEN 'Pending' ELSE 'Not Yet' END AS "group" """
DAYS = """days AS (SELECT day, strftime(day, '%Y%m%d') AS k, CASE WHEN isodow(day) < 6 AND strftime(day, '%m%d') NOT IN ('0101', '0501', '1225') THEN 1 ELSE 0 END AS w
    FROM (SELECT unnest(generate_series(TIMESTAMP '1890-01-01', TIMESTAMP '2210-12-31', INTERVAL 1 DAY)) AS day)),
    cal AS (SELECT k, sum(w) OVER (ORDER BY day) - w AS bef, sum(w) OVER (ORDER BY day) AS thr FROM days)"""


@check(f"""WITH {DAYS}, started AS (SELECT c.plan_id, c.bu, c.stcode, c.cntdate, coalesce(v.first, c.cntdate) AS start_date, c.post_date FROM
    (SELECT *, (CAST(substring(cntdate, 5, 2) AS INTEGER) + 2) // 3 AS round, CASE WHEN plan_id % 37 = 0 THEN '22060105' WHEN plan_id % 37 = 1 THEN '19000103' WHEN plan_id % 5 > 0 THEN
     strftime(strptime(cntdate, '%Y%m%d') + to_days(CAST(plan_id % 37 - 4 AS INTEGER)), '%Y%m%d') END AS post_date FROM v_plan WHERE atype <> '4V') c LEFT JOIN
    (SELECT bu, stcode, left(cntdate, 4) AS year, (CAST(substring(cntdate, 5, 2) AS INTEGER) + 2) // 3 AS round, min(cntdate) AS first
     FROM v_plan WHERE atype = '4V' GROUP BY 1, 2, 3, 4) v ON c.bu = v.bu AND c.stcode = v.stcode AND left(c.cntdate, 4) = v.year AND c.round = v.round),
    aged AS (SELECT s.*, CAST(CASE WHEN start_date <= post_date THEN b.bef - a.bef ELSE b.thr - a.thr END AS BIGINT) AS n FROM started s
    LEFT JOIN cal a ON a.k = s.start_date LEFT JOIN cal b ON b.k = s.post_date) {AGE} FROM aged""")
def posting_age(i: Inputs):
    days = i.spark.range(1890, 2211).select(F.col("id").cast("string").alias("y"))
    holidays = days.select(F.explode(F.array(*[F.concat("y", F.lit(d)) for d in ("-01-01", "-05-01", "-12-25")])).alias("date"))
    posted = F.date_add(F.to_date("cntdate", "yyyyMMdd"), (F.col("plan_id") % 37 - 4).cast("int"))
    plan = i.plan.withColumns(
        {
            "round": F.floor((F.substring("cntdate", 5, 2).cast("int") + 2) / 3),
            "post_date": F.when(F.col("plan_id") % 37 == 0, "22060105").when(F.col("plan_id") % 37 == 1, "19000103")
            .when(F.col("plan_id") % 5 > 0, F.date_format(posted, "yyyyMMdd")),
        }
    )
    out = analysis.posting_age(plan, holidays, F.lit("2000-01-01").cast("date"))
    return out.select("plan_id", "bu", "stcode", "cntdate", "start_date", "post_date", F.col("age").cast("bigint").alias("age"), "group")


@check("""SELECT sku AS sku, dept, sdept AS location, nullif(concat_ws(',', nullif(sbc1, '0'), nullif(sbc2, '0')), '') AS barcode, ibc FROM v_master""")
def variance_listing(i: Inputs):
    empty = F.lit(None).cast("string")
    df = i.master.withColumnRenamed("sdept", "location").withColumns({"sbc3": empty, "sbc4": empty, "sbc5": empty})
    return analysis.variance_listing(df).select("sku", "dept", "location", "barcode", "ibc")


KEY4 = ["stcode", "cntdate", "skutype", "rpname"]
STKROW = "stcode, cntdate, skutype, rpname, sku, CAST(soh AS DOUBLE) AS soh"


def stk(i: Inputs) -> DataFrame:
    return doubles(i.stk.select(*KEY4, "sku", "soh"), "soh")


def old(i: Inputs) -> DataFrame:
    return stk(i).filter("cntdate < '19970101' OR stcode < '3'").withColumn("soh", -F.col("soh"))


OLD = "(SELECT stcode, cntdate, skutype, rpname, sku, -CAST(soh AS DOUBLE) AS soh FROM v_stk WHERE cntdate < '19970101' OR stcode < '3')"
NEW = f"(SELECT {STKROW} FROM v_stk WHERE cntdate BETWEEN '19960601' AND '19970701')"


def new(i: Inputs) -> DataFrame:
    return stk(i).filter("cntdate BETWEEN '19960601' AND '19970701'")


@check(f"""SELECT * FROM {OLD} o WHERE NOT EXISTS (SELECT 1 FROM {NEW} n WHERE n.stcode = o.stcode AND n.cntdate = o.cntdate)
    UNION ALL SELECT * FROM {NEW}""")
def replace_keys(i: Inputs):
    return maintain.replace_keys(old(i), new(i), ["stcode", "cntdate"])


@check(f"SELECT * FROM {OLD} o WHERE cntdate NOT BETWEEN '19960101' AND '19961231' UNION ALL SELECT * FROM {NEW}")
def replace_range(i: Inputs):
    return maintain.replace_range(old(i), new(i), "cntdate", "19960101", "19961231")


@check(f"""SELECT * FROM {OLD} o WHERE NOT (stcode IN ('1', '2', '11') AND rpname = 'STK2') UNION ALL
    SELECT * FROM {NEW} WHERE stcode IN ('1', '2', '11') AND rpname = 'STK2'""")
def replace_in_list(i: Inputs):
    return maintain.replace_in_list(old(i), new(i), "stcode", ["1", "2", "11"], rpname="STK2")


@check(f"""WITH inc AS (SELECT *, stcode || '_' || left(cntdate, 4) AS batch FROM {NEW}), seen AS (SELECT DISTINCT stcode, cntdate, skutype, rpname FROM {OLD}),
    unseen AS (SELECT i.* FROM inc i ANTI JOIN seen s USING (stcode, cntdate, skutype, rpname)),
    rel AS (SELECT i.* FROM inc i ANTI JOIN unseen u USING (batch))
    SELECT * FROM {OLD} o WHERE NOT EXISTS (SELECT 1 FROM rel r WHERE r.stcode = o.stcode AND r.rpname = o.rpname)
    UNION ALL SELECT * EXCLUDE (batch) FROM unseen UNION ALL SELECT * EXCLUDE (batch) FROM rel""")
def insert_new_or_reload(i: Inputs):
    incoming = new(i).withColumn("batch", F.concat("stcode", F.lit("_"), F.left("cntdate", F.lit(4))))
    return maintain.insert_new_or_reload(old(i), incoming, "batch", KEY4, ["stcode", "rpname"])


@check(f"""SELECT * FROM {OLD} UNION ALL SELECT {STKROW} FROM v_stk s WHERE cntdate BETWEEN '19960101' AND '19981231' AND NOT EXISTS
    (SELECT 1 FROM {OLD} o WHERE o.stcode = s.stcode AND o.cntdate = s.cntdate AND o.skutype = s.skutype AND o.rpname = s.rpname)""")
def archive_new(i: Inputs):
    return maintain.archive_new(stk(i), old(i), KEY4, "cntdate", "19960101", "19981231")


@check(f"""SELECT 'archive' AS part, stcode, count(*) AS n FROM (SELECT * FROM {OLD} UNION ALL SELECT {STKROW} FROM v_stk s WHERE cntdate BETWEEN '19960101' AND '19981231'
    AND NOT EXISTS (SELECT 1 FROM {OLD} o WHERE o.stcode = s.stcode AND o.cntdate = s.cntdate AND o.skutype = s.skutype AND o.rpname = s.rpname)) GROUP BY 2
    UNION ALL SELECT 'source', stcode, count(*) FROM v_stk WHERE cntdate NOT BETWEEN '19960101' AND '19981231' GROUP BY 2""")
def archive_move(i: Inputs):
    archive, rest = maintain.archive_move(stk(i), old(i), KEY4, "cntdate", "19960101", "19981231")
    both = archive.select(F.lit("archive").alias("part"), "stcode").unionByName(rest.select(F.lit("source").alias("part"), "stcode"))
    return both.groupBy("part", "stcode").agg(F.count(F.lit(1)).alias("n"))


@check(f"""SELECT cntnum, rpname, sku, prtype FROM (SELECT DISTINCT * FROM (SELECT lpad(stcode, 5, '0') || 'F' || right(cntdate, 2) || substring(cntdate, 5, 2)
    || substring(cntdate, 3, 2) || '001' AS cntnum, rpname, sku, skutype AS prtype, cntdate FROM v_var)) v WHERE cntdate BETWEEN '20000101' AND '20001231'
    AND NOT (prtype = 'Credit' AND left(cntnum, 5) < '00005')""")
def archive_detail(i: Inputs):
    day = F.concat(F.right("cntdate", F.lit(2)), F.substring("cntdate", 5, 2), F.substring("cntdate", 3, 2))
    cntnum = F.concat(F.lpad("stcode", 5, "0"), F.lit("F"), day, F.lit("001"))
    detail = i.var.select(cntnum.alias("cntnum"), "rpname", "sku", F.col("skutype").alias("prtype")).distinct()
    done = detail.filter("prtype = 'Credit' AND left(cntnum, 5) < '00005'")
    return masters.archive_family(detail, done, "U-var", "20000101", "20001231")


@check("""SELECT plan_id, CASE WHEN plan_id % 3 = 0 THEN 'B2S' ELSE bu END AS bu, CASE WHEN plan_id % 3 = 0 THEN 'S' || stcode ELSE stcode END AS stcode FROM v_plan""")
def backfill_keys(i: Inputs):
    bu = F.when(F.col("plan_id") % 3 != 0, F.col("bu"))
    df = i.plan.select("plan_id", bu.alias("bu"), "stcode", F.concat(F.lit("S"), "stcode").alias("store"))
    return maintain.backfill_keys(df, "B2S").select("plan_id", "bu", "stcode")


@check("""SELECT c_custkey AS id, c_nationkey AS nation, CASE WHEN n > 0 THEN 'n' || CAST(n AS VARCHAR) ELSE c_name END AS name FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON c_custkey = o_custkey""")
def upsert_header(i: Inputs):
    header = i.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"))
    counted = i.table("orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return maintain.upsert_header(header, counted.select("id", F.concat(F.lit("n"), text_of("n")).alias("name")))


@check("""SELECT stcode, cntdate FROM v_planm WHERE cntdate < '19990101' UNION SELECT mdstor, cntdate FROM v_sale""")
def insert_if_absent(i: Inputs):
    stored = i.planm.filter("cntdate < '19990101'")
    return maintain.insert_if_absent(stored, i.sale.select(F.col("mdstor").alias("stcode"), "cntdate"), ["stcode", "cntdate"])


STATES = """(SELECT plan_id, CASE WHEN plan_id % 2 = 0 THEN 'new' WHEN plan_id % 3 = 0 THEN 'reload' ELSE 'none' END AS state FROM v_plan WHERE bu <> 'BU2'
    UNION ALL SELECT plan_id, 'none' FROM v_plan p WHERE bu = 'BU2')"""


@check(f"SELECT * FROM {STATES}")
def registration_state(i: Inputs):
    incoming = i.plan.select(text_of("plan_id").alias("stocktakeid"), text_of("plan_id").alias("stcode"), "bu", "cntdate", "plan_id")
    known = incoming.filter("plan_id % 2 = 1")
    out = maintain.registration_state(incoming, incoming.filter("bu <> 'BU2'"), known, known.filter("plan_id % 3 = 0"))
    return out.select("plan_id", "state")


@check("""SELECT stocktakeid, count(*) AS items, max(price) AS price FROM (SELECT DISTINCT stocktakeid, barcode, sku, price FROM (
    SELECT stocktakeid, barcode, sku, CASE WHEN stocktakeid IN ('ST1', 'ST2') THEN -1 ELSE CAST(price AS DOUBLE) END AS price FROM v_package
    UNION ALL SELECT stocktakeid, sku, sku, CASE WHEN stocktakeid IN ('ST1', 'ST2') THEN -1 ELSE CAST(price AS DOUBLE) END FROM v_package))
    WHERE stocktakeid NOT IN ('ST4') GROUP BY 1""")
def load_master(i: Inputs):
    raw = i.package.select(
        "stocktakeid", "sku", "barcode", F.col("price").cast("double").alias("price"), "cntdate", F.lit("BU").alias("bu"),
        F.col("stocktakeid").alias("stcode"),
    )
    fresh = masters.scan_master(raw)
    stored = fresh.withColumn("price", F.lit(-1.0)).filter(F.col("stocktakeid").isin("ST1", "ST2", "ST3"))
    plan = raw.filter(~F.col("stocktakeid").isin("ST1", "ST4")).select("bu", "stcode", "cntdate", F.lit("b").alias("branch"))
    known = raw.filter(F.col("stocktakeid").isin("ST1", "ST3")).select("stocktakeid", "bu", "stcode", "cntdate").distinct()
    known = known.withColumns({"branch": F.lit("b"), "status": F.lit("C1")})
    out = masters.load_master(fresh, plan, known, stored)["master"]
    return out.groupBy("stocktakeid").agg(F.count(F.lit(1)).alias("items"), F.max("price").alias("price"))


@check("""SELECT lpad(sku, 13, '0') AS sku, lpad(sku, 13, '0') AS "barcodeIBC", lpad(nullif(ibc, '0'), 13, '0') AS barcode1,
    lpad(nullif(sbc1, '0'), 13, '0') AS barcode2, lpad(nullif(sbc2, '0'), 13, '0') AS barcode3, replace(des, ',', '') AS "productName", 'T1' AS "stocktakeId"
    FROM v_master WHERE CAST(sku AS BIGINT) % 4 <> 3""")
def package_items(i: Inputs):
    return masters.package_items(item_master(i), stocktakeId="T1").select(
        "sku", "barcodeIBC", "barcode1", "barcode2", "barcode3", "productName", "stocktakeId"
    )


def item_master(i: Inputs) -> DataFrame:
    none = F.lit(None).cast("string")
    return i.master.select(
        F.col("sku").alias("sku_no"), "ibc", F.col("sbc1").alias("sbc#1"), F.col("sbc2").alias("sbc#2"), none.alias("sbc#3"), none.alias("sbc#4"),
        none.alias("sbc#5"), F.concat("des", F.lit(",")).alias("sku_descr"), F.col("price").cast("double").alias("org_price"), "dept",
        F.format_string("0%d", F.col("sku").cast("bigint") % 4).alias("sku_type"), F.col("dept").alias("vendor"), F.col("sdept").alias("v_name"),
        none.alias("color_des"), none.alias("inner_pack"), none.alias("size_des"), F.col("price").alias("reg_retail"),
    )


def _pad(c: str) -> str:
    return f"CASE WHEN length({c}) >= 13 THEN {c} ELSE lpad({c}, 13, '0') END"


BAR = f"(SELECT sku, {_pad('sku')} AS upc, des, price FROM v_master " + " ".join(
    f"UNION ALL SELECT sku, {_pad(c)}, des, price FROM v_master WHERE {c} IS NOT NULL AND trim({c}) <> '' AND {c} <> '0'" for c in ("ibc", "sbc1", "sbc2")
) + ")"


@check(f"""SELECT upc AS ibc, des || ',' AS "productName", 0 AS stock, CAST(price AS DOUBLE) AS "retailPrice", 'A' AS status FROM {BAR} UNION ALL
    SELECT DISTINCT lpad(sku, 13, '0'), des || ',', 0, CAST(price AS DOUBLE), 'A' FROM {BAR}""")
def package_barcodes(i: Inputs):
    return masters.package_barcodes(masters.barcode_master(item_master(i)))


@check("""SELECT s_name AS username, 'a' AS "firstName", split_part(s_name, '#', 2) AS "lastName", CAST(s_nationkey AS VARCHAR) AS hub, 'Counter' AS position
    FROM supplier WHERE s_suppkey % 3 <> 0 UNION SELECT 'admin', 'x', 'y', CAST(n_regionkey AS VARCHAR), 'Admin' FROM nation""")
def package_users(i: Inputs):
    left = F.when(F.col("s_suppkey") % 3 == 0, F.lit("2020-01-01").cast("date"))
    employees = i.table("supplier").select(
        F.col("s_name").alias("employee_code"), F.concat(F.lit("a "), F.split_part("s_name", F.lit("#"), F.lit(2))).alias("eng_name"),
        text_of("s_nationkey").alias("sub_hub"), F.lit("Counter").alias("position"), left.alias("last_work_date"),
    )
    fixed = i.table("nation").select(
        F.lit("admin").alias("username"), F.lit("x").alias("firstName"), F.lit("y").alias("lastName"), text_of("n_regionkey").alias("hub"), F.lit("Admin").alias("position")
    )
    return masters.package_users(employees, fixed, "2024-01-01")


@check("SELECT DISTINCT location, stocktakeid AS \"stocktakeId\" FROM v_scan")
def package_locations(i: Inputs):
    return masters.package_locations(i.scan.withColumnRenamed("stocktakeid", "cntnum"))


SCORED = """SELECT checkdate, stcode, cntdate, question_code, point, bu, zone, weight, 5 * weight AS "full", point * weight AS act FROM
    (SELECT a.checkdate, a.stcode, a.cntdate, u.q AS question_code, CASE u.q WHEN 'q01' THEN q01 WHEN 'q02' THEN q02 ELSE q03 END AS point,
    m.bu, m.zone, m.weight FROM (SELECT *, cntdate AS checkdate FROM v_answers QUALIFY row_number() OVER (PARTITION BY stcode, cntdate ORDER BY id DESC) = 1) a,
    (VALUES ('q01'), ('q02'), ('q03')) u(q) LEFT JOIN (VALUES ('q01', 'BU0', 'Back', 1), ('q02', 'BU0', 'Sale', 2), ('q02', 'BU1', 'Sale', 3)) m(q, bu, zone, weight) ON m.q = u.q
    WHERE a.cntdate <= '20000630') s WHERE EXISTS (SELECT 1 FROM v_plan p WHERE p.branch IS NOT NULL AND p.bu = s.bu AND p.stcode = s.stcode AND p.cntdate = s.cntdate)
    AND NOT EXISTS (SELECT 1 FROM v_plan p WHERE p.atype = '4V' AND p.bu = s.bu AND p.stcode = s.stcode AND p.cntdate = s.cntdate)"""


def scored(i: Inputs) -> DataFrame:
    rows = [("q01", "BU0", "B", 1), ("q02", "BU0", "F", 2), ("q02", "BU1", "F", 3)]
    mapping = i.spark.createDataFrame(rows, "question_code string, bu string, zone string, weight bigint")
    answers = i.answers.withColumn("checkdate", F.col("cntdate"))
    questions = ["q01", "q02", "q03"]
    return checklist.score(answers, questions, mapping, i.plan, i.plan.filter("atype = '4V'"), "20000630")


@check(SCORED)
def checklist_score(i: Inputs):
    return scored(i)


FORM = "b2s"
CODES = checklist.questions(FORM)
FORM_POINTS = ", ".join(f"('{c}', {k})" for k, c in enumerate(CODES))


def form_sheet(i: Inputs) -> DataFrame:
    """Entries of a checklist form as its sheet writes them: all text, headers in their own language."""
    points = [((F.col("o_orderkey") + k) % 6).cast("string").alias(c.lower()) for k, c in enumerate(CODES)]
    moment = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    return i.table("orders").select(
        F.col("o_orderkey").cast("string").alias("ID"), moment.alias("Start time"), F.col("o_custkey").cast("string").alias("รหัสสาขา"),
        moment.alias("วันที่ตรวจนับ"), *points,
    )


@check(f"""WITH newest AS (SELECT * FROM v_answers QUALIFY row_number() OVER (PARTITION BY stcode, cntdate ORDER BY id DESC) = 1)
    SELECT a.stcode, a.cntdate, c.code AS question_code, (a.id + c.k) % 6 AS point, 'Sale' AS zone, CAST(10 AS DOUBLE) AS "full", CAST((a.id + c.k) % 6 * 2 AS DOUBLE) AS act
    FROM newest a, (VALUES {FORM_POINTS}) c(code, k) WHERE c.k % 2 = 0 AND a.cntdate <= '19960630' AND EXISTS (SELECT 1 FROM v_plan p
    WHERE p.bu = 'BU1' AND p.branch IS NOT NULL AND p.stcode = a.stcode AND p.cntdate = a.cntdate)""")
def checklist_form(i: Inputs):
    # Every second question of the form is mapped; the others have no unit and fall out.
    rows = [(c.lower(), "BU1", "F", "2", "x", "section", "subject", "more") for c in CODES[::2]]
    names = ["Code", "BU", "Zone", "Weight", "No", "Subject", "Desceiption", "SubDescription"]
    mapping = checklist.rename_mapping(i.spark.createDataFrame(rows, names)).withColumn("question_code", F.upper("question_code"))
    answers = checklist.prepare_answers(form_sheet(i), CODES)
    stored = i.plan.filter("false")
    out = checklist.score(answers, CODES, mapping, i.plan, stored, "19960630")
    return out.select("stcode", "cntdate", "question_code", "point", "zone", "full", "act")


@check(f"""SELECT s.*, p.type1 FROM ({SCORED}) s JOIN v_plan p USING (bu, stcode, cntdate) WHERE p.atype IN ('3F', '3Q') AND checkdate >= '19980101'""")
def checklist_extract(i: Inputs):
    return checklist.extract(scored(i), i.plan, "19980101")["checklist"]


@check("""SELECT * EXCLUDE (rn), 'STK1_' || bu || '_' || stcode || '_20240105' || CASE WHEN rn > 0 THEN '_' || CAST(rn AS VARCHAR) ELSE '' END || '.xlsx' AS unique_filename,
    bu || '/STK1_' || bu || '_' || stcode || '_20240105_' || CAST(rn AS VARCHAR) || '.xlsx' AS target FROM (SELECT id, bu, stcode, 'f' || CAST(id % 20 AS VARCHAR) || '.XLSX' AS original_filename, row_number() OVER (PARTITION BY bu, stcode ORDER BY id) - 1 AS rn
    FROM v_inbox WHERE id % 13 <> 0 AND start_ts + INTERVAL 7 HOUR >= TIMESTAMP '2024-01-05')""")
def upload_inbox(i: Inputs):
    forms = i.inbox.select("id", "bu", "stcode", F.lit("2024-01-05").alias("cntdate"), F.col("start_ts").cast("string").alias("start"), "stk1")
    out = uploads.upload_inbox(forms, "STK1", F.lit("2024-01-05").cast("timestamp"))
    return out.select("id", "bu", "stcode", "original_filename", "unique_filename", "target")


APPROVED = """SELECT id, 'Rep ' || CAST(id AS VARCHAR) || '.xlsx' AS file, '.xlsx' AS file_type, 'Missrate_' || bu || '_' || stcode || '_20240105.xlsx' AS target FROM v_inbox"""


def approved(i: Inputs) -> DataFrame:
    link = F.concat(F.lit("https://x/d?file=Rep%20"), text_of("id"), F.lit(".xlsx&amp;v=1"))
    return i.inbox.select(
        "id", "bu", "stcode", F.lit("2024-01-05").alias("cntdate"), F.col("start_ts").cast("string").alias("modified"), link.alias("file")
    )


@check(APPROVED + " WHERE start_ts >= TIMESTAMP '2024-01-09 12:00:00'")
def approved_recent(i: Inputs):
    now = F.lit("2024-01-10 12:00:00").cast("timestamp")
    return uploads.approved_recent(approved(i), 24, now).select("id", "file", "file_type", "target")


@check(APPROVED + " WHERE stcode IN ('3', '5')")
def approved_for_pairs(i: Inputs):
    pairs = i.spark.createDataFrame([("3", "2024-01-05"), ("5", "2024-01-05"), ("6", "2024-02-05")], "stcode string, cntdate string")
    return uploads.approved_for(approved(i), pairs).select("id", "file", "file_type", "target")


@check("""SELECT s.stcode, s.skcode, CAST(CASE WHEN s.n = 0 THEN NULL ELSE s.n * 1000 END AS DOUBLE) AS total, v.location, CAST(v.q AS DOUBLE) AS cntqnt FROM
    (SELECT stcode, sku AS skcode, count(*) - 1 AS n FROM v_stk GROUP BY 1, 2) s LEFT JOIN (SELECT stcode, sku, batch AS location, qty_count AS q FROM v_var
    WHERE rpname = 'VAR2' AND batch LIKE 'A%' AND qty_count > 0) v ON s.stcode = v.stcode AND s.skcode = v.sku""")
def hold_list(i: Inputs):
    counted = i.var.select("rpname", "stcode", F.col("sku").alias("skcode"), F.when(F.col("batch").startswith("A"), F.col("batch")).otherwise("").alias("location"),
                           F.col("qty_count").alias("cntqnt"))
    n = i.stk.groupBy(F.col("stcode").alias("store"), F.col("sku").alias("code")).agg((F.count(F.lit(1)) - 1).alias("n"))
    shown = F.when(F.col("n") == 0, "").otherwise(F.format_number(F.col("n") * 1000, 0))
    out = uploads.hold_list(n.select("store", "code", shown.alias("total")), counted, "store", "code", ["total"])
    out = out.withColumnsRenamed({"store": "stcode", "code": "skcode"})
    return doubles(out, "total", "cntqnt").select("stcode", "skcode", "total", "location", "cntqnt")
