"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcount.functions import dates, measures, text
from shelfcount.operators import clean, variance

from .inputs import Inputs, check, text_of


@check("SELECT stcode AS store, sku AS skcode, CAST(soh AS DOUBLE) AS book FROM v_stk")
def rename_map(i: Inputs):
    df = i.stk.select("stcode", "sku", F.col("soh").cast("double").alias("soh"))
    return clean.rename_map(df, {"stcode": "store", "sku": "skcode", "soh": "book", "absent": "x"})


@check("SELECT o_orderkey AS \"order key\", o_orderstatus AS status FROM orders")
def normalise_names(i: Inputs):
    df = i.table("orders").select(F.col("o_orderkey").alias(" 'Order\n Key' "), F.col("o_orderstatus").alias("STATUS"))
    return clean.normalise_names(df)


@check("SELECT stcode, sku, 'B2' AS unit, 7 AS week FROM v_stk")
def keep_and_constants(i: Inputs):
    kept = clean.keep(clean.drop_cols(i.stk, ["cost", "nothing"]), ["stcode", "sku", "no_such_column"])
    return clean.with_constants(kept, unit="B2", week=7)


@check("SELECT DISTINCT stcode, cntdate, '1' AS mstype, skutype FROM v_stk")
def default_column(i: Inputs):
    df = clean.default_column(i.stk.select("stcode", "cntdate", "skutype"), "mstype", "1")
    return clean.default_column(df, "skutype", "ignored").distinct()


@check("""SELECT event_id, CASE WHEN event_type = 'click' THEN 0 ELSE round_even(value, 1) END AS amount,
    CASE WHEN event_type = 'click' THEN NULL ELSE value END AS raw FROM events""")
def to_number(i: Inputs):
    shown = F.when(F.col("event_type") == "click", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    df = i.table("events").select("event_id", shown.alias("amount"), shown.alias("raw"))
    return clean.to_number(clean.to_number(df, ["amount"], fill=0, scale=1), ["raw"])


@check("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_quantity = 1 THEN NULL ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount
    FROM lineitem""")
def to_decimal(i: Inputs):
    shown = F.when(F.col("l_quantity") == 1, F.lit("")).otherwise(F.format_number("l_extendedprice", 2))
    df = i.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shown.alias("amount"))
    return clean.to_decimal(df, ["amount"]).withColumn("amount", F.col("amount").cast("double"))


@check("""SELECT id, TRY_CAST(CASE WHEN q01 = 5 THEN 'x' ELSE CAST(q01 AS VARCHAR) END AS BIGINT) AS "CODE01",
    q02 AS "CODE02", CAST(strptime(cntdate, '%Y%m%d') AS DATE) AS day FROM v_answers""")
def cast_map(i: Inputs):
    shown = F.when(F.col("q01") == 5, "x").otherwise(text_of("q01"))
    day = F.concat_ws("-", F.left("cntdate", F.lit(4)), F.substring("cntdate", 5, 2), F.right("cntdate", F.lit(2)))
    df = i.answers.select("id", shown.alias("CODE01"), text_of("q02").alias("CODE02"), day.alias("day"))
    return clean.cast_map(df, {**dict.fromkeys(clean.numbered("CODE", 1, 2), "bigint"), "day": "date"})


@check("""SELECT conv_id, turn, nullif(trim(replace(replace(replace(
    CASE WHEN turn = 3 THEN '''' ELSE text END, chr(10), ' '), chr(13), ' '), '''', '')), '') AS text
    FROM conversations""")
def clean_cells(i: Inputs):
    shown = F.when(F.col("turn") == 3, "'").otherwise(F.col("text"))
    return clean.clean_cells(i.table("conversations").select("conv_id", "turn", shown.alias("text")))


@check("SELECT id, coalesce(q03, 0) AS q03 FROM v_answers")
def fill_defaults(i: Inputs):
    return clean.fill_defaults(i.answers.select("id", "q03"), ["q03", "q99"], 0)


@check("SELECT sku, sbc2 FROM v_master WHERE sbc1 IS NOT NULL AND trim(sbc2) <> ''")
def require_keys(i: Inputs):
    return clean.require(i.master, ["sbc1", "sbc2"]).select("sku", "sbc2")


@check("SELECT stcode, as_date, sku, CAST(msstoh AS DOUBLE) AS msstoh FROM v_soh WHERE msstoh > 0")
def positive_only(i: Inputs):
    df = clean.positive(i.soh, "msstoh")
    return df.select("stcode", "as_date", "sku", F.col("msstoh").cast("double").alias("msstoh"))


@check("SELECT id, q03 FROM v_answers WHERE q03 IS NULL OR q03 NOT IN (1, 2)")
def exclude_null_safe(i: Inputs):
    return clean.exclude_null_safe(i.answers, "q03", [1, 2]).select("id", "q03")


@check("SELECT bu, stcode, cntdate, plan_id FROM v_plan WHERE cntdate BETWEEN '19970231' AND '19991399'")
def between_dates(i: Inputs):
    return clean.between_dates(i.plan, "cntdate", "19970231", "19991399").select("bu", "stcode", "cntdate", "plan_id")


@check("""SELECT batch, rpname, count(*) AS lines FROM v_var WHERE batch NOT LIKE 'D%' AND batch NOT LIKE 'R%'
    GROUP BY 1, 2""")
def not_prefixed(i: Inputs):
    df = clean.not_prefixed(i.var, "batch", ["D", "R"])
    return df.groupBy("batch", "rpname").agg(F.count(F.lit(1)).alias("lines"))


@check("SELECT id, q03, 'in' AS side FROM v_answers WHERE q03 IN (1, 2) UNION ALL "
       "SELECT id, q03, 'out' FROM v_answers WHERE q03 IS NULL OR q03 NOT IN (1, 2)")
def in_and_not_in_list(i: Inputs):
    df = i.answers.select("id", "q03")
    inside = clean.in_list(df, "q03", [1, 2]).withColumn("side", F.lit("in"))
    return inside.unionByName(clean.not_in_list(df, "q03", [1, 2]).withColumn("side", F.lit("out")))


@check("SELECT sku, sdept FROM v_master WHERE sbc1 LIKE '%1%'")
def contains_flag(i: Inputs):
    return clean.contains_flag(i.master, "sbc1", "1").select("sku", "sdept")


@check("""SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 36 HOUR""")
def recent_rows(i: Inputs):
    now = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return clean.recent(i.table("events").select("event_id", "ts"), "ts", 36, now).select("event_id")


@check("""SELECT id, book, coalesce(counted, 0) AS counted FROM (SELECT id, q01 AS book, q03 AS counted FROM v_answers)
    WHERE NOT (book = 0 AND counted IS NULL)""")
def drop_uncounted(i: Inputs):
    df = i.answers.select("id", F.col("q01").alias("book"), F.col("q03").alias("counted"))
    return clean.drop_uncounted(df, "book", "counted")


@check("""SELECT plan_id FROM (SELECT plan_id, CASE WHEN plan_id % 4 = 0 THEN NULL ELSE cntdate END AS ended FROM v_plan)
    WHERE ended IS NULL OR ended > '19990101'""")
def active_as_of(i: Inputs):
    ended = F.when(F.col("plan_id") % 4 != 0, F.col("cntdate"))
    df = i.plan.select("plan_id", ended.alias("ended"))
    return clean.active_as_of(df, "ended", F.lit("19990101")).select("plan_id")


@check("SELECT plan_id, row_number() OVER (ORDER BY cntdate, plan_id) - 1 AS index FROM v_plan")
def row_index(i: Inputs):
    return clean.row_index(i.plan.select("plan_id", "cntdate"), ["cntdate", "plan_id"]).select("plan_id", "index")


@check("""SELECT sku, CASE WHEN length(sbc2) >= 13 THEN sbc2 ELSE lpad(sbc2, 13, '0') END AS filled,
    lpad(sbc2, 13, '0') AS padded, ltrim(lpad(sku, 9, '0'), '0') AS stripped,
    substring(sbc2, 6, 8) AS middle, left(sbc2, 3) AS head, right(sbc2, 3) AS tail FROM v_master""")
def padding(i: Inputs):
    return i.master.select(
        "sku",
        text.zfill("sbc2", 13).alias("filled"),
        text.lpad_code("sbc2", 13).alias("padded"),
        text.strip_zeros(F.lpad("sku", 9, "0")).alias("stripped"),
        text.slice_text("sbc2", 6, 8).alias("middle"),
        F.left("sbc2", F.lit(3)).alias("head"),
        F.right("sbc2", F.lit(3)).alias("tail"),
    )


@check("""SELECT p_partkey, split_part(p_name, ' ', 1) AS first, split_part(p_name, ' ', 2) AS last,
    replace(replace(replace(p_type || ',' || p_brand || chr(10), chr(10), ''), chr(13), ''), ',', '') AS scrubbed,
    regexp_matches(p_name, '[k-z]') AS late_letter FROM part""")
def name_parts(i: Inputs):
    joined = F.concat("p_type", F.lit(","), "p_brand", F.lit("\n"))
    return i.table("part").select(
        "p_partkey",
        text.name_part("p_name", " ", 1).alias("first"),
        text.name_part("p_name", " ", 2).alias("last"),
        text.scrub(joined).alias("scrubbed"),
        text.has_script("p_name", "[k-z]").alias("late_letter"),
    )


@check("""SELECT doc_id, regexp_matches(text, '[À-ÿ]') AS accented FROM documents""")
def script_test(i: Inputs):
    return i.table("documents").select("doc_id", text.has_script("text", "[À-ÿ]").alias("accented"))


@check("""SELECT page_id, CASE WHEN contains(link, 'file=')
    THEN replace(split_part(split_part(link, 'file=', 2), '&amp', 1), '%20', ' ') END AS file,
    CASE WHEN contains(link, 'file=') THEN '.xlsx' END AS kind
    FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE
    url || '&file=Rep%20' || CAST(page_id AS VARCHAR) || '.XLSX' ||
    CASE WHEN page_id % 2 = 0 THEN '&amp;x=1' ELSE '' END END AS link FROM pages)""")
def link_file(i: Inputs):
    page = F.col("page_id")
    tail = F.when(page % 2 == 0, "&amp;x=1").otherwise("")
    link = F.when(page % 3 == 0, F.col("url")).otherwise(
        F.concat("url", F.lit("&file=Rep%20"), page.cast("string"), F.lit(".XLSX"), tail)
    )
    df = i.table("pages").select("page_id", text.query_param(link, "file").alias("file"))
    return df.withColumn("kind", text.extension("file"))


@check("""SELECT plan_id, atype AS rpname, bu, stcode, cntdate,
    atype || '_' || bu || '_' || stcode || '_' || cntdate ||
    CASE WHEN plan_id % 3 > 0 THEN '_' || CAST(plan_id % 3 AS VARCHAR) ELSE '' END || '.xlsx' AS name,
    CASE WHEN plan_id % 3 > 0 THEN NULL ELSE stcode END AS strict_store FROM v_plan""")
def file_names(i: Inputs):
    parts = ["atype", "bu", "stcode", "cntdate"]
    named = i.plan.withColumn("name", text.build_name(parts, F.col("plan_id") % 3, F.lit(".xlsx")))
    found = text.parse_filename(F.concat(F.lit("/in box/"), "name"), ["rpname", "bu", "stcode", "cntdate"])
    strict = text.parse_filename("name", ["rpname", "bu", "stcode", "cntdate"], exact=True)
    return named.select("plan_id", *[c.alias(n) for n, c in found.items()], "name", strict["stcode"].alias("strict_store"))


@check("""SELECT plan_id, lpad(stcode, 5, '0') AS store, cntdate AS day, cntdate AS day_right,
    bu || stcode AS code, left(bu || stcode, 3) AS unit, substring(bu || stcode, 4) AS rest,
    CASE WHEN substring(type1, 2, 1) = 'B' THEN 'Credit' ELSE 'Consign' END AS skutype,
    bu || '-' || stcode || '-' || cntdate || '001' AS stocktake,
    CASE branch WHEN 'BUILDING' THEN 'Back' ELSE branch END AS zone FROM v_plan""")
def store_keys(i: Inputs):
    short = F.concat(F.substring("cntdate", 7, 2), F.substring("cntdate", 5, 2), F.substring("cntdate", 3, 2))
    cntnum = F.concat(F.lpad("stcode", 5, "0"), F.lit("F"), short, F.lit("001"))
    code = text.store_code("bu", "stcode")
    halves = text.split_store_code(code)
    late = F.col("cntdate") >= "20000101"
    df = i.plan.select(
        "plan_id",
        text.cntnum_store(cntnum).alias("store"),
        text.cntnum_date(cntnum).alias("day"),
        text.cntnum_date_right(cntnum).alias("day_right"),
        code.alias("code"),
        halves["bu"].alias("unit"),
        halves["stcode"].alias("rest"),
        text.skutype_of("type1").alias("skutype"),
        text.stocktake_id("bu", "stcode", "cntdate", separator="-", suffix="001").alias("stocktake"),
        text.replace_values("branch", {"BUILDING": "Back"}).alias("zone"),
        "cntdate",
    )
    # Count numbers carry two-digit years of this century; the test orders start in 1995.
    back = {c: F.when(late, F.col(c)).otherwise(F.concat(F.lit("19"), F.substr(c, F.lit(3)))) for c in ("day", "day_right")}
    return df.withColumns(back).drop("cntdate")


@check("""SELECT plan_id, CAST(strptime(cntdate, '%Y%m%d') AS DATE) AS day,
    strftime(strptime(cntdate, '%Y%m%d'), '%d/%m/%Y') AS shown, left(cntdate, 4) AS year,
    CAST(strptime(cntdate, '%Y%m%d') AS DATE) AS day_first,
    CASE WHEN plan_id % 2 = 0 THEN CAST(strptime(cntdate, '%Y%m%d') AS DATE) END AS even_day FROM v_plan""")
def date_text(i: Inputs):
    day = dates.parse_date("cntdate")
    shown = F.date_format(day, "dd/MM/yyyy")
    monthly = F.date_format(day, "M/d/yyyy")
    spoken = F.concat(F.date_format(day, "EEEE"), F.lit(" "), F.when(F.col("plan_id") % 2 == 0, monthly).otherwise(shown))
    bad = F.when(F.col("plan_id") % 2 == 0, F.col("cntdate")).otherwise("20250231")
    return i.plan.select(
        "plan_id",
        day.alias("day"),
        shown.alias("shown"),
        dates.year_of("cntdate").alias("year"),
        dates.weekday_date(spoken, F.col("plan_id") % 2 == 0).alias("day_first"),
        dates.parse_date(bad).alias("even_day"),
    )


@check("""SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%Y%m%d %H:%M') AS local,
    strftime(ts, '%Y%m%d') AS day FROM events""")
def shifted_time(i: Inputs):
    return i.table("events").select(
        "event_id",
        F.date_format(dates.shift_hours("ts", 7), "yyyyMMdd HH:mm").alias("local"),
        dates.date_key("ts").alias("day"),
    )


@check("""SELECT event_id, CASE WHEN n <= -1 THEN NULL WHEN n <= 1 THEN 'G 0-1' WHEN n <= 3 THEN 'G 2-3'
    WHEN n <= 5 THEN 'G 4-5' WHEN n <= 7 THEN 'G 6-7' WHEN n <= 9 THEN 'G 8-9' WHEN n <= 15 THEN 'G 10-15'
    WHEN n <= 30 THEN 'G 16-30' ELSE 'G >30' END AS grp FROM (SELECT event_id, user_id % 40 - 3 AS n FROM events)""")
def age_bucket(i: Inputs):
    return i.table("events").select("event_id", dates.age_bucket(F.col("user_id") % 40 - 3).alias("grp"))


@check("""SELECT sku, nullif(concat_ws(',', nullif(ibc, '0'), nullif(sbc1, '0')), '') AS codes FROM v_master""")
def join_nonzero(i: Inputs):
    return i.master.select("sku", text.join_nonzero(["ibc", "sbc1"]).alias("codes"))


@check("""SELECT event_id, CASE WHEN rate = 0 THEN 0 ELSE round_even(value * 100 / rate, 0) END AS days,
    CASE WHEN rate = 0 THEN 0 ELSE round_even(value * 100 / 10500.0, 0) END AS days_fixed
    FROM (SELECT event_id, value, CAST(user_id % 8 * 4 AS DOUBLE) AS rate FROM events)""")
def mandays(i: Inputs):
    rate = (F.col("user_id") % 8 * 4).cast("double")
    stock = F.col("value") * 100
    return i.table("events").select(
        "event_id",
        measures.mandays(stock, rate).alias("days"),
        measures.mandays_fixed(stock, rate).alias("days_fixed"),
    )


@check("""SELECT stcode, cntdate, sku, rpname, CAST(soh AS DOUBLE) AS soh, CAST(qty_var AS DOUBLE) AS qty_var,
    CAST(qty_var * retail_value AS DOUBLE) AS extrtl_var, CAST(qty_var * cost AS DOUBLE) AS extcst_var FROM v_stk""")
def line_variance(i: Inputs):
    counted = i.stk.withColumns({"qty_count": F.col("soh") + F.col("qty_var"), "retail": F.col("retail_value")})
    out = variance.line_variance(counted)
    numbers = [F.col(c).cast("double").alias(c) for c in ("soh", "qty_var", "extrtl_var", "extcst_var")]
    return out.select("stcode", "cntdate", "sku", "rpname", *numbers)
