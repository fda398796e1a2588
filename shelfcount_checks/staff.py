"""Outsource plans, rates, yearly plans, time off, timesheets and calendars."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcount.plans import masters, staffing

from .inputs import Inputs, check, text_of

ROUND = "CASE WHEN coalesce(rate, 0) = 0 THEN 0 ELSE round_even({} / rate, 0) END"


@check(f"""SELECT plan_id, bu, stcode, st_type, act_man_outsource, expired_check, {ROUND.format('food')} AS est_man_food,
    {ROUND.format('nonfood')} AS est_man_nonfood, {ROUND.format('perishable')} AS est_man_perishable, food + nonfood + perishable AS soh_outsource
    FROM (SELECT plan_id, CASE WHEN bu = 'BU0' THEN 'CFR' ELSE bu END AS bu, stcode, CASE WHEN type1 = '1-URGENT' THEN 'TM' ELSE type1 END AS st_type,
    CAST(plan_id % 5 + 2 AS DOUBLE) AS act_man_outsource, CASE WHEN bu = 'BU0' AND type1 = '1-URGENT' THEN CASE branch WHEN 'BUILDING' THEN 1000
    WHEN 'MACHINERY' THEN 900 ELSE 0 END ELSE 0 END AS expired_check, CAST(plan_id % 1000 AS DOUBLE) AS food, CAST(plan_id % 300 AS DOUBLE) AS nonfood,
    CAST(plan_id % 90 AS DOUBLE) AS perishable, CASE WHEN bu = 'BU0' AND type1 IN ('1-URGENT', '5-LOW') THEN CASE type1 WHEN '1-URGENT' THEN 50.0 ELSE 0.0 END END AS rate
    FROM v_plan WHERE atype <> '4V')""")
def outsource_pieces(i: Inputs):
    vendor = F.when(F.col("branch") == "BUILDING", "PCS").when(F.col("branch") == "MACHINERY", "SSD").otherwise("Store")
    amounts = {"FOOD": 1000, "Nonfood": 300, "Perishable": 90}
    raw = i.plan.select(
        "plan_id",
        F.when(F.col("bu") == "BU0", "CFR").otherwise(F.col("bu")).alias("BUs."),
        F.col("stcode").alias("Store\nCode"),
        F.when(F.col("type1") == "1-URGENT", "TM").otherwise(F.col("type1")).alias("Type"),
        F.col("atype").alias("Atype"),
        vendor.alias("Vendor"),
        F.when(F.col("atype") != "4V", "YES hired").alias("For  Checking"),
        text_of("plan_id").alias("No"),
        (F.col("plan_id") % 5).cast("string").alias("Actual Manday\nControl"),
        F.lit("2").alias("actual manday count"),
        *[(F.col("plan_id") % n).cast("string").alias(c) for c, n in amounts.items()],
    )
    rates = [("CFR", "TM", "3F", 50.0), ("CFR", "TM", "3Q", 50.0), ("CFR", "5-LOW", "3F", 0.0), ("CFR", "5-LOW", "3Q", None)]
    speed = i.spark.createDataFrame(rates, "bu string, st_type string, atype string, per_piece double")
    out = staffing.outsource_pieces(raw, speed)
    assert "no" not in out.columns and "per_piece" not in out.columns
    return out.select(
        "plan_id", "bu", "stcode", "st_type", "act_man_outsource", "expired_check", "est_man_food", "est_man_nonfood", "est_man_perishable", "soh_outsource"
    )


@check("""SELECT plan_id, bu, stcode, branch AS outsource_name FROM v_plan WHERE atype = '3F'""")
def outsource_mandays(i: Inputs):
    raw = i.plan.select(
        "plan_id",
        F.col("bu").alias("BUs."),
        F.col("stcode").alias("Store Code"),
        F.col("branch").alias("Vendor"),
        F.when(F.col("atype") == "3F", "YES").when(F.col("atype") == "3Q", "NO").alias("For Checking"),
        F.lit("x").alias("Time"),
    )
    return staffing.outsource_mandays(raw).drop("hiring_status")


@check("""SELECT plan_id, bu, CAST(plan_id % 3 AS DOUBLE) AS act_man_control, CAST(plan_id % 3 + 3 AS DOUBLE) AS act_man_outsource,
    CASE WHEN plan_id % 4 = 0 THEN 0 ELSE round_even(plan_id * 10.0 / 10500, 0) END AS est_man_food FROM v_plan""")
def outsource_fixed_rate(i: Inputs):
    df = i.plan.select(
        "plan_id",
        "bu",
        (F.col("plan_id") % 3).cast("double").alias("control"),
        F.lit(1.0).alias("expire_manday"),
        F.lit(2.0).alias("counter"),
        (F.col("plan_id") * 10).cast("double").alias("food"),
        F.lit(5.0).alias("nonfood"),
        F.lit(5.0).alias("perishable"),
        (F.col("plan_id") % 4).cast("double").alias("outsource_pieces"),
    )
    out = staffing.outsource_fixed_rate(df)
    return out.select("plan_id", "bu", "act_man_control", "act_man_outsource", "est_man_food")


RATES = """SELECT *, CASE WHEN vendorname IN ('Store', 'PSTDIV') THEN 500 WHEN vendorname = 'Daywork' THEN 600 WHEN vendorname = 'SSD' THEN 900
    WHEN vendorname = 'HRoot' THEN 950 WHEN vendorname = 'Smollan' THEN CASE seasonindex WHEN 'Moon' THEN 575 ELSE 600 END
    WHEN vendorname = 'Innovation' THEN CASE seasonindex WHEN 'Moon' THEN 700 ELSE 780 END WHEN vendorname = 'PCS' THEN CASE darea WHEN 'BKK' THEN 1000 ELSE 1500 END
    WHEN bu = 'CFW' THEN 1500 WHEN seasonindex = 'Moon' THEN 1000 WHEN mindex IN ('1', '4', '5', '6', '7', '12') THEN 1100 ELSE 1200 END AS price FROM
    (SELECT *, CASE WHEN province = 'นนทบุรี' OR (province = 'สุราษฎร์ธานี' AND vendorname = 'AJIS') THEN 'BKK' ELSE 'UPC' END AS darea FROM
    (SELECT CASE n_name WHEN (SELECT min(n_name) FROM nation) THEN 'นนทบุรี' WHEN (SELECT max(n_name) FROM nation) THEN 'สุราษฎร์ธานี' ELSE n_name END AS province FROM nation),
    (VALUES ('AJIS'), ('PCS'), ('SSD'), ('Innovation'), ('Smollan'), ('Daywork'), ('PSTDIV'), ('Store'), ('HRoot')) v(vendorname), (VALUES ('Moon'), ('Night')) s(seasonindex),
    (VALUES ('CFR'), ('CFW')) b(bu), (SELECT CAST(m AS VARCHAR) AS mindex, strftime(make_date(2024, CAST(m AS INTEGER), 1), '%B') AS mname FROM range(1, 13) t(m)))"""


@check(RATES)
def day_rates(i: Inputs):
    nation = i.table("nation").select("n_name")
    ends = nation.agg(F.min("n_name").alias("lo"), F.max("n_name").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    province = F.when(F.col("n_name") == lo, "นนทบุรี").when(F.col("n_name") == hi, "สุราษฎร์ธานี").otherwise(F.col("n_name"))
    return staffing.day_rates(nation.select(province.alias("province")), ["CFR", "CFW"])


@check("""SELECT CASE WHEN plan_id % 9 = 0 THEN NULL ELSE bu END AS bu, stcode, cntdate, CASE WHEN plan_id % 2 = 0 THEN 0 ELSE plan_id END AS est_man_total
    FROM v_plan WHERE plan_id % 9 <> 0""")
def annual_plan(i: Inputs):
    raw = i.plan.select(
        F.when(F.col("plan_id") % 9 != 0, F.col("bu")).alias("BUs."),
        F.col("stcode").alias("Store Code"),
        F.col("cntdate").alias("CNTDATE"),
        F.when(F.col("plan_id") % 2 != 0, F.col("plan_id")).alias("Total EST.Man"),
        "type1",
    )
    names = {"BUs.": "bu", "Store Code": "stcode", "CNTDATE": "cntdate", "Total EST.Man": "est_man_total"}
    return staffing.annual_plan(raw, names, list(names.values()), ["est_man_total"])


@check("""SELECT DISTINCT 'E' || CAST(conv_id AS VARCHAR) AS employee_id, 'N' || CAST(conv_id AS VARCHAR) AS employee_name, 'Leave' AS time_off_type,
    strftime(DATE '2024-01-01' + CAST(turn AS INTEGER), '%Y-%m-%d') AS time_off_date, role AS status FROM conversations WHERE turn % 3 <> 1 AND conv_id % 4 <> 0
    AND turn <> 5""")
def time_off(i: Inputs):
    first = F.col("turn") == 0
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int"))
    us = F.col("conv_id") % 2 == 0
    shown = F.date_format(day, "EEEE ")
    raw = i.table("conversations").select(
        F.when(us, "us_").otherwise("th_").alias("kind"),
        F.col("conv_id"),
        F.col("turn").alias("line"),
        F.when(first, F.concat(F.lit("N"), text_of("conv_id"))).alias("employee name"),
        F.when(first, F.concat(F.lit("E"), text_of("conv_id"))).alias("employee id"),
        F.when(F.col("turn") % 3 == 1, "Off-Site Work (ปฏิบัติงานนอกสถานที่ ) ").otherwise(" Leave").alias("time off type"),
        F.when(F.col("turn") != 5, F.concat(shown, F.when(us, F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "dd/MM/yyyy")))).alias("time off date"),
        F.col("role").alias("status"),
    )
    raw = raw.withColumn("file", F.concat("kind", text_of("conv_id"))).drop("kind", "conv_id")
    stored = i.table("conversations").filter("conv_id % 4 = 0").select(
        F.concat(F.lit("E"), text_of("conv_id")).alias("employee_id"), F.date_format(day, "yyyy-MM-dd").alias("time_off_date")
    )
    return staffing.time_off(raw, stored, month_first_files="us_")


@check("""SELECT file, count(*) FILTER (ok) AS record, CASE WHEN count(*) FILTER (ok) > 0 THEN 'Data inserted' ELSE 'No valid data after filtering' END AS status
    FROM (SELECT stcode AS file, msstoh > 38 AS ok FROM v_soh) GROUP BY 1""")
def intake_log(i: Inputs):
    raw = i.soh.withColumnRenamed("stcode", "file")
    return staffing.intake_log(raw, raw.filter("msstoh > 38"))


@check("SELECT id, stcode AS empcode, cntdate AS check_in_date FROM v_answers WHERE id > (SELECT max(id) FROM v_answers WHERE cntdate < '19950110')")
def timesheet_increment(i: Inputs):
    sheet = i.answers.select("id", F.col("stcode").alias("employeecode"), F.col("cntdate").alias("checkin_date"))
    return staffing.timesheet_increment(sheet, sheet.filter("checkin_date < '19950110'"))


@check("""SELECT s_name AS employee_code, strftime(day, '%Y-%m-%d') AS date, CAST(s_nationkey AS VARCHAR) AS hub, 'Counter' AS position FROM
    (SELECT *, CASE WHEN s_suppkey % 4 = 0 THEN TIMESTAMP '2026-01-01' ELSE TIMESTAMP '2025-12-01' + to_days(CAST(s_suppkey % 60 AS INTEGER)) END AS lo FROM supplier
    WHERE s_suppkey % 3 <> 0), unnest(generate_series(lo, TIMESTAMP '2026-01-31', INTERVAL 1 DAY)) t(day) WHERE NOT (s_suppkey % 5 = 0 AND day < TIMESTAMP '2026-01-15')""")
def employee_calendar(i: Inputs):
    key = F.col("s_suppkey")
    employees = i.table("supplier").select(
        F.col("s_name").alias("employee_code"),
        text_of("s_nationkey").alias("hub"),
        F.lit("Counter").alias("position"),
        F.when(key % 4 != 0, F.date_add(F.lit("2025-12-01").cast("date"), (key % 60).cast("int"))).alias("first_work_date"),
        F.when(key % 3 == 0, F.lit("2026-01-05").cast("date")).when(key % 3 == 1, F.lit("2026-06-01").cast("date")).alias("last_work_date"),
    )
    days = F.sequence(F.lit("2025-12-01").cast("date"), F.lit("2026-01-14").cast("date"))
    stored = i.table("supplier").filter(key % 5 == 0).select(F.col("s_name").alias("employee_code"), F.explode(days).alias("d"))
    stored = stored.select("employee_code", F.date_format("d", "yyyy-MM-dd").alias("date"))
    return staffing.employee_calendar(employees, stored, "2026-01-31")


@check("""SELECT DISTINCT replace(p_name, '''', '') AS name, p_brand AS brand FROM part WHERE p_partkey % 6 <> 0""")
def reference_table(i: Inputs):
    code = F.when(F.col("p_partkey") % 6 == 0, " ' ").otherwise(F.col("p_name"))
    raw = i.table("part").select(code.alias("'NAME'"), F.concat(F.lit("' "), "p_brand", F.lit(" '")).alias(" Brand\n"), "p_type")
    return masters.reference_table(raw, ["name", "brand", "absent"], ["name"])
