"""Stock-count shapes derived from the test tables, once as DataFrames and once as SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Narrow enough for products of both to stay within 18 digits.
QTY = "decimal(8,3)"
PRICE = "decimal(9,2)"


def month_number(c: str):
    return F.year(c) * 10000 + F.month(c) * 100 + 1


def month(c: str):
    return month_number(c).cast("string")


def day(c: str):
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("string")


def text_of(c: str):
    return F.col(c).cast("string")


class Inputs:
    """DataFrames over one directory of test tables; ``hint`` is given to the joins with parts and customers."""

    def __init__(self, spark: SparkSession, folder: str, hint: str | None = None):
        self.spark, self.folder, self.hint = spark, folder, hint
        self._tables: dict[str, DataFrame] = {}

    @cached_property
    def shuffled(self) -> Inputs:
        """The same rows without a broadcast of parts or customers.

        Spark goes by the packed size of the files, of which the keys are a small part: keys of millions of rows
        pass for small, and the driver holds as many of these tables at once as the query has joins.
        """
        return Inputs(self.spark, self.folder, "merge")

    def looked_up(self, name: str) -> DataFrame:
        return self.table(name).hint(self.hint) if self.hint else self.table(name)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def plan(self) -> DataFrame:
        joined = self.table("orders").join(
            self.looked_up("customer"), F.col("o_custkey") == F.col("c_custkey")
        )
        atype = F.when(F.col("o_orderstatus") == "F", "3F").when(F.col("o_orderstatus") == "O", "3Q")
        return joined.select(
            F.concat(F.lit("BU"), (F.col("c_nationkey") % 3).cast("string")).alias("bu"),
            text_of("o_custkey").alias("stcode"),
            day("o_orderdate").alias("cntdate"),
            atype.otherwise("4V").alias("atype"),
            F.col("o_orderpriority").alias("type1"),
            F.when(F.col("o_custkey") % 11 != 0, F.col("c_mktsegment")).alias("branch"),
            F.col("o_orderkey").alias("plan_id"),
        )

    @cached_property
    def planm(self) -> DataFrame:
        first = F.concat(F.left("cntdate", F.lit(6)), F.lit("01"))
        return self.plan.filter("atype <> '4V'").select("stcode", first.alias("cntdate")).distinct()

    @cached_property
    def stk(self) -> DataFrame:
        # What the lines give is worked out before the join, as it is narrower than their columns if they are shuffled.
        lines = self.table("lineitem").select(
            "l_partkey",
            "l_suppkey",
            month_number("l_shipdate").alias("month"),
            (F.col("l_returnflag") == "R").alias("returned"),
            (F.col("l_linestatus") == "O").alias("open"),
            F.col("l_quantity").cast(QTY).alias("soh"),
            F.col("l_extendedprice").cast(PRICE).alias("retail_value"),
            ((F.col("l_orderkey") + 3 * F.col("l_linenumber")) % 7 - 3).cast(QTY).alias("qty_var"),
        )
        return lines.join(self.looked_up("part"), F.col("l_partkey") == F.col("p_partkey")).select(
            text_of("l_suppkey").alias("stcode"),
            text_of("month").alias("cntdate"),
            F.when(F.col("returned"), "Credit").otherwise("Consign").alias("skutype"),
            F.when(F.col("open"), "STK1").otherwise("STK2").alias("rpname"),
            text_of("l_partkey").alias("sku"),
            "soh",
            "retail_value",
            F.col("p_retailprice").cast(PRICE).alias("cost"),
            "qty_var",
        )

    @cached_property
    def valued(self) -> DataFrame:
        """Report lines with the variance valued at cost."""
        return self.stk.withColumn("extcst_var", F.col("qty_var") * F.col("cost"))

    @cached_property
    def book(self) -> DataFrame:
        """Report lines in the shape of the store report."""
        counted = F.col("soh") + F.col("qty_var")
        retail = (F.col("cost") * 2).cast(PRICE)
        return self.stk.select(
            "stcode",
            "cntdate",
            "rpname",
            "skutype",
            F.left("sku", F.lit(1)).alias("dept"),
            F.left("sku", F.lit(2)).alias("sub_dept"),
            "sku",
            F.col("soh").alias("stock"),
            counted.alias("qnt"),
            F.col("qty_var").alias("variance"),
            (counted * retail).alias("qnt_retail"),
            (counted * F.col("cost")).alias("qnt_cost"),
            (F.col("qty_var") * retail).alias("var_retail"),
            (F.col("qty_var") * F.col("cost")).alias("var_cost"),
        )

    @cached_property
    def var(self) -> DataFrame:
        kind = F.col("soh").cast("int") % 5
        batch = F.when(kind == 0, "D").when(kind == 1, "R").otherwise("A")
        return self.stk.select(
            "stcode",
            "cntdate",
            F.when(F.col("rpname") == "STK1", "VAR1").otherwise("VAR2").alias("rpname"),
            "skutype",
            "sku",
            F.concat(batch, "stcode").alias("batch"),
            (F.col("soh") + F.col("qty_var")).alias("qty_count"),
        )

    @cached_property
    def soh(self) -> DataFrame:
        other = F.when(F.col("soh").cast("int") % 2 == 0, "02").otherwise("03")
        return self.stk.select(
            "stcode",
            F.col("cntdate").alias("as_date"),
            F.when(F.col("skutype") == "Credit", "01").otherwise(other).alias("mstype"),
            "sku",
            F.col("stcode").alias("vendor"),
            (F.col("sku").cast("bigint") % 9 * 100).cast("string").alias("sdpt"),
            (F.col("soh") + F.col("qty_var") - 10).cast(QTY).alias("msstoh"),
        )

    @cached_property
    def soh_file(self) -> DataFrame:
        """On-hand rows with the column names of an intake file, all text."""
        return self.soh.select(
            F.col("stcode").alias("msstor"),
            "mstype",
            F.substr("as_date", F.lit(3)).alias("msasdt"),
            F.col("sku").alias("mssku"),
            F.col("vendor").alias("msvdno"),
            F.col("sdpt").alias("mssdpt"),
            F.col("msstoh").cast("string").alias("msstoh"),
        )

    @cached_property
    def sale(self) -> DataFrame:
        amount = F.col("l_extendedprice").cast(PRICE)
        zero = F.lit(0).cast(PRICE)
        returned = F.col("l_returnflag") == "R"
        return (
            self.table("lineitem")
            .groupBy(text_of("l_suppkey").alias("mdstor"), month("l_shipdate").alias("cntdate"))
            .agg(
                F.sum(F.when(returned, amount).otherwise(zero)).alias("credit"),
                F.sum(F.when(~returned, amount).otherwise(zero)).alias("consignment"),
            )
        )

    @cached_property
    def block(self) -> DataFrame:
        scope = F.when(F.col("s_suppkey") % 10 == 0, "all").otherwise("300")
        return (
            self.table("supplier")
            .filter("s_suppkey % 5 = 0")
            .select(text_of("s_suppkey").alias("veno"), scope.alias("sdpt"))
        )

    @cached_property
    def master(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            text_of("p_partkey").alias("sku"),
            F.col("p_name").alias("des"),
            F.when(key % 4 == 0, "0").otherwise((key + 880000000000).cast("string")).alias("ibc"),
            F.when(key % 3 != 0, text_of("p_size")).alias("sbc1"),
            F.when(key % 5 == 0, " ").otherwise((key + 99000000000000).cast("string")).alias("sbc2"),
            F.col("p_retailprice").cast(PRICE).alias("price"),
            F.col("p_brand").alias("dept"),
            F.col("p_type").alias("sdept"),
        )

    @cached_property
    def answers(self) -> DataFrame:
        both = (F.col("o_orderkey") + F.col("o_custkey")) % 6
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            text_of("o_custkey").alias("stcode"),
            day("o_orderdate").alias("cntdate"),
            (F.col("o_orderkey") % 6).alias("q01"),
            (F.col("o_custkey") % 6).alias("q02"),
            F.when(F.col("o_orderkey") % 7 != 0, both).alias("q03"),
        )

    @cached_property
    def scan(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("scan_id"),
            "ts",
            F.concat(F.lit("ST"), (F.col("user_id") % 10).cast("string")).alias("stocktakeid"),
            F.col("event_type").alias("location"),
            text_of("user_id").alias("sku"),
            F.col("value").cast(QTY).alias("qty"),
        )

    @cached_property
    def edit(self) -> DataFrame:
        return self.scan.filter("scan_id % 11 = 0").select(
            F.col("scan_id").alias("id"),
            "stocktakeid",
            "location",
            "sku",
            (F.col("qty") + 1).cast(QTY).alias("qty"),
        )

    @cached_property
    def package(self) -> DataFrame:
        """Item master per stocktake, without every fifth item."""
        users = self.table("events").select("user_id").distinct().filter("user_id % 5 <> 0")
        joined = users.join(self.looked_up("part"), F.col("user_id") == F.col("p_partkey"))
        sku = text_of("user_id")
        return joined.select(
            F.concat(F.lit("ST"), (F.col("user_id") % 10).cast("string")).alias("stocktakeid"),
            sku.alias("sku"),
            F.concat(F.lit("99"), sku).alias("barcode"),
            F.col("p_retailprice").cast(PRICE).alias("price"),
            (F.col("user_id") % 7).cast("string").alias("stcode"),
            F.lit("20240101").alias("cntdate"),
        )

    @cached_property
    def inbox(self) -> DataFrame:
        names = F.concat(
            F.lit('[{"name":"f'), (F.col("event_id") % 20).cast("string"), F.lit('.XLSX"},{"name":"note.pdf"}]')
        )
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("BU"), (F.col("user_id") % 3).cast("string")).alias("bu"),
            text_of("user_id").alias("stcode"),
            F.col("ts").alias("start_ts"),
            F.when(F.col("event_id") % 13 == 0, "bad json").otherwise(names).alias("stk1"),
        )


VIEWS = {
    "v_plan": """SELECT 'BU' || CAST(c.c_nationkey % 3 AS VARCHAR) AS bu, CAST(o.o_custkey AS VARCHAR) AS stcode,
        strftime(o.o_orderdate, '%Y%m%d') AS cntdate,
        CASE o.o_orderstatus WHEN 'F' THEN '3F' WHEN 'O' THEN '3Q' ELSE '4V' END AS atype,
        o.o_orderpriority AS type1, CASE WHEN o.o_custkey % 11 <> 0 THEN c.c_mktsegment END AS branch, o.o_orderkey AS plan_id
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "v_planm": "SELECT DISTINCT stcode, left(cntdate, 6) || '01' AS cntdate FROM v_plan WHERE atype <> '4V'",
    "v_stk": """SELECT CAST(l_suppkey AS VARCHAR) AS stcode, strftime(l_shipdate, '%Y%m') || '01' AS cntdate,
        CASE WHEN l_returnflag = 'R' THEN 'Credit' ELSE 'Consign' END AS skutype,
        CASE l_linestatus WHEN 'O' THEN 'STK1' ELSE 'STK2' END AS rpname, CAST(l_partkey AS VARCHAR) AS sku,
        CAST(l_quantity AS DECIMAL(18,3)) AS soh, CAST(l_extendedprice AS DECIMAL(18,2)) AS retail_value,
        CAST(p_retailprice AS DECIMAL(18,2)) AS cost,
        CAST((l_orderkey + 3 * l_linenumber) % 7 - 3 AS DECIMAL(18,3)) AS qty_var
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "v_valued": "SELECT *, CAST(qty_var * cost AS DECIMAL(28,4)) AS extcst_var FROM v_stk",
    "v_book": """SELECT stcode, cntdate, rpname, skutype, left(sku, 1) AS dept, left(sku, 2) AS sub_dept, sku,
        soh AS stock, soh + qty_var AS qnt, qty_var AS variance, (soh + qty_var) * cost * 2 AS qnt_retail,
        (soh + qty_var) * cost AS qnt_cost, qty_var * cost * 2 AS var_retail, qty_var * cost AS var_cost FROM v_stk""",
    "v_var": """SELECT stcode, cntdate, CASE rpname WHEN 'STK1' THEN 'VAR1' ELSE 'VAR2' END AS rpname, skutype, sku,
        CASE CAST(soh AS INTEGER) % 5 WHEN 0 THEN 'D' WHEN 1 THEN 'R' ELSE 'A' END || stcode AS batch,
        soh + qty_var AS qty_count FROM v_stk""",
    "v_soh": """SELECT stcode, cntdate AS as_date, CASE skutype WHEN 'Credit' THEN '01'
        ELSE CASE WHEN CAST(soh AS INTEGER) % 2 = 0 THEN '02' ELSE '03' END END AS mstype, sku, stcode AS vendor,
        CAST(CAST(sku AS BIGINT) % 9 * 100 AS VARCHAR) AS sdpt, CAST(soh + qty_var - 10 AS DECIMAL(18,3)) AS msstoh
        FROM v_stk""",
    "v_sale": """SELECT CAST(l_suppkey AS VARCHAR) AS mdstor, strftime(l_shipdate, '%Y%m') || '01' AS cntdate,
        SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS credit,
        SUM(CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS consignment
        FROM lineitem GROUP BY 1, 2""",
    "v_block": """SELECT CAST(s_suppkey AS VARCHAR) AS veno, CASE WHEN s_suppkey % 10 = 0 THEN 'all' ELSE '300' END
        AS sdpt FROM supplier WHERE s_suppkey % 5 = 0""",
    "v_master": """SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name AS des,
        CASE WHEN p_partkey % 4 = 0 THEN '0' ELSE CAST(880000000000 + p_partkey AS VARCHAR) END AS ibc,
        CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS sbc1,
        CASE WHEN p_partkey % 5 = 0 THEN ' ' ELSE CAST(99000000000000 + p_partkey AS VARCHAR) END AS sbc2,
        CAST(p_retailprice AS DECIMAL(18,2)) AS price, p_brand AS dept, p_type AS sdept FROM part""",
    "v_answers": """SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS stcode,
        strftime(o_orderdate, '%Y%m%d') AS cntdate, CAST(o_orderkey % 6 AS BIGINT) AS q01,
        CAST(o_custkey % 6 AS BIGINT) AS q02,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST((o_orderkey + o_custkey) % 6 AS BIGINT) END AS q03
        FROM orders""",
    "v_scan": """SELECT event_id AS scan_id, ts, 'ST' || CAST(user_id % 10 AS VARCHAR) AS stocktakeid,
        event_type AS location, CAST(user_id AS VARCHAR) AS sku, CAST(value AS DECIMAL(18,3)) AS qty FROM events""",
    "v_edit": """SELECT scan_id AS id, stocktakeid, location, sku, CAST(qty + 1 AS DECIMAL(18,3)) AS qty FROM v_scan
        WHERE scan_id % 11 = 0""",
    "v_package": """SELECT 'ST' || CAST(user_id % 10 AS VARCHAR) AS stocktakeid, CAST(user_id AS VARCHAR) AS sku,
        '99' || CAST(user_id AS VARCHAR) AS barcode, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
        CAST(user_id % 7 AS VARCHAR) AS stcode, '20240101' AS cntdate
        FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 5 <> 0) u JOIN part ON user_id = p_partkey""",
    "v_inbox": """SELECT event_id AS id, 'BU' || CAST(user_id % 3 AS VARCHAR) AS bu, CAST(user_id AS VARCHAR) AS stcode,
        ts AS start_ts, CASE WHEN event_id % 13 = 0 THEN 'bad json' ELSE '[{"name":"f' ||
        CAST(event_id % 20 AS VARCHAR) || '.XLSX"},{"name":"note.pdf"}]' END AS stk1 FROM events""",
}


def with_views(sql: str) -> str:
    """The query preceded by the stand-in views it uses."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_[a-z]+\b", text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    views = ", ".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {views}, {body[5:]}"
    return f"WITH {views} {body}"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(sql: str | None = None, name: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under its name, with its SQL twin."""

    def register(fn: Callable[[Inputs], DataFrame]):
        key = name or fn.__name__
        QUERIES[key] = lambda spark, folder: fn(Inputs(spark, folder))
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return fn

    return register
