"""One group holding most rows must be split over tasks and still be numbered right."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcount.operators import gates, joins, ranking, variance
from shelfcount.operators.keys import first_of_key
from shelfcount.plans import analysis


def hot(spark, n=20000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
    return spark.range(0, n, 1, 8).select(key.alias("k"), ((F.col("id") * 7919) % n).alias("o"))


def test_hot_group_spans_slices(spark):
    sliced = ranking._sliced(hot(spark), ["k"], ["o"])
    sizes = sliced.filter("k = 'hot'").groupBy(ranking.SLICE).count().collect()
    assert len(sizes) > 1
    assert max(r["count"] for r in sizes) < 20000 / 3


def test_contributions_are_bounded_by_slices(spark):
    sliced = ranking._sliced(hot(spark), ["k"], ["o"])
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends, over = ranking._reaching(sliced, ["k"])
    assert ends.count() <= slices
    assert 0 < over.count() < slices


def unrepeatable(spark, n):
    """Rows that are others whenever they are made again."""
    draw = F.udf(lambda: random.random(), "double").asNondeterministic()
    return spark.range(0, n, 1, 8).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"), "id", draw().alias("o"))


def test_an_unrepeatable_input_is_numbered_without_gaps(spark):
    rows = ranking.rank_rows(unrepeatable(spark, 30000), ["k"], ["o", "id"], "rn").collect()
    found = {}
    for r in rows:
        found.setdefault(r.k, []).append((r.o, r.rn))
    assert sum(map(len, found.values())) == 30000
    for group in found.values():
        assert [n for _, n in sorted(group)] == list(range(1, len(group) + 1))


def dealings(plan):
    """Exchanges by range that are not read again from another place."""
    return [x for x in plan.splitlines() if "Exchange rangepartitioning" in x and "ReusedExchange" not in x]


def test_numbering_is_planned_without_a_job_and_dealt_once(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    df = hot(spark, 5000).join(spark.range(97).withColumnRenamed("id", "n"), F.col("o") % 97 == F.col("n"))
    out = [ranking.rank_rows(df, ["k"], ["o"], "rn"), ranking.forward_fill(df, ["n"], ["k"], ["o"])]
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    for frame in out:
        rows, plan = final_plan(frame)
        assert rows == 5000
        assert len(dealings(plan)) == 1 and plan.count("Range (0, 5000") == 1, plan
        # Whole rows are dealt, so a caller that takes few columns still reads the same exchange.
        assert len(dealings(final_plan(frame.select("k"))[1])) == 1


def test_without_reuse_the_job_fails_and_numbers_are_not_wrong(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(Exception, match="dealt twice"):
            ranking.rank_rows(unrepeatable(spark, 30000), ["k"], ["o", "id"], "rn").collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_few_rows_and_slices(spark):
    for n in (0, 1, 2):
        df = spark.range(n).select(F.lit("a").alias("k"), "id", F.lit(None).cast("string").alias("v"))
        assert [r.rn for r in ranking.rank_rows(df, ["k"], ["id"], "rn").orderBy("rn").collect()] == list(range(1, n + 1))
        assert ranking.forward_fill(df, ["v"], ["k"], ["id"]).count() == n
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert ranking.rank_rows(hot(spark, 500), [], ["o"], "rn").filter("rn <> o + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_filling_many_types_over_slices(spark):
    kinds = {"a": "decimal(9,2)", "b": "date", "c": "timestamp", "d": "array<int>", "e": "struct<x:int>", "f": "string"}
    made = {"a": "CAST(id AS DECIMAL(9,2))", "b": "date_add(DATE'2026-01-01', CAST(id AS INT))", "c": "timestamp_seconds(id)", "d": "array(CAST(id AS INT))", "e": "named_struct('x', CAST(id AS INT))", "f": "CAST(id AS STRING)"}
    holes = {c: f"CASE WHEN id % {m} = 0 AND id > 40 THEN {made[c]} END" for c, m in zip(kinds, (2, 3, 5, 700, 900, 4000))}
    df = spark.range(0, 6000, 1, 8).selectExpr("CASE WHEN id < 5000 THEN 'hot' ELSE CAST(id AS STRING) END AS k", "id", *[f"{e} AS {c}" for c, e in holes.items()])
    window = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in kinds})
    got = ranking.forward_fill(df, list(kinds), ["k"], ["id"])
    assert got.schema == df.schema
    assert got.exceptAll(want).count() == 0 and got.count() == 6000


def test_rank_of_hot_group(spark):
    out = ranking.rank_rows(hot(spark), ["k"], ["o"], "rn")
    bad = out.groupBy("k").agg(
        F.max("rn").alias("top"), F.count(F.lit(1)).alias("n"), F.count_distinct("rn").alias("d"), F.corr("rn", F.col("rn")).alias("c")
    ).filter("top <> n OR d <> n")
    assert bad.count() == 0
    pairs = out.filter("k = 'hot'").orderBy("rn").select("o").collect()
    assert [r["o"] for r in pairs] == sorted(r["o"] for r in pairs)


def test_rank_descending_with_null_keys(spark):
    df = hot(spark, 3000).withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    out = ranking.rank_rows(df, ["k"], [ranking.Down("o")], "rn").filter("k IS NULL").orderBy("rn").collect()
    assert [r["rn"] for r in out] == list(range(1, len(out) + 1))
    assert [r["o"] for r in out] == sorted((r["o"] for r in out), reverse=True)


def test_forward_fill_across_slices(spark):
    df = spark.range(0, 9000, 1, 8).select(
        (F.col("id") % 2).alias("k"), "id", F.when(F.col("id") % 3000 < 2, F.col("id").cast("string")).alias("v"), F.lit(None).cast("int").alias("w")
    )
    out = ranking.forward_fill(df, ["v", "w"], ["k"], ["id"])
    for r in out.collect():
        assert r["v"] == str(r["id"] // 3000 * 3000 + r["k"])
        assert r["w"] is None


def test_picking_is_cut_before_the_shuffle(spark):
    plan = ranking.latest_per_group(hot(spark), ["k"], ["o"])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    execution = df._jdf.queryExecution()
    rows = execution.toRdd().count()
    return rows, execution.executedPlan().toString().split("Initial Plan")[0]


def split(df):
    return "SortMergeJoin(skew=true)" in final_plan(df)[1]


def test_gates_split_a_hot_key(spark, no_broadcast):
    rows = hot(spark, 200000).withColumn("v", F.sha2(F.col("o").cast("string"), 256))
    other = rows.select("k").filter("k <> 'k5'")
    assert split(gates.planned_only(rows, other, ["k"]))
    assert split(gates.not_loaded(rows, other.filter("k <> 'hot'"), ["k"]))
    assert split(gates.exists_gate(rows, other, other.filter("k = 'k7'"), ["k"]))
    assert split(gates.reject_if_all_unknown(rows.withColumn("skutype", F.lit("Credit")), "k"))


def test_lookups_split_a_hot_key(spark, no_broadcast):
    rows = hot(spark, 200000).withColumn("v", F.sha2(F.col("o").cast("string"), 256))
    stored = rows.filter("o < 1000").withColumn("seq", F.col("o"))
    assert split(ranking.sequence_in_group(rows, ["k"], ["o"], stored))
    master = rows.select(F.col("k").alias("barcode"), F.col("k").alias("sku"))
    assert split(joins.lookup_two_step(rows.withColumnRenamed("k", "barcode"), master))


def test_picked_rows_stay_cut_before_the_shuffle(spark):
    plan = first_of_key(hot(spark), ["k"], [F.col("o").asc()])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_cuts_follow_the_order_of_a_sort(spark):
    values = [None, -5, 0, 3, 3, 9]
    rows = [(a, b, c) for a in values for b in (None, "x", "y") for c in range(40)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    for order in (["a", "b", "c"], [ranking.Down("a"), "b", ranking.Down("c")], [ranking.Down("b"), ranking.Down("a"), "c"]):
        df3 = df.dropDuplicates(["a", "b", "c"])
        out = [r["rn"] for r in ranking.rank_rows(df3, [], order, "rn").orderBy(*ranking._cols(order)).collect()]
        assert out == list(range(1, df3.count() + 1))


def test_numbering_writes_nothing(spark, tmp_path, monkeypatch):
    from shelfcount import session

    monkeypatch.setattr(session, "durable", lambda df: pytest.fail("a table was written"))
    assert ranking.rank_rows(hot(spark), ["k"], ["o"], "rn").count() == 20000
    assert not hasattr(ranking, "durable")


def report_lines(spark, n=9000):
    cells = ["stock", "qnt", "variance", "qnt_retail", "qnt_cost", "var_retail", "var_cost"]
    store = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 > 0, (F.col("id") % 400).cast("string"))
    return spark.range(0, n, 1, 8).select(
        store.alias("stcode"), F.when(F.col("id") >= 0, "d").alias("cntdate"), F.when(F.col("id") % 2 == 0, "STK1").when(F.col("id") % 7 > 0, "STK2").alias("rpname"),
        F.lit("Credit").alias("skutype"), F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("string")).alias("dept"), F.lit("s").alias("sub_dept"),
        *[F.when(F.col("id") % (29 + k) > 0, (F.col("id") * (k + 3)) % 11 - 5).cast("decimal(12,3)").alias(c) for k, c in enumerate(cells)],
    )


@pytest.mark.parametrize("large", [variance.LARGE, 1000])
def test_report_levels_shuffle_lines_once(spark, large):
    lines = report_lines(spark)
    both = variance.reports_by_level(lines, large=large)
    for level, want in (("store", variance.store_report(lines)), ("dept", variance.dept_report(lines))):
        got = both.filter(F.col("level") == level).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # The lines go to the task of their count, once; only sums of the large count are shuffled besides, twice.
    assert final_plan(both)[1].count("Exchange hashpartitioning") == (1 if large > 9000 else 3)


def test_a_large_count_is_added_up_where_it_is_read(spark):
    lines = report_lines(spark)
    slots = variance._large_slots(lines, 1000)
    assert [r[0] for r in lines.filter("stcode = 'hot'").select(variance._slot()).distinct().collect()] == slots
    assert variance._large_slots(lines, 9000) == []


@pytest.mark.parametrize("large", [variance.LARGE, 1000])
def test_report_levels_meet_their_plan_where_they_are(spark, no_broadcast, monkeypatch, large):
    monkeypatch.setattr(variance.reports_by_level, "__defaults__", ("STK2", large))
    lines = report_lines(spark)
    day = F.when(F.col("id") >= 0, "d").alias("cntdate")
    plan = spark.range(200).select(F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("stcode"), day)
    cells = [F.lit(n).cast("decimal(9,2)").alias(c) for n, c in enumerate(("qnt", "price"))]
    store = (F.col("id") % 30).cast("string").alias("stcode")
    # A constant date, which Spark takes out of the keys.
    scanned = spark.range(90).select(F.lit("ST1").alias("stocktakeid"), store, F.lit("d").alias("cntdate"), F.col("id").alias("sku"), *cells)
    levels, apart = analysis.count_report_levels(lines, scanned, plan), analysis.count_reports(lines, scanned, plan)
    for level, want in apart.items():
        want = want.filter("sku_count IS NOT NULL")
        got = levels.filter(F.col("level") == level).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert levels.filter("level IS NULL").count() == plan.join(apart["store"].filter("sku_count IS NOT NULL"), "stcode", "left_anti").count()
    steps = final_plan(levels)[1].splitlines()
    union = next(n for n, x in enumerate(steps) if x.rstrip().endswith("Union"))
    sort = max(n for n, x in enumerate(steps[:union]) if " Sort [" in x)
    assert not [x for x in steps[sort:union] if "Exchange" in x]
