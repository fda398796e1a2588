"""Laws that must hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcount.functions import text
from shelfcount.operators import gates, maintain, reshape, variance

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
KEY = st.sampled_from(["a", "b", "c", None])
ROWS = st.lists(st.tuples(KEY, st.integers(-5, 5)), min_size=1, max_size=12)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, data):
    return spark.createDataFrame(data, "k string, v int")


@SETTINGS
@given(ROWS, ROWS)
def test_semi_and_anti_partition(spark, left, right):
    a, b = frame(spark, left), frame(spark, right)
    both = gates.planned_only(a, b, ["k"]).unionByName(gates.not_loaded(a, b, ["k"]))
    assert rows(both) == rows(a)


@SETTINGS
@given(ROWS, ROWS)
def test_replace_keys_twice(spark, left, right):
    a, b = frame(spark, left), frame(spark, right).dropna()
    once = maintain.replace_keys(a, b, ["k"])
    assert rows(maintain.replace_keys(once, b, ["k"])) == rows(once)


@SETTINGS
@given(ROWS, ROWS)
def test_archive_twice(spark, left, right):
    a, b = frame(spark, left).dropna(), frame(spark, right).dropna()
    once = maintain.archive_new(a, b, ["k"], "k", "a", "b")
    assert rows(maintain.archive_new(a, once, ["k"], "k", "a", "b")) == rows(once)


@SETTINGS
@given(ROWS)
def test_gain_and_loss_make_net(spark, data):
    df = frame(spark, data).select("k", F.lit(3).alias("soh"), F.lit(2).alias("cost"), F.col("v").alias("extcst_var"))
    for r in variance.variance_kpi(df, ["k"]).collect():
        assert r["vgain"] + r["vloss"] == r["vnet"]
        assert r["vabs"] == r["vgain"] - r["vloss"]


@SETTINGS
@given(ROWS)
def test_unpivot_row_count(spark, data):
    df = frame(spark, data).withColumn("w", F.col("v"))
    assert reshape.unpivot_answers(df, ["k"], ["v", "w"]).count() == 2 * len(data)


@SETTINGS
@given(st.lists(st.text(alphabet="+-0123456789ab", max_size=18), min_size=1, max_size=10), st.integers(1, 15))
def test_zfill_like_python(spark, codes, width):
    df = spark.createDataFrame([(c,) for c in codes], "c string").select("c", text.zfill("c", width).alias("z"))
    for r in df.collect():
        assert r["z"] == r["c"].zfill(width)
