import hashlib
import math
import time

from shelfcount.llm import poisson_mix as p


def drawn(seed, label, *values):
    line = "|".join([f"{seed}:{label}", *("\x00" if v is None else str(v) for v in values)])
    return int(hashlib.md5(line.encode()).hexdigest()[:13], 16) / 2**52


def inverse(rate, u):
    k, log, total = 0, -rate, math.exp(-rate)
    while total <= u and k < rate + 10 * math.sqrt(rate) + 20:
        k += 1
        log += math.log(rate) - math.log(k)
        total += math.exp(log)
    return k


def rows(spark):
    data = [(k, "x" * (k % 17), "hot" if k % 3 else f"s{k % 6}") for k in range(600)] + [(None, None, None), (None, "q", None), (7, "", "hot"), (7, "", "hot")]
    return data, spark.createDataFrame(data, "doc_id long, text string, source string")


def test_against_brute_force(spark):
    data, docs = rows(spark)
    rates = {r.source: r.rate for r in p.source_rates(docs).collect()}
    size: dict = {}
    for _, t, s in data:
        size[s] = size.get(s, 0) + len(t or "") + 1
    weights = {s: math.sqrt(n) for s, n in size.items()}
    for s in size:
        assert abs(rates[s] - weights[s] / sum(weights.values()) * sum(size.values()) / size[s]) < 1e-8
    got = p.replicated(docs, p.source_rates(docs)).collect()
    want = []
    for i, _, s in data:
        want += [(i, s, c) for c in range(1, 1 + inverse(rates[s], drawn(42, "count", i, s)))]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.source, r["__copy"]) for r in got), key=key) == sorted(want, key=key)
    assert all(r["__place"] == drawn(42, "place", r.doc_id, r.source, r["__copy"]) for r in got)


def test_weights_move_the_mixture(spark):
    docs = spark.createDataFrame([(k, "t", "a" if k % 10 else "b") for k in range(20000)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 1.0), ("b", 0.5), ("b", 0.5), ("c", 9.0)], "source string, weight double")
    got = {r.source: r["count"] for r in p.mixed(docs, weights.where("source <> 'c'")).groupBy("source").count().collect()}
    assert abs(got["a"] - 10000) < 400 and abs(got["b"] - 10000) < 400
    assert {r.source for r in p.mixed(docs, weights.where("source = 'a'")).select("source").distinct().collect()} == {"a"}


def test_large_rates_and_edges(spark):
    data, docs = rows(spark)
    one = spark.createDataFrame([("hot", 5000.0, 900.0)], "source string, size double, rate double")
    counts = {r["__copies"] for r in p.replicated(docs.where("doc_id < 50"), one).collect()}
    assert counts and all(700 < c < 1100 for c in counts)
    assert p.mixed(docs).columns == docs.columns
    assert p.mixed(docs.limit(0)).count() == 0
    assert p.mixed(docs.withColumn("copy", docs.doc_id)).columns == ["doc_id", "text", "source", "copy"]
    places = [r.place for r in p.mix_digest(docs).collect()]
    assert places == sorted(places)


def test_steps_of_all_rates(spark):
    wanted = [0.0, 1e-9, 0.5, 130.0, 400.0, 5000.0, 1e6]
    rates = spark.createDataFrame([(f"s{k}", r) for k, r in enumerate(wanted)] + [(None, 3.0)], "source string, rate double")
    start = time.perf_counter()
    found = {r.rate: r for r in p.poisson_steps(rates).collect()}
    assert time.perf_counter() - start < 10
    assert set(found) == {*wanted[1:], 3.0}
    for rate, r in found.items():
        assert len(r.steps) <= 20 * math.sqrt(rate) + 43
        low = max(r.first, int(rate) - 60)
        exact = sum(math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) for k in range(r.first, low + 1))
        assert math.isclose(r.steps[low - r.first], exact, rel_tol=1e-6, abs_tol=1e-12)
        assert abs(r.steps[-1] - 1) < 1e-6 and r.steps == sorted(r.steps)
    one = spark.createDataFrame([("a", 1.0, 1e6)], "source string, size double, rate double")
    docs = spark.createDataFrame([(1, "t", "a")], "doc_id long, text string, source string")
    assert abs(p.replicated(docs, one).count() - 1e6) < 6000
    assert p.replicated(docs, rates.where("rate = 0").selectExpr("'a' AS source", "rate")).count() == 0
