import numpy as np

from shelfcount.llm import postings as p

from ..conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, nearest=10, every=100):
    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good.setdefault(len(v), []).append((i, np.array(v, np.float32).astype(float)))
    own = max(good.values(), key=lambda g: (len(g), -len(g[0][1]))) if good else []
    out = {}
    for q in sorted({i for i, _ in own if i % every == 0}):
        best: dict = {}
        for i, v in own:
            if i != q:
                gap = min(float(np.sqrt(((v - w) ** 2).sum())) for j, w in own if j == q)
                best[i] = min(gap, best.get(i, np.inf))
        out[q] = sorted((g, i) for i, g in best.items())[:nearest]
    return out


def collected(df):
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_graph_walk_and_balance():
    rng = np.random.default_rng(0)
    data = rng.normal(size=(3000, 16))
    centroids = p.balanced(data, p.bisected(data, 60, rng))
    assert len(centroids) == 60
    sizes = np.bincount(p.squared(data, centroids).argmin(axis=1), minlength=60)
    assert sizes.max() < 4 * 50
    graph = p.Graph.of(centroids)
    lists, gaps = graph.closest(data[:700], 12)
    want = np.sqrt(np.sort(p.squared(data[:700], centroids), axis=1)[:, :5])
    assert np.isclose(gaps[:, 0], want[:, 0]).mean() > 0.97
    full, far = graph.closest(data[:50], 60)
    assert (np.sort(full, axis=1) == np.arange(60)).all() and (np.diff(far, axis=1) >= 0).all()


def test_edges_against_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(400, 6)).astype(np.float32).tolist()
    rows = [(k, v) for k, v in enumerate(vectors)]
    hot = vectors[100]
    rows += [(1000 + k, hot) for k in range(150)]
    rows += [(2000, None), (2001, [0.0] * 6), (2002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2003, [float("nan")] * 6), (2100, [float("inf")] * 6), (None, hot), (2200, [1.0] * 5), (100, hot), (200, vectors[7])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got, want = collected(p.neighbours(df)), brute(rows)
    assert set(got) == set(want)
    hits = total = 0
    for q, near in want.items():
        assert len(got[q]) == len(near)
        exact = dict((i, g) for g, i in brute(rows, 10**6)[q])
        assert all(abs(exact[i] - s) < 1e-9 for s, i in got[q])
        hits += len({i for _, i in near} & {i for _, i in got[q]})
        total += len(near)
    assert hits >= 0.9 * total
    assert [i for _, i in got[100]][:10] == [1000 + k for k in range(10)]


def test_few_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 1.0]), (7, [2.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got, want = collected(p.neighbours(df)), brute(rows)
    assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}
    assert p.neighbours(df.limit(0)).count() == 0
    assert p.neighbours(df.where("vec_id = 0")).count() == 0


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    whole = collected(p.neighbours(df))
    monkeypatch.setattr(p, "BLOCK_VECTORS", 7)
    monkeypatch.setattr(p, "BLOCK_QUERIES", 1)
    assert collected(p.neighbours(df)) == whole


def test_recall(spark):
    df = spark.read.parquet(SMALL.replace("0.001", "0.1") + "/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    ids = np.array([i for i, _ in rows])
    data = np.array([v for _, v in rows], float)
    got = collected(p.neighbours(df))
    asked = ids[ids % 100 == 0]
    assert set(got) == set(asked.tolist())
    hits = 0
    for q in asked.tolist():
        gap = np.sqrt(((data - data[ids == q][0]) ** 2).sum(axis=1))
        gap[ids == q] = np.inf
        hits += len(set(ids[np.lexsort((ids, gap))[:10]].tolist()) & {i for _, i in got[q]})
    assert hits >= 0.9 * 10 * len(asked)


def test_repeated_ids_do_not_push_others_out(spark):
    rng = np.random.default_rng(4)
    rows = [(k, v) for k, v in enumerate(rng.normal(size=(120, 4)).astype(np.float32).tolist())]
    near = np.array(rows[0][1])
    rows += [(500, (near + 1e-3 * k).tolist()) for k in range(1, 25)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    # Whole lists are one block here, so a wider search mends nothing.
    for table, own in ((df, rows), (df.union(df), rows * 2)):
        got, want = collected(p.neighbours(table)), brute(own)
        assert set(got) == set(want)
        assert all(len(v) == 10 for v in got.values())
    work, _ = p._nearest_of(df.schema["vec_id"].dataType, 10)
    import pyarrow as pa

    def arrow(some):
        return pa.table({"id": pa.array([i for i, _ in some], pa.int64()), "v": pa.array([v for _, v in some], pa.list_(pa.float32()))})

    for own in (rows, rows * 2, rows * 12):
        out = work(arrow(own), arrow([rows[0], rows[100]])).to_pylist()
        want = brute(rows)
        for q in (0, 100):
            assert [(r["vec_id"]) for r in out if r["query_id"] == q] == [i for _, i in want[q]]


def test_queries_of_the_tables_width_when_most_are_not(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=4).astype(np.float32).tolist()) for k in range(101)]
    rows += [(100 * k, [1.0, 2.0, 3.0]) for k in range(2, 8)]
    got, want = collected(p.neighbours(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))), brute(rows)
    assert set(got) == set(want) == {0, 100} and all(len(v) == 10 for v in got.values())


def test_walk_reads_every_list_within_the_ratio():
    rng = np.random.default_rng(2)
    data = rng.normal(size=(4000, 8))
    graph = p.fitted(data, len(data))
    graph.ratio = 0.3
    row, lists = graph.lists_for(data[:300])
    away = np.sqrt(p.squared(data[:300], graph.centroids))
    want = away <= 1.3 * away.min(axis=1, keepdims=True)
    got = np.zeros_like(want)
    got[row, lists] = True
    assert len(row) == got.sum() and (got & want).sum() >= 0.97 * want.sum()
    assert want.sum() < 0.5 * want.size and (got & ~want).sum() <= 0.02 * want.sum()
    graph.ratio = 1e9
    assert len(graph.lists_for(data[:20])[0]) == 20 * len(graph.centroids)
    assert [len(x) for x in graph.lists_for(data[:0])] == [0, 0]


def test_border_and_ratio_reach_the_target_with_fewer_comparisons_than_brute_force():
    rng = np.random.default_rng(3)
    data = rng.normal(size=(60, 12))[rng.integers(60, size=6000)] * 3 + rng.normal(size=(6000, 12))
    graph = p.fitted(data[200:], len(data))
    near = p._nearest_rows(data[:200], data, 10, np.arange(200))
    p.fit_reach(graph, data[200:], data[:200], np.repeat(np.arange(200), 10), data[near.ravel()])
    member = np.zeros((len(data), len(graph.centroids)), bool)
    member[graph.member_of(data)] = True
    read = np.zeros((200, len(graph.centroids)), bool)
    read[graph.lists_for(data[:200])] = True
    assert (member[near] & read[:, None]).any(axis=2).mean() >= p.TARGET
    assert graph.border in p.BORDERS and (read @ member.sum(axis=0)).mean() < 0.3 * len(data)


def test_true_neighbours(spark):
    rng = np.random.default_rng(6)
    data = rng.normal(size=(300, 5)).astype(np.float32)
    df = spark.createDataFrame([(k, v) for k, v in enumerate(data.tolist() + [data[0].tolist()] * 40)], "id long, v array<float>")
    owner, near = p._true_neighbours(df.repartition(5), data[:7].astype(float))
    want = data[p._nearest_rows(data[:7].astype(float), data.astype(float), 10, np.arange(7))]
    for q in range(1, 7):
        gap = np.sort(((near[owner == q] - data[q]) ** 2).sum(axis=1))
        full = np.sort(((np.concatenate((data, np.repeat(data[:1], 40, 0))) - data[q]) ** 2).sum(axis=1))[1:11]
        assert np.allclose(gap, full)
    assert np.allclose(np.sort(near[owner == 0], axis=0), np.sort(want[0], axis=0))


def test_lists_and_sample_grow_with_the_table():
    assert p.sample_size(50) == p.LEAST_SAMPLE and p.sample_size(10**7) > 100_000 and p.sample_size(10**12) == p.SAMPLE_ROWS
