import numpy as np
import xxhash

from shelfcount.llm import simhash as s
from shelfcount.llm.components import components


def fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, most):
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if bin((prints[a] ^ prints[b]) & (2**64 - 1)).count("1") <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(prints))]


def test_fingerprints():
    texts = ["A b c d e", "one", "one two", "", None, "É b É b É b É b", "\t x \n y z \x0b q"]
    got = s.fingerprints([None if t is None else t.encode() for t in texts]).view(np.uint64).tolist()
    assert got == [fingerprint(t) for t in texts]


def planted(seed, groups=12, size=25, flips=7):
    rng = np.random.default_rng(seed)
    out = set()
    for _ in range(groups):
        centre = int(rng.integers(0, 2**63)) * 2 + int(rng.integers(0, 2))
        for _ in range(size):
            x = centre
            for b in rng.integers(0, 64, rng.integers(0, flips)):
                x ^= 1 << int(b)
            out.add(x)
    return sorted(out | {0, 1, 7, 2**64 - 1, 2**63, 15 << 30})


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_links_cover_all_components(spark):
    for limit in (s.KEY_MEMBERS, 3):
        prints = planted(limit)
        df = spark.createDataFrame([(signed(x),) for x in prints], "f long")
        found = components(s.links_within(df, 3, limit)).collect()
        root = {signed(x): signed(x) for x in prints} | {r.node: r.root for r in found}
        by: dict = {}
        for x in prints:
            by.setdefault(root[signed(x)], set()).add(x)
        want: dict = {}
        for x, r in zip(prints, roots(prints, 3)):
            want.setdefault(r, set()).add(x)
        assert sorted(map(sorted, by.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5), (3, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 1000 for k in range(1000, 1200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def rows_of(spark):
    base = " ".join(f"w{k}" for k in range(200))
    texts = [base, base.upper(), base + " w200", "", None, "   ", "other words here now", "single", "single"]
    rows = [(k, t, "en") for k, t in enumerate(texts)] + [(None, "single", "de"), (None, "nobody else", "fr"), (7, "single", "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")


def test_near_duplicates(spark):
    docs = rows_of(spark)
    got = s.near_duplicates(docs).collect()
    data = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [fingerprint(t) for _, t in data]
    group = roots(prints, 3)
    least: dict = {}
    for (i, _), g in zip(data, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = [(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(data, prints, group)]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert s.near_duplicates(docs.limit(0)).count() == 0


def test_keep_one(spark):
    docs = rows_of(spark)
    kept = s.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in kept.collect())
    components_of = {r.component_id for r in s.near_duplicates(docs).collect()}
    assert len(got) == len(components_of)
    assert {i for i, _ in got} - {-1} == components_of - {None}
    assert (-1, "nobody else") in got


def test_small_tables_have_the_same_components(spark):
    from ..conftest import SMALL

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in s.near_duplicates(docs).collect()}
    data = sorted((r.doc_id, r.text) for r in docs.collect())
    prints = [fingerprint(t) for _, t in data]
    want = {data[k][0]: (f"{prints[k]:016x}", data[r][0]) for k, r in enumerate(roots(prints, 3))}
    assert got == want
