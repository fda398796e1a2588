import math
import re
from collections import Counter

import numpy as np
import pytest

from shelfcount.llm import term_search as s

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    found = TERM.findall(text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in found]


def brute(docs, items, k):
    """Every text scored in full."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    n_texts, n_terms = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    queries = {}
    for item, text in items:
        queries.setdefault(item, set()).update(terms(text))
    rows = []
    for item, words in queries.items():
        found = []
        for d, bag in bags:
            n = sum(bag.values())
            m = 10 + (90 * n * n_texts) // n_terms if n_terms else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_texts + 2) / (2 * df[w] + 1))) * ((10**9 * bag[w]) // (1000 * bag[w] + 8 * m))
                for w in words
                if bag[w]
            )
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        rows += [(item, rank, d, -score) for rank, (score, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return rows


def words(rng, least, most):
    vocabulary = ["a", "B", "é", "x1", "Zz", "wordy", *[f"w{k}" for k in range(60)]]
    share = 1 / np.arange(1, len(vocabulary) + 1)
    return " ".join(rng.choice(vocabulary, rng.integers(least, most), p=share / share.sum()).tolist())


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 150, "block_terms": 8}, {"k": 3}])
def test_against_brute_force(spark, sizes):
    rng = np.random.default_rng(7)
    docs = [(k, words(rng, 0, 40)) for k in range(150)]
    docs += [(500, None), (501, ""), (502, "..."), (None, "a w3 w5"), (None, "a w3 w5"), (7, "w9 w9 zz"), (503, "a w3, W5! " * 900)]
    docs += [(600 + k, "copies of w7 and x1") for k in range(40)]
    items = [(k, words(rng, 0, 12)) for k in range(15)]
    items += [(None, "w1"), (None, "w2 w1"), (3, "w20"), (90, None), (91, "--"), (92, "nowhere to be found"), (93, "w7"), (94, "a a a")]
    frame = spark.createDataFrame([(d, t, 1, "y") for d, t in docs], "doc_id long, text string, rank int, query string").repartition(4)
    bench = spark.createDataFrame([(k, t, 5) for k, t in items], "item_id long, text string, score int")
    got = [tuple(r) for r in s.ranked(frame, bench, **sizes).collect()]
    assert key(got) == key(brute(docs, items, sizes.get("k", 10)))


def test_empty_tables_and_text_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "z")], "name string, body string")
    items = spark.createDataFrame([("q", "X")], "item_id string, text string")
    got = s.ranked(docs, items, id_col="name", text_col="body").collect()
    assert [(r.item_id, r["rank"], r.name) for r in got] == [("q", 1, "a"), ("q", 2, "b")]
    assert s.ranked(docs.limit(0), items, id_col="name", text_col="body").count() == 0
    assert s.ranked(docs, items.limit(0), id_col="name", text_col="body").count() == 0


def test_accumulators_are_limited_and_survivors_exact():
    rng = np.random.default_rng(11)
    size, limited = 400, 0
    for _ in range(60):
        lists = []
        for share, most in ((0.03, 9000), (0.1, 3000), (0.5, 400), (0.9, 60), (1.0, 9)):
            places = np.flatnonzero(rng.random(size) < share)
            lists.append((places, rng.integers(1, most, len(places))))
        full = np.zeros(size, np.int64)
        for places, more in lists:
            full[places] += more
        found = s.search_shard(lists, size, k=5)
        limited += found.created < np.count_nonzero(full)
        least = np.sort(full)[-5]
        assert (found.scores[full >= least] == full[full >= least]).all()
        kept = found.scores > 0
        assert (found.scores[kept] == full[kept]).all()
        assert not s.search_shard(lists, size, 5, floor=10**9).scores.any()
    assert limited > 50
