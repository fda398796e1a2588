import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from shelfcount.llm import ppm

from ..conftest import SMALL


def contexts_of(texts, order):
    """Counts of symbols by context, from a plain walk over the texts."""
    counts: dict = {}
    for t in texts:
        line = bytes([ppm.END]) * order + b" ".join(t) + bytes([ppm.END])
        for k in range(order, len(line)):
            for length in range(order + 1):
                counts.setdefault(line[k - length : k], Counter())[line[k]] += 1
    return counts


def brute(counts, text, order):
    """Escapes and exclusions step by step."""
    line = bytes([ppm.END]) * order + b" ".join(text) + bytes([ppm.END])
    total = 0.0
    for k in range(order, len(line)):
        excluded: set = set()
        left = 1.0
        for length in range(order, -1, -1):
            seen = {s: n for s, n in counts.get(line[k - length : k], {}).items() if s not in excluded}
            if not seen:
                continue
            whole = sum(seen.values())
            if line[k] in seen:
                left *= (seen[line[k]] - ppm.ESCAPE) / whole
                break
            left *= len(seen) * ppm.ESCAPE / whole
            excluded |= set(seen)
        else:
            left /= 256 - len(excluded)
        total += math.log10(left)
    return total


def rows_of(counts):
    return pd.DataFrame(
        [(len(c), int.from_bytes(c), s, n) for c, seen in counts.items() for s, n in seen.items()],
        columns=["length", "context", "symbol", "n"],
    )


TEXTS = ["the cat and the hat", "A b a B", "", None, "café au lait", "x " * 300, "the the the", "\t\n"]


def test_machine_against_brute_force():
    train = [ppm.tokens(None if t is None else t.encode()) for t in TEXTS[:5]]
    every = [ppm.tokens(None if t is None else t.encode()) for t in [*TEXTS, "unseen ÿ bytes", "hat cat"]]
    for order in (2, 3, 5):
        counts = contexts_of(train, order)
        machine = ppm.compiled(rows_of(counts), order)
        every_symbol = machine.log[:, machine.column].astype(float)
        assert every_symbol.shape[1] == 256 and np.allclose((10.0**every_symbol).sum(axis=1), 1, atol=1e-5)
        got = machine.score(every)
        # The compiled chances add up to one, also where nothing is left to escape to.
        want = [brute(counts, t, order) for t in every]
        assert np.allclose(got, want, rtol=1e-4, atol=1e-3)


def test_counts_and_trie(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    counts = ppm.training_counts(docs, 3)
    want = contexts_of([ppm.tokens(None if t is None else t.encode()) for t in TEXTS], 3)
    got = {(r.length, r.context, r.symbol): r.n for r in ppm.trie(counts, 3, 10**6).itertuples()}
    assert got == {(len(c), int.from_bytes(c), s): n for c, seen in want.items() for s, n in seen.items()}
    words = Counter(w for t in TEXTS for w in ppm.tokens((t or "").encode()))
    rows = counts.where("gram IS NULL").collect()
    assert {bytes(r.word): r.n for r in rows if r.word is not None} == dict(words)
    assert [r.n for r in rows if r.word is None] == [len(TEXTS)]
    few = ppm.trie(counts, 3, 12)
    kept = {(r.length, r.context) for r in few.itertuples()}
    assert 0 < len(kept) <= 13
    for length, c in kept:
        if length:
            assert (length - 1, c & ((1 << 8 * (length - 1)) - 1)) in kept and (length - 1, c >> 8) in kept


def base_scores(rows):
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10]
    c = Counter()
    for t in train:
        c.update([*ppm.tokens((t or "").encode()), None])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        own = [*ppm.tokens((t or "").encode()), None]
        out.append((i, i is not None and zlib.crc32(str(i).encode()) % 10 == 0, len(own), sum(w in c for w in own), n,
                    sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)))
    return out


def test_digest_against_brute_force(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS * 3)] + [(None, "no id here"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(i, t, 0.0) for i, t in rows], "doc_id long, text string, score double")
    for frequent in (1 << 18, 3):
        got = sorted((tuple(r)[:6] for r in ppm.scored(docs, frequent=frequent).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[5]))
        want = sorted(base_scores(rows), key=lambda r: (r[0] is None, r[0] or 0, r[5]))
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert np.allclose([g[5] for g in got], [w[5] for w in want])
    assert ppm.scored(docs.limit(0)).count() == 0
    alone = ppm.scored(spark.createDataFrame([(i, "abc") for i in range(200) if not zlib.crc32(str(i).encode()) % 10], "doc_id long, text string")).collect()
    assert all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and abs(r.base_score) < 1e-9 for r in alone)
    assert all(abs(r.score + 4 * math.log10(256)) < 1e-3 for r in alone)


def test_held_out_texts_are_predicted_better_than_by_tokens(spark):
    folder = SMALL.replace("0.001", "0.1")
    rows = [r for r in ppm.scored(spark.read.parquet(f"{folder}/documents.parquet")).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_contexts_beyond_the_cache_count(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcd e"), 40)) for _ in range(300)] + TEXTS
    rows = list(enumerate(texts)) + [(3, "again é"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = [ppm.tokens((t or "").encode()) for _, t in rows]
    train = [w for (i, _), w in zip(rows, lines) if i is None or zlib.crc32(str(i).encode()) % 10]
    for order in (2, 5):
        counts = contexts_of(train, order)
        want = sorted((-1 if i is None else i, brute(counts, w, order)) for (i, _), w in zip(rows, lines))
        for contexts, most_sent in ((0, 0), (0, 10**6), (12, 40), (300, 0), (300, 500), (10**6, 500)):
            scores = ppm.scored(docs, order=order, contexts=contexts, most_sent=most_sent)
            got = sorted((-1 if r.doc_id is None else r.doc_id, r.score) for r in scores.collect())
            assert [i for i, _ in got] == [i for i, _ in want]
            assert np.allclose([s for _, s in got], [s for _, s in want], rtol=1e-4, atol=1e-3)
