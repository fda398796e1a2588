import hashlib
from collections import Counter

import numpy as np
import pytest

from shelfcount.llm import pair_bitmaps as p

from ..conftest import SMALL

EDGES = [
    None, "", " ", "  ", "a", "a ", " a", "  a  b   ", "\n", "a\n b", "a\n\n  b \n", "a  b", "a　 b  c", "été  à la  ", "x▁y", "▁",
    "<|endoftext|> <s> </s><unk> <0x41>", "日本語 テキスト。 ok", "😀 😀😀", "\x00\x01 \x7f x", "it's we'll I'VE 're", "123 4567, 89.0!?", "tab\t tab \r\n end",
    "é" * 300 + " " * 40 + "z" * 500, "﻿z ﬁ é́", "\x1c \x85   x", "a" * 5000, " the the the " * 300,
]


@pytest.fixture(scope="module")
def pair():
    return p.Pair(p.Vocabularies.read())


def brute(pair, texts):
    """Whole texts, all pairs of token ends, plain counters."""
    found = []
    for text in texts:
        whole = (" " + text).encode() if text else b""
        a = pair.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pair.b.encode(text) if text else []
        bytes_a, bytes_b = [pair.a_bytes[k] for k in a], [pair.b_bytes[k] for k in b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            a, b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links = [(x, y) for x, e in zip(a, ends_a) for y in [b[ends_b.index(e)] if e in ends_b else None] if y is not None]
        groups, now_a, now_b, j = [], [], [], 0
        for x, e in zip(a, ends_a):
            now_a.append(str(x))
            while j < len(b) and ends_b[j] <= e:
                now_b.append(str(b[j]))
                j += 1
            if e in ends_b:
                groups.append(",".join(now_a) + "|" + ",".join(now_b))
                now_a, now_b = [], []
        found.append((len(a), len(b), links, groups))
    count = Counter(x for f in found for x in f[2])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    rows = []
    for n_a, n_b, links, groups in found:
        best = sum(count[x] == top[x[1]] for x in links)
        rows.append((n_a, n_b, len(groups), len(links), best, sum(count[x] for x in links), ";".join(groups)))
    return rows, count, Counter(x for f in found for x in set(f[2]))


def values(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups


def test_bitmaps():
    rng = np.random.default_rng(3)
    for size in (1, 7, 16, 17, 300, 16384):
        for share in (0.001, 0.05, 0.07, 0.5, 1.0):
            slots = np.flatnonzero(rng.random(size) < share)
            other = np.flatnonzero(rng.random(size) < 0.02)
            one, two = p.packed(slots), p.packed(other)
            assert p.unpacked(one).tolist() == slots.tolist() and p.popcount(one) == len(slots)
            assert p.unpacked(p.or_merged([one, two])).tolist() == sorted({*slots.tolist(), *other.tolist()})
            if len(slots):
                counts = rng.integers(1, 40, len(slots))
                planes = p.planes_of(slots, counts)
                assert sum(p.popcount(x) << k for k, x in enumerate(planes)) == counts.sum()
                assert p.popcount(p.or_merged(planes)) == len(slots)


def test_segments_equal_whole_texts(pair):
    rng = np.random.default_rng(5)
    signs = list("ab Z\n\t é 　,'1日") + ["  ", "'s", "the", "▁", " ", "\x85", "\x1f"]
    texts = ["".join(rng.choice(signs, rng.integers(1, 25)).tolist()) for _ in range(4000)] + [t for t in EDGES if t]
    per_text, segments = p.segments_of([t.encode() for t in texts])
    parts, at = segments.to_pylist(), 0
    for text, n in zip(texts, per_text.tolist()):
        own, at = parts[at : at + n], at + n
        assert b"".join(own) == (" " + text).encode()
        a, b = pair.encode(own)
        assert sum(a, []) == pair.a.encode(" " + text, add_special_tokens=False).ids, repr(text)
        if "▁" not in text:
            assert sum(b, []) == pair.b.encode(text), repr(text)


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 200, "chunk_bytes": 500, "slots": 3}])
def test_against_brute_force(spark, pair, monkeypatch, sizes):
    texts = [*EDGES, "the cat sat", "the cat sat", "the  cat\nsat on", *["copy of one text"] * 40]
    docs = spark.createDataFrame([(k, t, "x", 9) for k, t in enumerate(texts)], "doc_id long, text string, chunk string, n_a int").repartition(3)
    want, links, holders = brute(pair, texts)
    got = {r.doc_id: values(r) for r in p.aligned(docs, **sizes).collect()}
    assert [got[k] for k in range(len(texts))] == want
    counts = p.pair_counts(p.build_index(docs, **sizes)).collect()
    assert {(r.a, r.b): (r.n_links, r.n_docs) for r in counts} == {k: (n, holders[k]) for k, n in links.items()}


def test_ids_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), ("7", None)], "name string, body string")
    rows = p.aligned(docs, "name", "body").collect()
    assert sorted((r.name or "", r.n_links, r.n_best, r.count_sum) for r in rows) == [("", 2, 2, 4), ("", 2, 2, 4), ("7", 0, 0, 0)]
    assert p.aligned(docs.limit(0), "name", "body").count() == 0
    assert p.aligned(docs.where("body IS NULL"), "name", "body").collect()[0].groups == ""


def test_forgetting(spark, pair, monkeypatch):
    monkeypatch.setattr(p, "REMEMBERED", 3)
    known = p.Known(pair)
    for texts in (["a b c d e"], ["e f a"], ["x", "a b"]):
        columns, _, _ = p._shard([t.encode() for t in texts], known)
        assert [columns["groups"][k] for k in range(len(texts))] == [r[6] for r in brute(pair, texts)[0]]


def test_documents(spark, pair):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want, _, _ = brute(pair, [r.text for r in rows])
    got = {r.doc_id: r for r in p.alignment_digest(docs).collect()}
    for r, w in zip(rows, want):
        g = got[r.doc_id]
        assert (g.n_a, g.n_b, g.n_groups, g.n_links, g.n_best, g.count_sum) == w[:6]
        assert g.groups_sha256 == (hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "")
