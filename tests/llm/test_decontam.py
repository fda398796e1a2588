import re

import numpy as np
import pytest

from shelfcount.llm import decontam as d

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            for k in range(max(1, len(v) - window + 1)) if v else ():
                g = v[k : k + window]
                for at in range(len(w) - len(g) + 1):
                    if w[at : at + len(g)] == g:
                        hit.update(range(at, at + len(g)))
                        if item is not None:
                            found.add(item)
        out.append((len(w), len(hit), sorted(found)))
    return out


def test_suffix_array_and_index():
    rng = np.random.default_rng(1)
    for size, symbols in ((1, 1), (2, 2), (200, 2), (500, 7), (300, 300)):
        codes = rng.integers(0, symbols, size)
        codes[-1] = 0
        raw = codes.tolist()
        order = d.suffix_array(codes, symbols)
        assert order.tolist() == sorted(range(size), key=lambda k: raw[k:])
        index = d.FMIndex(codes, symbols, sample=4)
        for length in (1, 2, 3):
            phrases = rng.integers(0, symbols, (20, length))
            low, high = index.search(phrases)
            for p, a, b in zip(phrases.tolist(), low, high):
                want = [k for k in range(size - length + 1) if raw[k : k + length] == p]
                assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


@pytest.mark.parametrize("window", [2, 3])
@pytest.mark.parametrize("shard", [1, 60, 1 << 20])
def test_against_brute_force(spark, window, shard):
    rng = np.random.default_rng(window)
    vocabulary = ["a", "B", "é", "x1", "Zz", "wordy"]
    docs = [" ".join(rng.choice(vocabulary, rng.integers(0, 30)).tolist()) for _ in range(60)]
    docs += [None, "", "...", "A,b;É", "a b é x1 " * 400, docs[3], docs[3]]
    items = [(k, " ".join(rng.choice(vocabulary, rng.integers(0, 7)).tolist())) for k in range(12)]
    items += [(None, "zz zz a"), (5, "x1 x1 b"), (77, None), (78, "- -"), (10, "wordy wordy wordy b")]
    frame = spark.createDataFrame([(k, t, "x") for k, t in enumerate(docs)], "doc_id long, text string, n_words string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = d.find_leaks(frame, bench, window=window, shard_bytes=shard, block_phrases=9)
    assert found.columns == ["doc_id", "text", "n_words", "__leaks"]
    got = {r.doc_id: (r["__leaks"].n_words, sum(b - a for a, b in r["__leaks"].spans), list(r["__leaks"]["items"])) for r in found.collect()}
    want = brute(docs, items, window)
    assert [got[k] for k in range(len(docs))] == want


def test_digest_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    rows = d.leak_digest(d.find_leaks(docs, none)).collect()
    assert sorted((r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows) == [(0, 0, 0, False), (2, 0, 0, False)]
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert d.leak_digest(d.find_leaks(docs.limit(0), items)).count() == 0


def test_removal(spark):
    docs = spark.createDataFrame(
        [(1, "Keep this. ONE two, three! and that", "en", 35), (2, "one TWO three", "en", 13), (3, "clean é text", None, None), (4, None, "en", 0)],
        "doc_id long, text string, lang string, n_chars long",
    )
    bench = spark.createDataFrame([(1, "One two three")], "item_id long, text string")
    rows = {r.doc_id: r for r in d.remove_leaks(docs, bench).collect()}
    assert set(rows) == {1, 3, 4}
    assert rows[1].text == "Keep this. ! and that" and rows[1].n_chars == 21
    assert rows[3].text == "clean é text" and rows[4].text is None


def test_columns_of_an_earlier_search(spark):
    docs = spark.createDataFrame([(1, "one two three", "text"), (2, "four", None)], "doc_id long, text string, __leaks string")
    first = spark.createDataFrame([(1, "one two"), (2, "two three"), (3, "five")], "item_id long, text string")
    second = spark.createDataFrame([(9, "four"), (8, "six")], "item_id long, text string")
    for block in (1, 100):
        found = d.find_leaks(docs, first, window=2, block_phrases=block)
        assert {r.doc_id: list(r["__leaks"]["items"]) for r in found.collect()} == {1: [1, 2], 2: []}
        again = d.find_leaks(found, second, window=2, block_phrases=block)
        assert {r.doc_id: list(r["__leaks"]["items"]) for r in again.collect()} == {1: [], 2: [9]}
        assert again.columns == ["doc_id", "text", "__leaks"]
        kept = d.remove_leaks(docs, second, window=2, block_phrases=block)
        assert [tuple(r) for r in kept.collect()] == [(1, "one two three", "text")]
        assert sorted(r.n_items for r in d.leak_report(docs, second, window=2, block_phrases=block).collect()) == [0, 1]
