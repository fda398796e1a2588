"""The pipeline against brute-force versions of its stages, one after the other."""

import math
from collections import Counter

import pytest

import corpus_pipeline
from shelfcount.llm import decontam, langid

from ..conftest import SMALL
from . import test_decontam, test_poisson_mix, test_simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def deduped(rows):
    prints = [test_simhash.fingerprint(r["text"]) for r in rows]
    best: dict = {}
    for r, g in zip(rows, test_simhash.roots(prints, 3)):
        if g not in best or r["doc_id"] < best[g]["doc_id"]:
            best[g] = r
    return sorted(best.values(), key=lambda r: r["doc_id"])


def cleaned(rows, items):
    out = []
    phrases = [test_decontam.words(t)[k : k + 10] for _, t in items for k in range(max(1, len(test_decontam.words(t)) - 9))]
    by_first: dict = {}
    for p in phrases:
        if p:
            by_first.setdefault(p[0], []).append(p)
    for r in rows:
        w, hit = test_decontam.words(r["text"]), set()
        for at, first in enumerate(w):
            for p in by_first.get(first, ()):
                if w[at : at + len(p)] == p:
                    hit.update(range(at, at + len(p)))
        if not hit:
            out.append(r)
        elif len(hit) < len(w):
            spans = [[k, k + 1] for k in sorted(hit)]
            text = decontam.cut_spans(r["text"].encode(), decontam._merge(spans))
            out.append(r | {"text": text, "n_chars": len(text)})
    return out


def mixed(rows):
    size: Counter = Counter()
    for r in rows:
        size[r["source"]] += len(r["text"].encode()) + 1
    weight = {s: math.sqrt(n) for s, n in size.items()}
    rate = {s: weight[s] / sum(weight.values()) * sum(size.values()) / size[s] for s in size}
    out = []
    for r in rows:
        out += [r] * test_poisson_mix.inverse(rate[r["source"]], test_poisson_mix.drawn(42, "count", r["doc_id"], r["source"]))
    return out


def test_every_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    model = langid.fit(langid.training_rows(docs))
    rows = sorted((r.asDict() for r in docs.collect()), key=lambda r: r["doc_id"])
    langs, shares = model.predict([r["text"] for r in rows])
    want = [r for r, lang, s in zip(rows, langs, shares) if lang != "und" and s >= corpus_pipeline.MIN_SCORE]
    assert len(want) > 0.95 * len(rows)
    got = docs
    for (name, stage), brute in zip(corpus_pipeline.STAGES[:4], (None, deduped, lambda r: cleaned(r, items), mixed)):
        if brute:
            want = brute(want)
        out = stage(spark, got, SMALL)
        assert out.columns == COLUMNS
        found = sorted((r.asDict() for r in out.collect()), key=lambda r: r["doc_id"])
        assert found == sorted(want, key=lambda r: r["doc_id"]), name
        got = spark.createDataFrame(out.collect(), out.schema)
    last = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.text) for r in last) == sorted((r["doc_id"], r["text"]) for r in want)
    sizes = Counter(r.shard for r in last)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(16))
    assert sorted((r.shard, r.slot) for r in last) == [(s, k) for s in range(16) for k in range(sizes[s])]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows_and_empty_tables(spark, name, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard string, score int"
    rows = [(1, "the and of to", "en", "a", 13, "x", 1)] * 3 + [(None, None, None, None, None, None, None), (2, "", "en", None, 0, "y", 2), (2, "the cat " * 3000, None, "a", 24000, "y", 3)]
    out = stage(spark, spark.createDataFrame(rows, schema), SMALL)
    first = schema.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert out.columns == (first if name != "sharding" else ["doc_id", "text", "lang", "source", "n_chars", "score", "shard", "slot"])
    assert out.count() >= 1
    empty = stage(spark, spark.createDataFrame([], schema), SMALL)
    assert empty.count() == 0


def test_clean_documents_of_ten_languages_stay(spark):
    import random

    rng = random.Random(6)
    # Three groups of three languages that are alike, and one by itself.
    words = [["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(60)] for _ in range(4)]
    rows = [(k, " ".join(rng.choices(words[k % 10 // 3], k=30)), f"l{k % 10}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert corpus_pipeline.language_id(spark, docs, "").count() > 0.95 * len(rows)
