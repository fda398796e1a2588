import re

import numpy as np
import pytest

from shelfcount.llm import licenses as x
from shelfcount.llm.license_texts import NOTICES, PHRASES

from ..conftest import SMALL

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def phrase_places(text):
    """(start, label) of every phrase, by comparing at every word."""
    w = words(text)
    return sorted((k, label) for label, p in PHRASES for k in range(len(w)) if w[k : k + len(words(p))] == words(p))


def least_edits(text, wanted):
    """Fewest edits between any stretch of the text and the wording, cell by cell."""
    w, v = words(text), words(wanted)
    before = list(range(len(v) + 1))
    least = before[-1]
    for word in w:
        now = [0]
        for k, want in enumerate(v):
            now.append(min(before[k] + (word != want), before[k + 1] + 1, now[k] + 1))
        before = now
        least = min(least, now[-1])
    return least


def brute_best(text):
    """The best similarity over all wordings that are near enough, 0 if none is."""
    best = 1.0 if phrase_places(text) else 0.0
    for _, wording in NOTICES:
        n = len(words(wording))
        edits = least_edits(text, wording)
        if edits <= (0.2 * n + 1e-9 if n >= x.LONG else 0):
            best = max(best, 1 - edits / n)
    return best


def noise(rng, n):
    return " ".join(rng.choice(["the", "of", "software", "copyright", "notice", "in", "this", "permission", "é1", "is"], n).tolist())


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        at = int(rng.integers(0, len(w)))
        kind = rng.integers(0, 3)
        w[at : at + (kind != 0)] = [] if kind == 1 else ["changed"]
    return " ".join(w)


def sample(seed, n=40):
    rng = np.random.default_rng(seed)
    texts, holds = [], []
    for _ in range(n):
        label, wording = NOTICES[rng.integers(0, len(NOTICES))]
        n_words = len(words(wording))
        changes = int(rng.integers(0, n_words // 3 + 1)) if n_words >= x.LONG else 0
        texts.append(f"{noise(rng, rng.integers(0, 60))} {edited(rng, wording, changes)}\n{noise(rng, rng.integers(0, 60))}")
        holds.append((label, wording))
    return texts, holds


@pytest.mark.parametrize("shard", [1, 1 << 20])
def test_against_brute_force(spark, shard):
    texts, _ = sample(2)
    phrases = "Mit License, MIT license MIT LICENSE. cc-by cc by-nc; gnu General public\nlicense apache license "
    texts += [None, "", "--", "mit", "license mit", phrases, phrases * 30, texts[0], texts[0], "é mit é license", "Apache License"]
    texts += ["Licensed under CC BY-NC 4.0."] * 30 + [noise(np.random.default_rng(1), 3000) + " " + NOTICES[-1][1]]
    docs = spark.createDataFrame([(k, t, 1, "z", 2) for k, t in enumerate(texts)], "doc_id long, text string, h1 int, row string, n_words int")
    rows = {r.doc_id: r for r in x.find_licenses(docs.repartition(3), shard_bytes=shard).collect()}
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        r = rows[k]
        assert (r.text, r.h1, r.row, r.n_words) == (text, 1, "z", len(words(text)))
        assert sorted((s.first_word, s.label) for s in r.licenses if s.phrase) == phrase_places(text)
        assert max((s.score for s in r.licenses), default=0.0) == pytest.approx(brute_best(text)), text
        for s in r.licenses:
            stretch = " ".join(words(text)[s.first_word : s.after_word])
            assert s.phrase or any(
                label == s.label and 1 - least_edits(stretch, wording) / len(words(wording)) == pytest.approx(s.score)
                for label, wording in NOTICES
            )


def test_closest_wording_gives_the_label(spark):
    docs = spark.createDataFrame([(k, f"x y {wording} z") for k, (_, wording) in enumerate(NOTICES)], "doc_id long, text string")
    got = {r.doc_id: {s.label for s in r.licenses if not s.phrase and s.score == 1} for r in x.find_licenses(docs).collect()}
    assert [got[k] for k in range(len(NOTICES))] == [{label} for label, _ in NOTICES]


def test_spans_of_one_template(spark):
    wanted = NOTICES[-2][1]
    half = wanted.split()
    text = f"a {wanted} b {' '.join(half[:9] + half[10:])} c {' '.join(half[:5] + ['put', 'in'] + half[5:])}"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = [(s.first_word, s.after_word, round(s.score * len(words(wanted)))) for s in x.find_licenses(docs).first().licenses]
    n = len(words(wanted))
    assert spans == [(1, 1 + n, n), (2 + n, 1 + 2 * n, n - 1), (2 + 2 * n, 4 + 3 * n, n - 2)]


def test_small_inputs(spark):
    docs = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    assert x.find_licenses(docs.limit(0)).count() == 0
    assert x.find_licenses(docs, []).first().licenses == []
    with pytest.raises(ValueError):
        x.template("one", "word")
    own = [x.template("home", "mit license", True)]
    assert [s.label for s in x.find_licenses(docs, own).first().licenses] == ["home"]


def test_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in x.license_digest(docs).collect():
        places = phrase_places(texts[r.doc_id])
        starts = [k for k, _ in places]
        assert (r.n_words, r.n_base) == (len(words(texts[r.doc_id])), len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(","))
        # No long template is near any of these texts, so the short ones decide.
        short = {label for label, w in NOTICES if len(words(w)) < x.LONG and f" {' '.join(words(w))} " in f" {' '.join(words(texts[r.doc_id]))} "}
        assert set(filter(None, r.labels.split(","))) == short | {label for _, label in places}
        assert r.score == (1.0 if places or short else 0.0)
