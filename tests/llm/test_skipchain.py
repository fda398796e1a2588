import hashlib
import itertools
import re

import numpy as np
import pandas as pd

from shelfcount.llm import skipchain as k

from ..conftest import SMALL

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = digits(m)
        doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))]
        if 14 <= len(d) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_patterns_against_plain_regexes():
    rng = np.random.default_rng(3)
    parts = ["a@b.c", "@", "x.y%+z@q-1.com.", "..", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (319) 555-5132", "+1 2", " ", "\n", "é", "0", "007", "+12345678901234567", "word", "a@b", "a@b.c@d.e", "5", "-", "0000000000000000"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(1, 9)).tolist())
        assert k.base_spans(text) == brute(text), text
    long = "a" * 200_000 + "1" * 200_000 + "." * 1000
    assert k.base_spans(long) == []


def test_message_passing_is_exact_on_trees():
    rng = np.random.default_rng(4)
    field = k.Field(pd.DataFrame([("s", "a", 1, 5), ("s", "b", 0, 9), ("c", "1", 1, 9), ("c", "0", 0, 4), ("k", "1", 1, 3)], columns=["sort", "key", "label", "n"]))
    g = k.Graph([])
    g.span, g.doc, g.label = [(0, 1)] * 5, [0] * 5, [0, 0, 1, 0, 0]
    g.shape = ["a", "b", "a", "c", "b"]
    g.chain, g.skip = [(0, 1), (1, 2)], [(1, 3), (3, 4)]
    own = field.potentials(g) + rng.normal(size=(5, 5))
    field.potentials = lambda _: own
    joint = np.zeros((5, 5))
    for y in itertools.product(range(5), repeat=5):
        value = sum(own[n, y[n]] for n in range(5))
        value += sum(field.link[s][y[a], y[b]] for s, links in (("c", g.chain), ("k", g.skip)) for a, b in links)
        for n in range(5):
            joint[n, y[n]] += np.exp(value)
    joint /= joint.sum(axis=1, keepdims=True)
    k.ROUNDS, rounds = 80, k.ROUNDS
    label, chance = field.labels(g)
    k.ROUNDS = rounds
    assert label.tolist() == joint.argmax(axis=1).tolist()
    assert np.allclose(chance, joint.max(axis=1), atol=1e-4)


def test_repeats_get_the_same_label(spark):
    plain = [(n, f"word number{n} token{n * 7919 % 1000}x and more ab{n}", "x") for n in range(200)]
    known = [(1000 + n, f"call +1 (3{n:02d}) 555-51{n:02d} or mail me{n}@host.org today", "x") for n in range(40)]
    far = "call +1 (319) 555-5132 now. " + "some words here " * 50 + "again 319-555-5132 later"
    docs = spark.createDataFrame([*plain, *known, (5000, far, "x"), (5001, "only 319-555-5132 here", "x"), (None, None, "x"), (5002, "", "x")], "doc_id long, text string, personal string")
    field = k.Field(k.counted(docs))
    got = {r.doc_id: r.personal for r in k.find_personal_data(docs, field).collect()}
    base = [tuple(s) for s in got[5000].base]
    more = [tuple(s) for s in got[5000].spans if tuple(s) not in base]
    assert [far[a:b] for a, b, _ in base] == ["+1 (319) 555-5132"]
    assert [(far[a:b], c) for a, b, c in more] == [("319-555-5132", 3)]
    assert got[5001].spans == [] and got[None].spans == [] and got[5002].base == []
    assert all(not got[n].spans for n in range(200))


def test_digest(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in k.personal_digest(docs).collect()}
    data = docs.collect()
    assert len(rows) == len(data)
    for d in data:
        base = brute(d.text)
        r = rows[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == n for s in base) for n in range(4)]
        line = ",".join(f"{k.KINDS[n]}:{a}:{b}" for a, b, n in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))
    assert k.personal_digest(docs.limit(0)).count() == 0


def test_keys_beyond_those_sent_count(spark):
    rows = [(n, f"word number{n} token{n * 7919 % 1000}x and more ab{n}") for n in range(200)]
    rows += [(1000 + n, f"call +1 (3{n:02d}) 555-51{n:02d} or mail me{n}@host.org today") for n in range(40)]
    far = "call +1 (319) 555-5132 now. " + "some words here " * 50 + "again 319-555-5132 later"
    docs = spark.createDataFrame([*rows, (None, None), (500, ""), (5000, far), (5001, "only 319-555-5132 here")], "doc_id long, text string")
    whole = k.Field(k.counted(docs))
    few = k.Field(k.counted(docs, kept=3))
    assert max(len(few.tables[s]) for s in "sba") == 3 < min(len(whole.tables[s]) for s in "sba")
    assert np.allclose(few.prior, whole.prior) and whole.rest is None
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    want, got = (sorted(k.find_personal_data(docs, f).collect(), key=key) for f in (whole, few))
    assert got == want and any(len(r.personal.spans) > len(r.personal.base) for r in want)
