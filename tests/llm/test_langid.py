import math
from collections import Counter

from shelfcount.llm import langid as g

from ..conftest import SMALL


def brute(rows, texts, kept=10**9):
    """The same scores, word by word and without packing."""
    langs = sorted({lang for lang, _ in rows})
    counts = {(lang, n): Counter() for lang in langs for n in range(g.LONGEST + 1)}
    for lang, text in rows:
        for w in g.language_words(text):
            w = w.decode()
            counts[lang, 0][w] += 1
            for n in range(1, g.LONGEST + 1):
                for k in range(len(w) + 3 - n):
                    if (x := f" {w} "[k : k + n]) != " ":
                        counts[lang, n][x] += 1
    value = {}
    for key, c in counts.items():
        total = sum(c.values())
        value[key] = {e: min(-math.log10(n / total), g.PENALTY) for e, n in c.items()}

    def word(w):
        if any(w in value[lang, 0] for lang in langs):
            return [value[lang, 0].get(w, g.PENALTY) for lang in langs]
        for n in range(g.LONGEST, 0, -1):
            grams = [f" {w} "[k : k + n] for k in range(len(w) + 3 - n)]
            known = [x for x in grams if any(x in value[lang, n] for lang in langs)]
            if known:
                return [sum(value[lang, n].get(x, g.PENALTY) for x in known) / len(known) for lang in langs]
        return [g.PENALTY] * len(langs)

    out = []
    for text in texts:
        if not text or not g.has_letter(text) or not langs:
            out.append(("und", 0.0))
            continue
        scores = [word(w.decode()) for w in g.language_words(text)]
        means = [sum(s[k] for s in scores) / len(scores) for k in range(len(langs))]
        best = min(range(len(langs)), key=lambda k: (means[k], k))
        out.append((langs[best], 1 / sum(10 ** (means[best] - m) for m in means)))
    return out


TRAIN = [("en", "the cat and the dog"), ("en", "a thing of the sea"), ("de", "die Katze und der Hund"), ("de", "das Ding über See"), ("fr", "le chat et la mer"), ("fr", "ça été où")]
TEXTS = ["the dog", "Über die See", "chatte à été", "thingummy", "кот", "zzz qq", "", None, "123 !?", "12a", "the the the кот é", "die le the", "x" * 5000]


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(TRAIN)] + [(50, None, "en"), (51, "nothing", None)], "doc_id long, text string, lang string")
    model = g.fit(docs)
    langs, shares = model.predict(TEXTS)
    want = brute(TRAIN, TEXTS)
    assert langs == [w for w, _ in want]
    assert all(abs(a - b) < 1e-9 for a, (_, b) in zip(shares, want))
    frame = spark.createDataFrame([(k, t, "q") for k, t in enumerate(TEXTS)], "doc_id long, text string, score string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in g.identify(frame, model).collect()}
    assert [got[k][0] for k in range(len(TEXTS))] == langs


def test_sample_is_bounded_and_models_may_be_empty(spark):
    docs = spark.createDataFrame([(k, "ab" + "c" * k, "en") for k in range(40)], "doc_id long, text string, lang string")
    assert len(g.fit(docs, sample_rows=5).words) == 5
    assert len(g.fit(docs, kept=7).words) == 7
    empty = g.fit(docs.limit(0))
    assert empty.predict(["a b", None]) == (["und", "und"], [0.0, 0.0])
    assert g.language_digest(docs.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = g.language_digest(docs).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert held and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_many_scripts_and_every_entry(spark):
    """Texts of 6000 distinct characters: no character or entry is left out."""
    letters = [c for c in map(chr, range(0x3400, 0x9FFF)) if c.isalpha()][:6000]
    rows = [("en" if k % 2 else "zh", " ".join("".join(letters[(7 * k + j) % 6000] for j in range(i, i + 4)) for i in range(0, 40, 4))) for k in range(900)]
    docs = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = g.fit(docs)
    used = {c for _, t in rows for c in t if c != " "}
    assert len(used) > 5500 and len(model.keys[0]) == len(used)
    assert len(model.words) == len({w for _, t in rows for w in t.split()})
    texts = ["".join(reversed(t)) for _, t in rows[::50]] + [t for _, t in rows[::90]]
    langs, shares = model.predict(texts)
    want = brute(rows, texts)
    assert langs == [w for w, _ in want] and all(abs(a - b) < 1e-9 for a, (_, b) in zip(shares, want))


def test_model_holds_the_whole_sample(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = g.training_rows(docs).where("lang IS NOT NULL").collect()
    model = g.fit(g.training_rows(docs))
    assert set(model.words) == {w for r in rows for w in g.language_words(r.text)}
    padded = {f" {w.decode()} " for w in model.words}
    for n, keys in enumerate(model.keys, 1):
        assert len(keys) == len({w[k : k + n] for w in padded for k in range(len(w) - n + 1)} - {" "})
