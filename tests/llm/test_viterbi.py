import numpy as np
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from shelfcount.llm import viterbi as v

from ..conftest import SMALL

EDGES = ["", " ", "  a", "a  b ", "日本語 テキスト", "😀😀 x😀", "\n\n\t x", "<0x41> <unk> <s>", "▁▁x ▁y", "a" * 3000, "\u0000\u0001", "é", "é è" * 50]


def reference(vocabulary, with_bytes):
    t = Tokenizer(models.Unigram(vocabulary, 0, with_bytes))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=v.MARK, prepend_scheme="always", split=True)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def count(counter, text):
    return sum(counter.chunk(c)[0] for c in v.chunks(text))


def test_file_vocabulary_against_the_tokenizer():
    vocabulary = v.read_vocabulary()
    want, counter = reference(vocabulary, True), v.Counter(vocabulary)
    for text in EDGES:
        assert count(counter, text) == want(text), text


@pytest.mark.parametrize("seed", range(6))
def test_ties_and_unknown_runs_against_the_tokenizer(seed):
    rng = np.random.default_rng(seed)
    letters = list("abcé▁")
    pieces = {"".join(rng.choice(letters, rng.integers(1, 4)).tolist()) for _ in range(14)}
    vocabulary = [("<unk>", 0.0), *[(x, float(-rng.integers(1, 4))) for x in sorted(pieces)]]
    want, counter = reference(vocabulary, False), v.Counter(vocabulary)
    for _ in range(300):
        text = "".join(rng.choice(list("abcé dx"), rng.integers(0, 14)).tolist())
        assert count(counter, text) == want(text), (text, vocabulary)


def test_table(spark):
    vocabulary = v.read_vocabulary()
    want = reference(vocabulary, True)
    docs = spark.createDataFrame([(k, t, "old") for k, t in enumerate([*EDGES, None, "a b", "a b"])], "doc_id long, text string, tokens string")
    got = {r.doc_id: r.tokens for r in v.token_counts(docs, vocabulary).collect()}
    assert [got[k].n_tokens for k in range(len(EDGES))] == [want(t) for t in EDGES]
    assert (got[len(EDGES)].n_tokens, got[len(EDGES)].score) == (0, 0.0)
    assert v.token_digest(docs.limit(0)).count() == 0


def test_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = reference(v.read_vocabulary(), True)
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.n_tokens == want(text[r.doc_id]) for r in v.token_digest(docs).collect())
