"""Token counts under a unigram vocabulary, without building the tokens.

A text is cut at spaces into chunks, each with the space mark in front. Within a chunk an
Aho-Corasick automaton lists every vocabulary piece that ends at each character, longest first, and
dynamic programming carries the best score and the number of pieces up to there. As in the
tokenizer, a later candidate wins only with a strictly better score, so of equally good ways the one
whose last piece starts earliest stays; a character that is no piece by itself may be unknown, at
the lowest score less ten; an unknown character counts as the pieces of its bytes.

No piece crosses a chunk's start, so a text's count is the sum over its chunks, and each distinct
chunk of a shard is worked out once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import batch, by_shard

#: Vocabulary of scored pieces; the file of the public tokenizers that lists scores.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
SHARD_BYTES = 8 << 20

_BYTE = re.compile("<0x[0-9A-F]{2}>")
COUNTS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_unknown", T.LongType()), T.StructField("score", T.DoubleType())])


def read_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, score) by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())]


@dataclass
class Counter:
    """Best score, pieces and unknown characters of a chunk."""

    vocabulary: list[tuple[str, float]]
    _automaton: object = field(default=None, repr=False)

    def __post_init__(self) -> None:
        self.scores: dict[str, float] = {}
        for piece, score in self.vocabulary:
            if piece:
                self.scores[piece] = score
        self.unknown = min((s for _, s in self.vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.bytes = sum(1 for p, _ in self.vocabulary if _BYTE.fullmatch(p)) == 256
        self._automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self._automaton.add_word(piece, (len(piece), score))
        if self.scores:
            self._automaton.make_automaton()

    def chunk(self, text: str) -> tuple[int, int, float]:
        """(tokens, unknown characters, score) of the best way to cut ``text`` into pieces."""
        n = len(text)
        best: list[float] = [0.0] * (n + 1)
        count, unknown = [0] * (n + 1), [0] * (n + 1)
        done, open_run = 0, [False] * (n + 1)
        scores = self.scores

        def strange(end: int, score: float | None) -> None:
            """The character before ``end`` as an unknown one, if no better way ends there."""
            if text[end - 1] not in scores:
                at = best[end - 1] + self.unknown
                if score is None or at > score:
                    best[end] = at
                    run = open_run[end - 1] and not self.bytes
                    size = len(text[end - 1].encode("utf-8", "surrogatepass")) if self.bytes else 0 if run else 1
                    count[end], unknown[end], open_run[end] = count[end - 1] + size, unknown[end - 1] + 1, True

        found = self._automaton.iter(text) if scores else ()
        here: float | None = None
        end = 0
        for last, (length, score) in found:
            if last + 1 != end:
                # All candidates that end at ``end`` are seen; characters between have none.
                if end > done:
                    strange(end, here)
                    done = end
                for between in range(done + 1, last + 1):
                    strange(between, None)
                done, end, here = last, last + 1, None
            start = end - length
            at = best[start] + score
            if here is None or at > here:
                best[end] = here = at
                count[end], unknown[end], open_run[end] = count[start] + 1, unknown[start], False
        if end > done:
            strange(end, here)
            done = end
        for between in range(done + 1, n + 1):
            strange(between, None)
        return count[n], unknown[n], best[n]


def chunks(text: str) -> list[str]:
    """The text cut before every space, a mark in place of each space and one in front."""
    if not text:
        return []
    marked = text.replace(" ", MARK)
    if not marked.startswith(MARK):
        marked = MARK + marked
    return [MARK + part for part in marked.split(MARK)[1:]]


def token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]], text_col: str = "text", name: str = "tokens") -> DataFrame:
    """All rows and columns of ``docs`` plus the struct ``name``: n_tokens, n_unknown, score.

    Null and empty texts have no token and score 0. With no bytes among the pieces, a run of unknown
    characters is one token. Repeated rows are counted one by one. A column of that name is replaced.
    """
    schema = T.StructType([f for f in docs.schema.fields if f.name != name] + [T.StructField(name, COUNTS)])
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    held: list[Counter] = []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Counter(sent.value))
        for rows in by_shard(batches, text_col, SHARD_BYTES):
            texts = [chunks(t or "") for t in rows.column(text_col).to_pylist()]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            flat = [c for t in texts for c in t]
            codes, distinct = pd.factorize(np.fromiter(flat, object, len(flat)))
            each = np.array([held[0].chunk(c) for c in distinct], np.float64).reshape(-1, 3)
            owner = np.repeat(np.arange(len(texts)), sizes)
            sums = [np.bincount(owner, each[codes, k], len(texts)) for k in range(3)]
            found = pa.StructArray.from_arrays(
                [pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)), pa.array(sums[2])], COUNTS.names
            )
            columns = {f.name: rows.column(f.name) for f in schema.fields if f.name != name}
            yield batch(columns | {name: found}, schema)

    return docs.mapInArrow(work, schema)


def token_digest(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Per row of documents: n_tokens, n_unknown (characters) and the best score."""
    counted = token_counts(docs.select("doc_id", "text"), read_vocabulary(path))
    return counted.select("doc_id", "tokens.n_tokens", "tokens.n_unknown", "tokens.score")
