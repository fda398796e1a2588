"""Language identification by words first, backing off to ever shorter character n-grams.

A word that the model knows scores minus the decimal logarithm of its relative frequency in each
language, or a penalty in languages that lack it. A word that no language knows is scored by its
character n-grams, padded with a space on either side: by the longest length of which any n-gram
is known, as the mean over the known ones. A text scores the mean over its words; the language
with the lowest score is predicted.

The model is fitted on a bounded sample of labelled rows, counted by Spark. It holds every word and n-gram
of the sample, so what is sent to the tasks is bounded by the sample.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcount.session import durable

from .common import batch, by_shard, crc_share

#: Labelled rows per language that the model is fitted on.
SAMPLE_ROWS = 1000
#: Shares in which the sample of a language is chosen first.
SHARES = 8
LONGEST = 5
#: N-grams are looked up by 64-bit hashes; the first of these factors under which no two n-grams of a model clash is used.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
#: Score of an entry in a language that lacks it.
PENALTY = 7.0
UNKNOWN = "und"
SHARD_BYTES = 4 << 20

_SPACED = bytes(b if 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")


def language_words(text: str) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and characters beyond ASCII."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACED).split()


def has_letter(text: str) -> bool:
    """True if any character is a letter of some script."""
    return bool(_ASCII_LETTER.search(text)) or (not text.isascii() and any(map(str.isalpha, text)))


@dataclass
class Model:
    """Scores by entry and language; entries of one kind are rows of a matrix."""

    languages: list[str]
    words: dict[bytes, int]
    word_scores: np.ndarray
    factor: int
    keys: list[np.ndarray]
    scores: list[np.ndarray]

    def unseen(self, words: list[bytes]) -> np.ndarray:
        """Scores of words by their n-grams."""
        out = np.full((len(words), len(self.languages)), PENALTY)
        chars = np.frombuffer((b" " + b" ".join(words) + b" ").decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), "<u4")
        gap = chars == 0x20
        word = np.cumsum(gap) - 1  # a space counts as the start of the next word
        gaps = np.concatenate(([0], np.cumsum(gap)))
        waiting = np.ones(len(words), bool)
        for n in range(min(LONGEST, len(self.keys)), 0, -1):
            if len(chars) < n or not len(self.keys[n - 1]):
                continue
            count = len(chars) - n + 1
            key = gram_keys([chars[k : k + count] for k in range(n)], self.factor)
            # Inside one padded word: no space between the ends.
            inner = gaps[n - 1 : n - 1 + count] - gaps[1 : 1 + count] if n > 1 else np.where(gap, 1, 0)
            owner = word[:count]
            usable = np.flatnonzero((inner == 0) & (owner < len(words)))
            usable = usable[waiting[owner[usable]]]
            place = np.searchsorted(self.keys[n - 1], key[usable])
            hit = self.keys[n - 1][np.minimum(place, len(self.keys[n - 1]) - 1)] == key[usable]
            owner, place = owner[usable[hit]], place[hit]
            if not len(owner):
                continue
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            sizes = np.diff(np.append(first, len(owner)))
            out[owner[first]] = np.add.reduceat(self.scores[n - 1][place], first, axis=0) / sizes[:, None]
            waiting[owner[first]] = False
            if not waiting.any():
                break
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Predicted language and share of the score for every text."""
        langs, shares = [UNKNOWN] * len(texts), np.zeros(len(texts))
        words, counts = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text and self.languages and has_letter(text):
                own = language_words(text)
                counts[k] = len(own)
                words += own
        full = np.flatnonzero(counts)
        if not len(full):
            return langs, shares.tolist()
        codes, distinct = pd.factorize(np.fromiter(words, object, len(words)))
        known = np.fromiter((self.words.get(w, -1) for w in distinct), np.int64, len(distinct))
        table = np.empty((len(distinct), len(self.languages)))
        table[known >= 0] = self.word_scores[known[known >= 0]]
        lacking = np.flatnonzero(known < 0)
        if len(lacking):
            table[lacking] = self.unseen([distinct[k] for k in lacking])
        starts = (np.cumsum(counts) - counts)[full]
        means = np.add.reduceat(table[codes], starts, axis=0) / counts[full][:, None]
        best = means.argmin(axis=1)
        odds = 10.0 ** (means.min(axis=1, keepdims=True) - means)
        shares[full] = 1 / odds.sum(axis=1)
        for k, b in zip(full.tolist(), best.tolist()):
            langs[k] = self.languages[b]
        return langs, shares.tolist()


def gram_keys(chars: list[np.ndarray], factor: int) -> np.ndarray:
    """64-bit hashes of n-grams; ``chars`` are all first characters, all second ones and so on."""
    key = np.full(len(chars[0]), len(chars), np.uint64)
    for part in chars:
        key = (key ^ part.astype(np.uint64)) * np.uint64(factor)
        key ^= key >> np.uint64(31)
    return key


def _counts(text_col: str, lang_col: str):
    """Body that counts words (kind 0) and n-grams (kind n) per language over a task's rows."""
    schema = T.StructType(
        [
            T.StructField("lang", T.StringType()),
            T.StructField("kind", T.IntegerType()),
            T.StructField("entry", T.StringType()),
            T.StructField("n", T.LongType()),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_shard(batches, text_col, SHARD_BYTES):
            words: dict[str, Counter] = {}
            for lang, text in zip(rows.column(lang_col).to_pylist(), rows.column(text_col).to_pylist()):
                words.setdefault(lang, Counter()).update(language_words(text))
            out: list[tuple] = []
            for lang, own in words.items():
                grams: Counter = Counter()
                for raw, n in own.items():
                    word = raw.decode("utf-8", "replace")
                    out.append((lang, 0, word, n))
                    padded = f" {word} "
                    for size in range(1, LONGEST + 1):
                        for k in range(len(padded) - size + 1):
                            grams[padded[k : k + size]] += n
                out += [(lang, len(g), g, n) for g, n in grams.items() if g != " "]
            if out:
                yield batch(dict(zip(schema.names, zip(*out))), schema)

    return work, schema


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS, kept: int | None = None) -> Model:
    """A model of the labelled rows (text and language not null) of ``docs``.

    Per language the ``sample_rows`` rows with the smallest hash of the id are counted, ties by
    text hash. All their words and n-grams are kept, or with ``kept`` so many most frequent ones of
    each length, ties by the entry. Without labelled rows the model has no language.
    """
    labelled = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    rows = labelled.withColumn("h1", F.xxhash64("id")).withColumn("h2", F.xxhash64("text"))
    order = ("h1", "id", "h2")
    # First among a share of the rows, so that a language's last choice is among a bounded number.
    shares = Window.partitionBy("lang", "share").orderBy(*order)
    first = Window.partitionBy("lang").orderBy(*order)
    chosen = (
        rows.select("lang", *order, F.pmod("h1", F.lit(SHARES)).alias("share"))
        .withColumn("r", F.row_number().over(shares))
        .where(F.col("r") <= sample_rows)
        .withColumn("r", F.row_number().over(first))
        .where(F.col("r") <= sample_rows)
        .select("lang", "id", "h2")
        .distinct()
    )
    chosen = durable(chosen.select(F.col("lang").alias("l"), F.col("id").alias("i"), F.col("h2").alias("h")))
    # Written, so that Spark knows how few they are.
    keyed = rows.join(
        chosen,
        (F.col("lang") == F.col("l")) & F.col("id").eqNullSafe(F.col("i")) & (F.col("h2") == F.col("h")),
        "left_semi",
    )
    work, schema = _counts("text", "lang")
    sums = keyed.select("lang", "text").mapInArrow(work, schema).groupBy("lang", "kind", "entry").agg(F.sum("n").alias("n"))
    most = Window.partitionBy("lang", "kind").orderBy(F.col("n").desc(), "entry")
    total = F.sum("n").over(Window.partitionBy("lang", "kind"))
    top = sums.withColumn("total", total)
    if kept is not None:
        top = top.withColumn("r", F.row_number().over(most)).where(F.col("r") <= kept)
    found = top.select("lang", "kind", "entry", "n", "total").toArrow().to_pandas()
    return build(found)


def build(found: pd.DataFrame) -> Model:
    """The model of counts (lang, kind, entry, n, total)."""
    languages = sorted(found["lang"].unique().tolist())
    column = {lang: k for k, lang in enumerate(languages)}
    found = found.assign(score=-np.log10(found["n"].astype(float) / found["total"].astype(float)))

    def matrix(part: pd.DataFrame) -> tuple[list[str], np.ndarray]:
        entries = sorted(part["entry"].unique().tolist())
        row = {e: k for k, e in enumerate(entries)}
        scores = np.full((len(entries), len(languages)), PENALTY)
        scores[part["entry"].map(row).to_numpy(int), part["lang"].map(column).to_numpy(int)] = np.minimum(part["score"], PENALTY)
        return entries, scores

    entries, word_scores = matrix(found[found["kind"] == 0])
    tables = [matrix(found[found["kind"] == n]) for n in range(1, LONGEST + 1)]
    points = [
        np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, n).T for n, (grams, _) in enumerate(tables, 1)
    ]
    for factor in FACTORS:
        hashed = [gram_keys(list(p), factor) if p.size else np.zeros(0, np.uint64) for p in points]
        if all(len(np.unique(h)) == len(h) for h in hashed):
            break
    else:
        raise ValueError("n-grams clash under every factor")
    orders = [np.argsort(h) for h in hashed]
    keys = [h[o] for h, o in zip(hashed, orders)]
    scores = [table[o] for (_, table), o in zip(tables, orders)]
    return Model(languages, {e.encode(): k for k, e in enumerate(entries)}, word_scores, factor, keys, scores)


def identify(docs: DataFrame, model: Model, text_col: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` plus the predicted language and its share of the score (0 to 1).

    Null texts and texts without a letter are ``und`` with score 0, as is every text if the model
    has no language. Languages that tie go by name. A text of which nothing is known scores one
    over the number of languages. Columns named like the two new ones are replaced.
    """
    schema = T.StructType(
        [f for f in docs.schema.fields if f.name not in (pred, score)]
        + [T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())]
    )
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_shard(batches, text_col, SHARD_BYTES):
            langs, shares = sent.value.predict(rows.column(text_col).to_pylist())
            columns = {f.name: rows.column(f.name) for f in schema.fields if f.name not in (pred, score)}
            yield batch(columns | {pred: langs, score: shares}, schema)

    return docs.mapInArrow(work, schema)


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learned from: crc32 of the id modulo 4 is not 2. Rows without an id are not held out."""
    return docs.where(F.coalesce(crc_share(F.col(id_col), 4) != 2, F.lit(True)))


def language_digest(docs: DataFrame) -> DataFrame:
    """Per row of documents: held_out, lang_pred, score."""
    model = fit(training_rows(docs))
    held = F.coalesce(crc_share(F.col("doc_id"), 4) == 2, F.lit(False))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
