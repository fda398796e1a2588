"""License scan by diagonal voting.

The rolling k-gram hashes of all words of all texts are joined to the positions at which a template has the same
hash. A match votes for the diagonal it lies on (its place in the text less its place in the template).
A wording that stands in a text unchanged is one diagonal with all its votes; words that were left out or put in
move the rest of it to a neighbouring diagonal, so neighbouring diagonals are merged and their votes added.
What has enough votes is verified word by word in the text.

Templates of fewer than LONG words are wanted word for word, by grams of 2 words. Longer ones may differ by an edit
distance of up to a fifth of their words, by grams of 4. Both lose nothing: a span with e edits
of a template of n words keeps at least n - k + 1 - k * e of its grams, on diagonals that differ by e at most.

Votes are kept by text, not by row: copies of a text vote together, before anything is shuffled, so a
group of copies is no hot key. Only votes and the spans found are shuffled; texts are joined to the candidates, which
are written first so that Spark knows their size and sends them if they are small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcount.session import durable

from .common import WORD_TABLE, batch, by_shard, letter_words, utf8
from .license_texts import NOTICES, PHRASES

#: Words per gram of short and of long templates, and words from which a template is long.
SHORT_GRAM, LONG_GRAM = 2, 4
LONG = 16
#: Least similarity of a span to a long template: one less the edit distance in words per word of the template.
SIMILARITY = 0.8
SHARD_BYTES = 4 << 20
ROWS = 200_000
_FACTOR = 0x9E3779B97F4A7C15

FOUND = "licenses"
SPAN = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("phrase", T.BooleanType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("after_word", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Template:
    """A wording to look for; of a ``phrase`` every place counts, of others the best span at a place."""

    label: str
    words: tuple[bytes, ...]
    phrase: bool = False

    @property
    def gram(self) -> int:
        return LONG_GRAM if len(self.words) >= LONG else SHORT_GRAM

    @property
    def edits(self) -> int:
        """Edits that a span may have."""
        return int(len(self.words) * (1 - SIMILARITY) + 1e-9) if len(self.words) >= LONG and not self.phrase else 0

    @property
    def votes(self) -> int:
        """Votes that any span within ``edits`` gets at least."""
        return len(self.words) - self.gram + 1 - self.gram * self.edits


def template(label: str, text: str, phrase: bool = False) -> Template:
    made = Template(label, tuple(letter_words(text.encode())), phrase)
    if len(made.words) < SHORT_GRAM:
        raise ValueError(f"a template has at least {SHORT_GRAM} words: {text!r}")
    return made


def default_templates() -> list[Template]:
    return [template(label, text, True) for label, text in PHRASES] + [template(label, text) for label, text in NOTICES]


def word_codes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Words per text and the hash of every word, in order."""
    raw = np.frombuffer(b" ".join([(t or b"").translate(WORD_TABLE) for t in texts]) + b" ", np.uint8)
    sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    letter = np.concatenate(([False], raw != 0x20))
    edges = np.flatnonzero(letter[1:] != letter[:-1])
    begins, ends = edges[::2], edges[1::2]
    counts = np.diff(np.concatenate(([0], np.searchsorted(begins, np.cumsum(sizes)))))
    offsets = np.concatenate(([0], np.cumsum(ends - begins)))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(raw[letter[1:]].tobytes())]
    ).dictionary_encode()
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    return counts, each[words.indices.to_numpy()]


def rolling(codes: np.ndarray, gram: int) -> np.ndarray:
    """The hash of the ``gram`` words from each place on, places without so many words left out."""
    n = max(0, len(codes) - gram + 1)
    total = np.full(n, gram, np.uint64)
    for k in range(gram):
        total = total * np.uint64(_FACTOR) + codes[k : k + n]
        total ^= total >> np.uint64(29)
    return total.view(np.int64)


def template_grams(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """(gram, template, at, edits, votes): every place of every template by its hash."""
    rows = []
    for which, t in enumerate(templates):
        _, codes = word_codes([b" ".join(t.words)])
        rows += [(g, which, at, t.edits, t.votes) for at, g in enumerate(rolling(codes, t.gram).tolist())]
    names = ["gram", "template", "at", "edits", "votes"]
    kinds = [pa.int64(), *[pa.int32()] * 4]
    return spark.createDataFrame(pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names))


def text_grams(texts: DataFrame, sizes: list[int], shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(h1, h2, place, gram): all rolling grams of the ``sizes`` given of all texts."""
    schema = T.StructType.fromDDL("h1 long, h2 long, place int, gram long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_shard(batches, "text", shard_bytes):
            counts, codes = word_codes(utf8(rows.column("text")))
            owner = np.repeat(np.arange(len(counts)), counts)
            first = np.cumsum(counts) - counts
            h1, h2 = (rows.column(c).to_numpy() for c in ("h1", "h2"))
            for size in sizes:
                grams = rolling(codes, size)
                # A gram lies in one text if its first and last word do.
                at = np.flatnonzero(owner[: len(grams)] == owner[size - 1 :])
                for k in range(0, len(at), ROWS):
                    some = at[k : k + ROWS]
                    of = owner[some]
                    yield batch({"h1": h1[of], "h2": h2[of], "place": some - first[of], "gram": grams[some]}, schema)

    return texts.mapInArrow(work, schema)


def diagonals(grams: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h1, h2, template, edits, votes, diagonal, n): the votes of every diagonal; a place votes once."""
    hits = grams.join(wanted, "gram").withColumn("diagonal", F.col("place") - F.col("at"))
    keys = ["h1", "h2", "template", "edits", "votes", "diagonal"]
    return hits.groupBy(*keys).agg(F.count_distinct("place").alias("n"))


def merged(votes: DataFrame) -> DataFrame:
    """(h1, h2, candidates): per text the runs of neighbouring diagonals that have enough votes."""
    order = Window.partitionBy("h1", "h2", "template").orderBy("diagonal")
    new = (F.col("diagonal") - F.lag("diagonal").over(order)) <= F.col("edits")
    runs = votes.withColumn("starts", F.when(new, 0).otherwise(1)).withColumn("run", F.sum("starts").over(order))
    keys = ["h1", "h2", "template", "edits", "votes", "run"]
    spans = runs.groupBy(*keys).agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.sum("n").alias("n"))
    enough = spans.where("n >= votes")
    return enough.groupBy("h1", "h2").agg(F.collect_list(F.struct("template", "low", "high")).alias("candidates"))


# ---- verification ------------------------------------------------------------------------------------------


def end_distances(words: list[bytes], wanted: tuple[bytes, ...]) -> np.ndarray:
    """For every end in ``words`` the least edits that make the words before it ``wanted``, any start."""
    number = {w: k for k, w in enumerate(dict.fromkeys(wanted))}
    pattern = np.array([number[w] for w in wanted])
    steps = np.arange(len(wanted) + 1)
    column = steps.copy()
    out = np.empty(len(words) + 1, np.int64)
    out[0] = column[-1]
    for k, word in enumerate(words):
        known = number.get(word, -1)
        best = np.empty_like(column)
        best[0] = 0
        np.minimum(column[:-1] + (pattern != known), column[1:] + 1, out=best[1:])
        column = np.minimum.accumulate(best - steps) + steps
        out[k + 1] = column[-1]
    return out


def start_of(words: list[bytes], end: int, wanted: tuple[bytes, ...], edits: int) -> int:
    """The nearest start from which the words up to ``end`` are ``edits`` edits from ``wanted``."""
    before = words[max(0, end - len(wanted) - edits) : end][::-1]
    # Anchored at ``end``: an empty span costs all words wanted.
    column = np.arange(len(wanted) + 1)
    steps = column.copy()
    least, start = column[-1], end
    back = wanted[::-1]
    for k, word in enumerate(before):
        best = np.empty_like(column)
        best[0] = column[0] + 1
        best[1:] = np.minimum(column[:-1] + np.array([w != word for w in back]), column[1:] + 1)
        column = np.minimum.accumulate(best - steps) + steps
        if column[-1] < least:
            least, start = column[-1], end - k - 1
    return start


def verified(words: list[bytes], t: Template, low: int, high: int) -> list[tuple[int, int, int]]:
    """(first word, after the last, edits) of the spans near some diagonals, best first, none overlapping."""
    n = len(t.words)
    if not t.edits:
        return [(low, low + n, 0)] if low >= 0 and tuple(words[low : low + n]) == t.words else []
    if low == high and low >= 0 and tuple(words[low : low + n]) == t.words:
        return [(low, low + n, 0)]
    begin = max(0, low - t.edits)
    window = words[begin : high + n + t.edits]
    distances = end_distances(window, t.words)
    found: list[tuple[int, int, int]] = []
    for end in np.lexsort((np.arange(len(distances)), distances)).tolist():
        if distances[end] > t.edits:
            break
        if any(a < end <= b for a, b, _ in found):
            continue
        start = start_of(window, end, t.words, t.edits)
        if not any(a < end and start < b for a, b, _ in found):
            found.append((start, end, int(distances[end])))
    return [(begin + a, begin + b, e) for a, b, e in found]


def spans_of(words: list[bytes], candidates: list[dict], templates: list[Template]) -> list[tuple]:
    """Label, phrase, first word, after the last, score: all places of phrases, then spans of the other templates.

    Of overlapping spans of other templates the most similar one stays, then the longest template, then the first.
    """
    places, others = set(), []
    for c in candidates:
        t = templates[c["template"]]
        for a, b, edits in verified(words, t, c["low"], c["high"]):
            if t.phrase:
                places.add((a, b, t.label))
            else:
                others.append((edits / len(t.words), -len(t.words), a, b, c["template"]))
    kept: list[tuple] = []
    taken: list[tuple[int, int]] = []
    for part, _, a, b, which in sorted(set(others)):
        if not any(a < y and x < b for x, y in taken):
            taken.append((a, b))
            kept.append((templates[which].label, False, a, b, 1 - part))
    return [(label, True, a, b, 1.0) for a, b, label in sorted(places)] + sorted(kept, key=lambda x: x[2])


def find_licenses(
    docs: DataFrame,
    templates: list[Template] | None = None,
    text_col: str = "text",
    keep: list[str] | None = None,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """All rows of ``docs`` with all columns, or those to ``keep``, plus ``n_words`` and ``licenses``, the spans found.

    A span has a label, whether it is a place of a phrase, its first word, the word after its last, and a score: its
    similarity to the template. Words are lower-cased (A-Z) runs of letters, digits and non-ASCII
    characters of whole texts, counted from 0. Null and empty texts have no words and no spans. Repeated
    rows get the same spans each. Columns of the two names are replaced, others keep their names
    whatever they are. An empty table, or no templates, gives no spans.
    """
    templates = default_templates() if templates is None else templates
    spark = docs.sparkSession
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", FOUND)]
    # Inner columns beside one struct of the row's own, so that names cannot clash.
    text = F.col(f"`{text_col}`")
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    keyed = docs.select(row.alias("row"), text.alias("text"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"))
    sizes = sorted({t.gram for t in templates})
    if templates:
        grams = text_grams(keyed.where("text IS NOT NULL").select("text", "h1", "h2"), sizes, shard_bytes)
        candidates = durable(merged(diagonals(grams, template_grams(spark, templates))))
        keyed = keyed.join(candidates, ["h1", "h2"], "left")
    else:
        keyed = keyed.withColumn("candidates", F.lit(None).cast("array<struct<template int, low int, high int>>"))
    kept = T.StructType([docs.schema[c] for c in names])
    schema = T.StructType([T.StructField("row", kept), T.StructField("n_words", T.LongType()), T.StructField(FOUND, T.ArrayType(SPAN))])
    sent = spark.sparkContext.broadcast(templates)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts, every = utf8(rows.column("text")), rows.column("candidates").to_pylist()
            counts, spans = [], []
            for text, found in zip(texts, every):
                words = letter_words(text or b"")
                counts.append(len(words))
                spans.append([dict(zip(SPAN.names, s)) for s in spans_of(words, found or [], sent.value)])
            yield batch({"row": rows.column("row"), "n_words": counts, FOUND: spans}, schema)

    out = keyed.select("row", "text", "candidates").mapInArrow(work, schema)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "n_words", FOUND)


def license_digest(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """Per row of documents: words, places of phrases, labels of phrases and of all spans, the best score."""
    found = find_licenses(docs, templates, keep=["doc_id"])
    phrases = F.filter(FOUND, lambda s: s["phrase"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(phrases).cast("long").alias("n_base"),
        F.array_min(F.transform(phrases, lambda s: s["first_word"])).alias("first_word"),
        F.array_max(F.transform(phrases, lambda s: s["first_word"])).alias("last_word"),
        labels(phrases).alias("base_labels"),
        labels(F.col(FOUND)).alias("labels"),
        F.coalesce(F.array_max(F.transform(FOUND, lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )
