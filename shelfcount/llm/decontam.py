"""Benchmark decontamination with an FM-index per shard of training text.

Each task cuts its documents into shards of bounded size. A shard's words become one sequence of
numbers with a separator after every document; its suffix array gives the Burrows-Wheeler
transform, which is stored as a wavelet tree with rank counters. All benchmark phrases are
searched backwards through the ranks at once, occurrences are located by walking to sampled suffix
positions, and overlapping occurrences merge into removal spans. Nothing is shuffled, so a hot
source or a large group of copies stays spread over the tasks that read it.

Phrases go to the tasks in blocks of bounded size. A benchmark of one block needs one pass; each
further block is a further pass over the rows as written by the pass before.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfcount.session import durable

from .common import batch, by_shard, letter_words, utf8

#: Words in a window.
WINDOW = 10
#: Bytes of text in a shard; each shard has its own index.
SHARD_BYTES = 4 << 20
#: Phrases that are sent to the tasks at once.
BLOCK_PHRASES = 200_000
#: Every so many positions of a shard keep their place in the suffix array.
SAMPLE = 16

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LEAKS = "__leaks"
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)


def suffix_array(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of all suffixes in order; groups of equal prefixes are refined by doubling."""
    n = len(codes)
    bits = max(1, int(symbols).bit_length())
    width = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(width):
        key <<= bits
        if k < n:
            key[: n - k] |= codes[k:].astype(np.int64) + 1
    order = np.argsort(key, kind="stable").astype(np.int64)
    key = key[order]
    starts = np.concatenate(([True], key[1:] != key[:-1])) if n else np.zeros(0, bool)
    rank = np.empty(n, np.int64)
    first = np.flatnonzero(starts)
    group = np.repeat(first, np.diff(np.append(first, n)))
    rank[order] = group
    open_slots = np.flatnonzero(np.repeat(np.diff(np.append(first, n)) > 1, np.diff(np.append(first, n))))
    while len(open_slots):
        members = order[open_slots]
        after = members + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[members] * (n + 1) + second
        sub = np.argsort(key, kind="stable")
        members, key = members[sub], key[sub]
        order[open_slots] = members
        starts = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(starts)
        sizes = np.diff(np.append(first, len(key)))
        rank[members] = np.repeat(open_slots[first], sizes)
        open_slots = open_slots[np.repeat(sizes > 1, sizes)]
        width *= 2
    return order


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        words = -(-self.n // 64) + 1
        packed = np.zeros(words * 8, np.uint8)
        raw = np.packbits(bits, bitorder="little")
        packed[: len(raw)] = raw
        self.words = packed.view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words)[:-1], dtype=np.int64)))

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletTree:
    """A sequence over a small alphabet, one bit vector per level, with access and rank."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.depth = max(1, int(symbols - 1).bit_length())
        self.levels: list[Bits] = []
        self.zeros: list[int] = []
        for level in range(self.depth - 1, -1, -1):
            bits = (values >> level & 1).astype(bool)
            self.levels.append(Bits(bits))
            self.zeros.append(int(len(values) - np.count_nonzero(bits)))
            values = np.concatenate((values[~bits], values[bits]))

    def _down(self, k: int, bit: np.ndarray, at: np.ndarray) -> np.ndarray:
        ones = self.levels[k].ones(at)
        return np.where(bit, self.zeros[k] + ones, at - ones)

    def rank(self, symbol: np.ndarray, *at: np.ndarray) -> list[np.ndarray]:
        """Times each symbol occurs before each position."""
        start, places = np.zeros_like(at[0]), list(at)
        for k in range(self.depth):
            bit = (symbol >> (self.depth - 1 - k) & 1).astype(bool)
            start = self._down(k, bit, start)
            places = [self._down(k, bit, p) for p in places]
        return [p - start for p in places]

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and its rank there."""
        start, symbol = np.zeros_like(at), np.zeros_like(at)
        for k in range(self.depth):
            bit = self.levels[k].get(at)
            symbol = symbol << 1 | bit
            start = self._down(k, bit, start)
            at = self._down(k, bit, at)
        return symbol, at - start


class FMIndex:
    """Backward search and sampled location over a sequence of numbers below ``symbols``."""

    def __init__(self, codes: np.ndarray, symbols: int, sample: int = SAMPLE):
        # A last symbol that is smaller than all others makes suffix order and rotation order one.
        codes, symbols = np.append(codes + 1, 0), symbols + 1
        order = suffix_array(codes, symbols)
        self.n = len(codes)
        self.tree = WaveletTree(codes[order - 1], symbols)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(codes, minlength=symbols))))
        # Position 0 is sampled, so no walk runs past the start of the sequence.
        kept = order % sample == 0
        self.marked = Bits(kept)
        self.places = order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases of one length; empty where a phrase does not occur."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, k] + 1
            below, upto = self.tree.rank(symbol, low[live], high[live])
            low[live], high[live] = self.first[symbol] + below, self.first[symbol] + upto
            live = live[high[live] > low[live]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of each row's suffix."""
        places = np.empty(len(rows), np.int64)
        live, steps, at = np.arange(len(rows)), 0, rows
        while len(live):
            here = self.marked.get(at)
            places[live[here]] = self.places[self.marked.ones(at[here])] + steps
            live, at = live[~here], at[~here]
            symbol, rank = self.tree.access_rank(at)
            at = self.first[symbol] + rank
            steps += 1
        return places


def item_phrases(text: bytes | None, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    """All windows of an item; an item of fewer words is one window, one without words has none."""
    words = letter_words(text or b"")
    if not words:
        return []
    return list(dict.fromkeys(tuple(words[k : k + window]) for k in range(max(1, len(words) - window + 1))))


def phrase_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, most: int) -> Iterator[list]:
    """Lists of (words, item number or None), of about ``most`` phrases each, read item by item."""
    block: list[tuple[tuple[bytes, ...], int | None]] = []
    for item, text in benchmark.select(item_col, text_col).toLocalIterator():
        block += [(p, item) for p in item_phrases(None if text is None else text.encode(), window)]
        if len(block) >= most:
            yield block
            block = []
    if block:
        yield block


def _search_shard(texts: list[bytes | None], phrases: list) -> list[tuple[int, list, list]]:
    """(number of words, [[first word, after last word], ...], items) of every text."""
    words: list[bytes] = []
    ends = []
    for text in texts:
        if text:
            words += letter_words(text)
        words.append(b"")  # no word is empty: the separator
        ends.append(len(words))
    codes, known = pd.factorize(np.fromiter(words, object, len(words)))
    ends = np.array(ends, np.int64)
    begins = np.concatenate(([0], ends[:-1]))
    number = {w: k for k, w in enumerate(known)}
    by_length: dict[int, tuple[list, list]] = {}
    for which, (phrase, _) in enumerate(phrases):
        coded = [number.get(w, -1) for w in phrase]
        if min(coded) >= 0:
            rows, ids = by_length.setdefault(len(phrase), ([], []))
            rows.append(coded)
            ids.append(which)
    if by_length:
        index = FMIndex(codes.astype(np.int64), len(known))
    change = np.zeros(len(words) + 1, np.int32)
    found_doc, found_phrase = [], []
    for length, (rows, ids) in by_length.items():
        low, high = index.search(np.array(rows, np.int64))
        counts = high - low
        which = np.repeat(np.arange(len(ids)), counts)
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        places = index.locate(np.repeat(low, counts) + inner)
        np.add.at(change, places, 1)
        np.add.at(change, places + length, -1)
        pair = np.unique(np.searchsorted(ends, places, "right") * len(phrases) + np.array(ids, np.int64)[which])
        found_doc.append(pair // len(phrases))
        found_phrase.append(pair % len(phrases))
    covered = np.concatenate(([0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0]))
    edges = np.diff(covered)
    run_from, run_to = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    of_run = np.searchsorted(ends, run_from, "right")
    spans: list[list] = [[] for _ in texts]
    for doc, a, b in zip(of_run.tolist(), run_from.tolist(), run_to.tolist()):
        spans[doc].append([a - int(begins[doc]), b - int(begins[doc])])
    items: list[set] = [set() for _ in texts]
    for docs, ids in zip(found_doc, found_phrase):
        for doc, which in zip(docs.tolist(), ids.tolist()):
            if phrases[which][1] is not None:
                items[doc].add(phrases[which][1])
    return [(int(e - b - 1), s, sorted(i)) for b, e, s, i in zip(begins, ends, spans, items)]


def _merge(spans: list) -> list:
    merged: list[list] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    return merged


Finish = Callable[[pa.RecordBatch, list[dict]], pa.RecordBatch]


def _searched(
    docs: DataFrame,
    benchmark: DataFrame,
    schema: T.StructType,
    finish: Finish,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    block_phrases: int = BLOCK_PHRASES,
) -> DataFrame:
    """One pass over the rows for every block of phrases; the last one turns rows and leaks into ``schema``."""
    spark = docs.sparkSession
    # Leaks found so far travel in a column of their own, whatever columns the rows have.
    inner = LEAKS
    while inner in docs.columns:
        inner = f"_{inner}"
    marked = T.StructType([*docs.schema.fields, T.StructField(inner, FOUND)])
    out = docs
    blocks = phrase_blocks(benchmark, item_col, item_text_col, window, block_phrases)
    block, after = next(blocks, []), next(blocks, None)
    while True:
        sent = spark.sparkContext.broadcast(block)
        last = after is None

        def work(batches: Iterator[pa.RecordBatch], sent=sent, last=last) -> Iterator[pa.RecordBatch]:
            for rows in by_shard(batches, text_col, shard_bytes):
                found = _search_shard(utf8(rows.column(text_col)), sent.value)
                if inner in rows.schema.names:
                    before = rows.column(inner).to_pylist()
                    found = [
                        (n, _merge(old["spans"] + s), sorted({*old["items"], *i}))
                        for old, (n, s, i) in zip(before, found)
                    ]
                leaks = [dict(zip(FOUND.names, row)) for row in found]
                yield finish(rows, leaks) if last else _with_leaks(rows, leaks, marked, inner)

        out = out.mapInArrow(work, schema if last else marked)
        if last:
            return out
        out = durable(out)
        block, after = after, next(blocks, None)


def _with_leaks(rows: pa.RecordBatch, leaks: list[dict], schema: T.StructType, name: str = LEAKS) -> pa.RecordBatch:
    columns = {c: rows.column(c) for c in schema.names if c != name}
    return batch(columns | {name: leaks}, schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of ``docs`` plus the struct ``__leaks``: n_words, spans, items.

    ``spans`` are merged [first word, after last word) ranges covered by benchmark windows and
    ``items`` the sorted ids of the items with a window in the text. Null and empty texts have no
    words and no spans. Repeated rows are searched one by one. An item with a null id still marks
    words but is not listed; one with null or wordless text has no window; items that share an id
    are one item. An empty benchmark leaves every text clean. A column named ``__leaks``, as of an earlier
    search, is replaced. Options are those of ``_searched``: column names, window, sizes of shards and blocks.
    """
    docs = docs.drop(LEAKS)
    schema = T.StructType([f for f in docs.schema.fields if f.name != LEAKS] + [T.StructField(LEAKS, FOUND)])
    return _searched(docs, benchmark, schema, lambda rows, leaks: _with_leaks(rows, leaks, schema), text_col, **options)


def _digest_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("n_items", T.LongType()),
            T.StructField("items_sha256", T.StringType()),
            T.StructField("contaminated", T.BooleanType()),
        ]
    )


def _digest(ids: pa.Array, leaks: list[dict], schema: T.StructType) -> pa.RecordBatch:
    hits = [sum(b - a for a, b in x["spans"]) for x in leaks]
    listed = [",".join(sorted(map(str, x["items"]))) for x in leaks]
    columns = {
        "doc_id": ids,
        "n_words": [x["n_words"] for x in leaks],
        "n_hit": hits,
        "n_items": [len(x["items"]) for x in leaks],
        "items_sha256": [hashlib.sha256(s.encode()).hexdigest() for s in listed],
        "contaminated": [h > 0 for h in hits],
    }
    return batch(columns, schema)


def leak_report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per row of ``docs``: n_words, n_hit, n_items, items_sha256, contaminated, in one pass."""
    schema = _digest_schema(docs.schema[id_col].dataType)
    return _searched(docs, benchmark, schema, lambda rows, leaks: _digest(rows.column(id_col), leaks, schema), **options)


def leak_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The columns of ``leak_report`` from rows that were searched already."""
    schema = _digest_schema(found.schema[id_col].dataType)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            yield _digest(rows.column(0), rows.column(LEAKS).to_pylist(), schema)

    return found.select(id_col, LEAKS).mapInArrow(work, schema)


def cut_spans(text: bytes, spans: list) -> str:
    """The text without the bytes from each span's first word to the end of its last."""
    places = [m.span() for m in WORD.finditer(text.lower())]
    kept, at = [], 0
    for first, after in spans:
        kept.append(text[at : places[first][0]])
        at = places[after - 1][1]
    kept.append(text[at:])
    return b"".join(kept).decode()


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", chars_col: str = "n_chars", **options) -> DataFrame:
    """``docs`` with every removal span cut out of the text and the column of lengths set anew.

    A document of which no word is left goes. Clean documents, null and empty texts among them,
    stay as they are.
    """
    schema = docs.schema

    def finish(rows: pa.RecordBatch, leaks: list[dict]) -> pa.RecordBatch:
        columns = {name: rows.column(name) for name in schema.names}
        if not any(x["spans"] for x in leaks):
            return batch(columns, schema)
        texts, keep = rows.column(text_col).to_pylist(), []
        lengths = columns[chars_col].to_pylist() if chars_col in schema.names else [None] * len(texts)
        for k, x in enumerate(leaks):
            if x["spans"]:
                texts[k] = cut_spans(texts[k].encode(), x["spans"])
                lengths[k] = len(texts[k])
            keep.append(not x["spans"] or sum(b - a for a, b in x["spans"]) < x["n_words"])
        columns[text_col] = texts
        if chars_col in schema.names:
            columns[chars_col] = lengths
        return batch(columns, schema).filter(pa.array(keep))

    return _searched(docs, benchmark, schema, finish, text_col, **options)
