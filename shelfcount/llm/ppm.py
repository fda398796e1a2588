"""Language-model scores: prediction by partial matching over bytes, beside a unigram baseline.

The model is pretrained. Every training text, reduced to its lower-cased tokens with one space
between them and an end symbol, is counted into contexts of up to ORDER bytes. A symbol is coded in
the longest known context; if that has not seen it, an escape (half a count of every distinct symbol
of the context) leads to the next shorter context, in which symbols of the longer one are excluded,
down to an even share of what is left. The log-probability of a text is the sum over its symbols.

All contexts are counted and all are used. The most frequent ones, at most CONTEXTS, go to the tasks
as a cache. A worker compiles them into one row per context: probability of, and next context after,
each symbol. A context depends on the last ORDER bytes only, so a shard of texts is scored in many
lanes at once. Where the cache does not know all ORDER bytes before a symbol, the context and symbol
are given out and joined to the table of all others. Those never seen in training (in held-out texts
only) are worked out from the table of all contexts, dealt by their last SHARED bytes.

The most frequent of the symbols after contexts beyond the cache, at most SENT, go to the tasks too, as a sorted list that
cold symbols are looked up in; only what is in neither is given out.

The baseline needs the count of every token. The most frequent ones, at most FREQUENT, go to the tasks; the others
are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcount.session import durable

from .common import batch, by_shard, crc_share, joined, space_words, utf8

ORDER = 5
#: Contexts in the cache of a task; the others are joined.
CONTEXTS = 1 << 16
#: Shorter contexts than this, at most 256 to its power, go to the tasks that work out unseen symbols.
SHARED = 3
#: Part of a count that every distinct symbol of a context gives to the escape.
ESCAPE = 0.5
FREQUENT = 1 << 18
#: Most frequent symbols after contexts beyond the cache that go to the tasks as a sorted list.
SENT = 1 << 21
#: Added to every count of the baseline.
ADDED = 0.1
#: Follows every text; no byte of UTF-8.
END = 0xFF
SHARD_BYTES = 2 << 20
LANES = 8192
#: Distinct tokens that a task holds before it gives them out (grams: four times as many), and rows of a batch.
HELD = 300_000
CHUNK = 100_000


def tokens(text: bytes | None) -> list[bytes]:
    return space_words(text or b"")


def lines_of(texts: list[bytes | None]) -> list[bytes]:
    """Every text's tokens with one space between them."""
    return [b" ".join(tokens(t)) for t in texts]


def words_of(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Tokens per line, the number of every token in order, and the distinct tokens."""
    sizes = np.fromiter((x.count(b" ") + 1 if x else 0 for x in lines), np.int64, len(lines))
    # Every token is followed by one space, so the joined lines are an array of tokens with a space each.
    data = b"".join([x + b" " for x in lines if x])
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x20) + 1
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = words.dictionary_encode()
    return sizes, coded.indices.to_numpy(), [w[:-1] for w in coded.dictionary.to_pylist()]


def tape(lines: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All lines in a row, each followed by ``order`` ends; starts; numbers of coded symbols.

    The coded symbols of a line are its bytes and the first end after them. ``order`` ends stand
    before the first line too, so every line begins in the same context.
    """
    pad = bytes([END]) * order
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = order + np.cumsum(sizes + order) - sizes - order
    return np.frombuffer(pad + pad.join(lines) + pad, np.uint8), starts, sizes + 1


def grams(symbols: np.ndarray, starts: np.ndarray, coded: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (context of ``order`` bytes, symbol), packed with the symbol lowest, and their counts."""
    n = len(symbols)
    key = np.zeros(max(0, n - order), np.int64)
    for back in range(order, -1, -1):
        key <<= 8
        key |= symbols[order - back : n - back]
    change = np.zeros(n + 1, np.int8)
    change[starts] = 1
    change[starts + coded] = -1
    key = key[np.cumsum(change[:-1], dtype=np.int8)[order:] > 0]
    return totals(key, np.ones(len(key), np.int64))


def totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    if (counts == 1).all():
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first)


class _Tally:
    """Counts of a task's texts, given out when they grow beyond what a task may hold."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.ends = 0

    def add(self, lines: list[bytes], order: int) -> None:
        _, codes, known = words_of(lines)
        held = self.words
        for w, n in zip(known, np.bincount(codes, minlength=len(known)).tolist()):
            held[w] = held.get(w, 0) + n
        self.ends += len(lines)
        self.parts.append(grams(*tape(lines, order), order))
        self.size += len(self.parts[-1][0])

    def settle(self) -> None:
        """Sum up the grams when there are many parts of them."""
        if self.size > 8 * HELD:
            self.parts = [totals(*(np.concatenate(x) for x in zip(*self.parts)))]
            self.size = len(self.parts[0][0])

    def given(self, schema: T.StructType, least: int = 0) -> Iterator[pa.RecordBatch]:
        """Tokens if more than ``least`` are held, grams if their sums are over four times as many; they are held no longer."""
        if self.words and len(self.words) > least:
            words, counts = list(self.words), list(self.words.values())
            self.words = {}
            for k in range(0, len(words), CHUNK):
                part = words[k : k + CHUNK]
                yield batch({"word": part, "gram": [None] * len(part), "n": counts[k : k + CHUNK]}, schema)
        if self.parts and (not least or len(self.parts) == 1 and self.size > 4 * least):
            keys, sums = totals(*(np.concatenate(x) for x in zip(*self.parts)))
            self.parts, self.size = [], 0
            for k in range(0, len(keys), CHUNK):
                part = keys[k : k + CHUNK]
                yield batch({"word": [None] * len(part), "gram": part, "n": sums[k : k + CHUNK]}, schema)
        if self.ends and not least:
            yield batch({"word": [None], "gram": [None], "n": [self.ends]}, schema)


def _context(gram: Column) -> Column:
    return F.shiftright(gram, 8)


def _held() -> Column:
    """Count of the whole context of a gram; a context has at most 256 symbols."""
    return F.sum("n").over(Window.partitionBy("part", "length", _context(F.col("gram"))))


def _shortened(lengths: range) -> list[Column]:
    """A gram with each of some lengths of context."""
    return [F.struct(F.lit(k).alias("length"), F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("gram")) for k in lengths]


def training_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(part, word, length, gram, n, held) over the rows of ``docs`` (text).

    Tokens have no gram, grams no word, the end token neither. A gram is a context of ``length`` bytes and the
    symbol after it; lengths go from SHARED (or the order, if that is less) to the order. Rows are shuffled
    once, by the token or the last SHARED bytes of the context, which holds all that a context's sums need.
    """
    schema = T.StructType(
        [T.StructField("word", T.BinaryType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for rows in by_shard(batches, "text", SHARD_BYTES):
            tally.add(lines_of(utf8(rows.column("text"))), order)
            tally.settle()
            yield from tally.given(schema, HELD)
        yield from tally.given(schema)

    shared = min(order, SHARED)
    last = _context(F.col("gram")).bitwiseAND((1 << 8 * shared) - 1)
    dealt = docs.select("text").mapInArrow(work, schema).withColumn("part", F.coalesce(last, F.xxhash64("word"))).repartition("part")
    own = dealt.groupBy("part", "word", "gram").agg(F.sum("n").alias("n"))
    # Tokens and the end token stay one row each.
    one = F.struct(F.lit(-1).alias("length"), F.col("gram").alias("gram"))
    every = F.when(F.col("gram").isNull(), F.array(one)).otherwise(F.array(*_shortened(range(shared, order + 1))))
    flat = own.select("part", "word", "n", F.explode(every).alias("g")).select("part", "word", "g.length", "g.gram", "n")
    return flat.groupBy("part", "word", "length", "gram").agg(F.sum("n").alias("n")).withColumn("held", _held())


def levels(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(length, context, symbol, n, held) of every context; ``held`` is the count of the whole context.

    ``counts`` has the longer contexts; the shorter ones, at most 256 to the power of SHARED, come from the shortest of those.
    """
    shared = min(order, SHARED)
    grams = counts.where("gram IS NOT NULL").select("length", "gram", "n", "held")
    if shared:
        few = grams.where(F.col("length") == shared).select(F.explode(F.array(*_shortened(range(shared)))).alias("g"), "n")
        sums = few.groupBy("g.length", "g.gram").agg(F.sum("n").alias("n")).withColumn("part", F.lit(0))
        short = durable(sums.withColumn("held", _held()).drop("part"))
        grams = grams.unionByName(short)
    return grams.select("length", _context(F.col("gram")).alias("context"), F.col("gram").bitwiseAND(255).alias("symbol"), "n", "held")


def _class(c: str) -> Column:
    """Class of a frequency: 64 to a doubling."""
    return F.floor(F.log2(c) * 64)


def _cutoff(rows: DataFrame, c: str, room: int) -> tuple[int, bool]:
    """Lowest class of frequency of which all rows, and those of higher ones, fit into ``room``; whether any row does not."""
    # There are few classes of frequency.
    classes = rows.groupBy(_class(c).alias("class")).count().collect()
    cutoff = 1 << 30
    for name, size in sorted(((r[0], r[1]) for r in classes), reverse=True):
        if size > room:
            return cutoff, True
        cutoff, room = name, room - size
    return cutoff, False


def cached(sums: DataFrame, contexts: int = CONTEXTS) -> tuple[Column, bool]:
    """Which rows of ``levels`` belong to the most frequent contexts, and whether any row does not.

    Contexts are taken by classes of frequency, all of a class or none. The part of a context and
    the start of a context are as frequent as itself, so they are taken with it.
    """
    cutoff, partial = _cutoff(sums.groupBy("length", "context").agg(F.max("held").alias("held")), "held", contexts)
    return (_class("held") >= cutoff) | (F.col("length") == 0), partial


def trie(counts: DataFrame, order: int = ORDER, contexts: int = CONTEXTS) -> pd.DataFrame:
    """Rows (length, context, symbol, n) of the most frequent contexts, at most ``contexts`` of them."""
    sums = levels(counts, order)
    return sums.where(cached(sums, contexts)[0]).select("length", "context", "symbol", "n").toArrow().to_pandas()


@dataclass
class Machine:
    """Per context: log10 probability of each symbol, and the context after it.

    Tables have a column for each symbol that was ever seen and a first one for all others, which
    share the rest evenly and lead to the empty context.
    """

    order: int
    column: np.ndarray
    log: np.ndarray
    #: Where the row of the next context starts in the table read as one line.
    after: np.ndarray
    #: Rows of contexts of less than ``order`` bytes, which come first.
    short: int

    def without_short(self) -> Machine:
        """Symbols after short contexts have a logarithm of one, which no probability has."""
        log = self.log.copy()
        log[: self.short] = 1
        return replace(self, log=log)

    def score(self, texts: list[list[bytes]]) -> np.ndarray:
        """log10 probability of each tokenised text with its end."""
        return self.score_lines([b" ".join(t) for t in texts])

    def score_lines(self, lines: list[bytes]) -> np.ndarray:
        """log10 probability of each line with its end."""
        return self.score_known(lines)[0]

    def score_known(self, lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of the lines; line and packed (context, symbol) of every place not in them (``without_short``)."""
        none = np.zeros(0, np.int64)
        if not lines:
            return np.zeros(0), none, none
        symbols, starts, coded = tape(lines, self.order)
        lanes = max(1, min(LANES, len(symbols) // (8 * self.order + 1)))
        steps = -(-len(symbols) // lanes)
        grid = np.full(lanes * steps, END, np.uint8)
        grid[: len(symbols)] = symbols
        by_step = np.ascontiguousarray(self.column[grid].reshape(lanes, steps).T)
        log, after = self.log.ravel(), self.after.ravel()
        state, at = np.zeros(lanes, np.int32), np.empty(lanes, np.int32)
        # A lane starts in the context of the bytes before it, at the end of the lane before.
        for back in range(min(self.order, steps), 0, -1):
            state[1:] = after[state[1:] + by_step[steps - back, :-1]]
        value = np.empty((steps, lanes), np.float32)
        for k in range(steps):
            np.add(state, by_step[k], out=at)
            np.take(log, at, out=value[k], mode="clip")
            np.take(after, at, out=state, mode="clip")
        flat = np.ascontiguousarray(value.T).ravel()
        at = np.flatnonzero(flat[: len(symbols)] > 0)
        flat[at] = 0
        line = np.searchsorted(starts, at, "right") - 1
        own = (line >= 0) & (at < (starts + coded)[line])
        at, line = at[own], line[own]
        gram = np.zeros(len(at), np.int64)
        for back in range(self.order, -1, -1):
            gram <<= 8
            gram |= symbols[at - back]
        edges = np.column_stack((starts, starts + coded)).ravel()
        return np.add.reduceat(flat, edges, dtype=np.float64)[::2], line, gram


def compiled(rows: pd.DataFrame, order: int = ORDER) -> Machine:
    """The machine of a trie. Without training symbols every symbol has an even share."""
    lengths, context = np.zeros(1, np.int64), np.zeros(1, np.int64)
    packed, offset = [np.zeros(1, np.int64)], [0]
    for length in range(1, order + 1):
        own = np.unique(rows.loc[rows["length"] == length, "context"].to_numpy(np.int64))
        offset.append(len(context))
        packed.append(own)
        lengths = np.concatenate((lengths, np.full(len(own), length)))
        context = np.concatenate((context, own))

    def place(length: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, number) of contexts of one length."""
        if not len(packed[length]):
            return np.zeros(wanted.shape, bool), np.zeros(wanted.shape, np.int64)
        slot = np.minimum(np.searchsorted(packed[length], wanted), len(packed[length]) - 1)
        return packed[length][slot] == wanted, offset[length] + slot

    symbol = np.unique(rows["symbol"].to_numpy(np.int64))
    column = np.zeros(256, np.int32)
    column[symbol] = np.arange(1, len(symbol) + 1)
    size, width = len(context), len(symbol) + 1
    counts = np.zeros((size, width), np.float32)
    shorter = np.zeros(size, np.int64)
    for length in range(order + 1):
        own = rows[rows["length"] == length]
        at = place(length, own["context"].to_numpy(np.int64))[1]
        counts[at, column[own["symbol"].to_numpy(int)]] = own["n"]
        if length:
            here = lengths == length
            shorter[here] = place(length - 1, context[here] & ((1 << 8 * (length - 1)) - 1))[1]
    log, after = np.empty((size, width), np.float32), np.zeros((size, width), np.int32)
    others = 256 - len(symbol)
    for first in range(0, size, 2048):
        block = np.arange(first, min(first + 2048, size))
        chance = np.zeros((len(block), width))
        left = np.ones(len(block))
        open_symbols = np.ones((len(block), width), bool)
        at = block.copy()
        for step in range(order, -1, -1):
            use = lengths[block] >= step
            own = np.where(open_symbols & use[:, None], counts[at].astype(np.float64), 0.0)
            seen = own > 0
            kinds, held = seen.sum(axis=1), own.sum(axis=1)
            share = np.where(kinds > 0, left / np.maximum(held, 1), 0.0)
            chance += np.where(seen, own - ESCAPE, 0.0) * share[:, None]
            left = np.where(kinds > 0, share * kinds * ESCAPE, left)
            open_symbols &= ~seen
            at = np.where(use, shorter[at], at)
        rest = open_symbols[:, 1:].sum(axis=1) + others
        chance += np.where(open_symbols, (left / np.maximum(rest, 1))[:, None], 0.0)
        whole = chance[:, 1:].sum(axis=1) + chance[:, 0] * others
        log[block] = np.log10(chance / whole[:, None])
        # Shorter contexts after (context, symbol) are set first, so the longest known one stays.
        for target in range(1, order + 1):
            wanted = (context[block][:, None] << 8 | symbol) & ((1 << 8 * target) - 1)
            known, number = place(target, wanted)
            known &= (lengths[block] >= target - 1)[:, None]
            after[block, 1:] = np.where(known, number, after[block, 1:])
    return Machine(order, column, log, after * np.int32(width), int((lengths < order).sum()))


def unseen_logs(wanted: np.ndarray, known: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 probability of packed (context, symbol), from sorted grams and counts of every context length."""
    out = np.zeros(len(wanted))
    contexts, which = np.unique(wanted >> 8, return_inverse=True)
    by_context = np.argsort(which, kind="stable")
    ends = np.searchsorted(which[by_context], np.arange(0, len(contexts) + 2048, 2048))
    for k, first in enumerate(range(0, len(contexts), 2048)):
        block = contexts[first : first + 2048]
        chance, left = np.zeros((len(block), 256)), np.ones(len(block))
        open_symbols = np.ones((len(block), 256), bool)
        for length in range(len(known) - 1, -1, -1):
            grams_of, counts = known[length]
            start = (block & ((1 << 8 * length) - 1)) << 8
            low, high = np.searchsorted(grams_of, start), np.searchsorted(grams_of, start + 256)
            row = np.repeat(np.arange(len(block)), high - low)
            place = np.arange(len(row)) + np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low)
            own = np.zeros((len(block), 256))
            own[row, grams_of[place] & 255] = counts[place]
            own[~open_symbols] = 0
            seen = own > 0
            kinds, held = seen.sum(axis=1), own.sum(axis=1)
            share = np.where(kinds > 0, left / np.maximum(held, 1), 0.0)
            chance += np.where(seen, own - ESCAPE, 0.0) * share[:, None]
            left = np.where(kinds > 0, share * kinds * ESCAPE, left)
            open_symbols &= ~seen
        chance += np.where(open_symbols, (left / np.maximum(open_symbols.sum(axis=1), 1))[:, None], 0.0)
        mine = by_context[ends[k] : ends[k + 1]]
        row, symbol = which[mine] - first, wanted[mine] & 255
        out[mine] = np.log10(chance[row, symbol] / chance.sum(axis=1)[row])
    return out


def unseen(wanted: DataFrame, sums: DataFrame, order: int) -> DataFrame:
    """(gram, log) of distinct packed (context, symbol) in ``wanted`` (gram), from all contexts."""
    shared = min(order, SHARED)
    top = F.col("length") < shared
    rows = sums.where(top).select("length", "context", "symbol", "n").toArrow()
    length, context, symbol, n = (rows.column(c).to_numpy() for c in ("length", "context", "symbol", "n"))
    short = []
    for k in range(shared):
        here = length == k
        keys = context[here] << 8 | symbol[here]
        at = np.argsort(keys)
        short.append((keys[at], n[here][at]))
    sent = sums.sparkSession.sparkContext.broadcast(short)
    packed = F.shiftleft("context", 8).bitwiseOR(F.col("symbol")).alias("gram")
    asked = F.lit(-1).alias("length")
    both = sums.where(~top).select("length", packed, "n").unionByName(wanted.select(asked, "gram", F.lit(0).cast("long").alias("n")))
    # All parts of a context that are not sent have its last bytes.
    key = F.shiftright("gram", 8).bitwiseAND((1 << 8 * shared) - 1)
    dealt = both.withColumn("key", key).repartition("key").sortWithinPartitions("key", "length", "gram")
    schema = T.StructType([T.StructField("gram", T.LongType()), T.StructField("log", T.DoubleType())])

    def solved(part: pa.RecordBatch) -> pa.RecordBatch:
        kind, gram, n = (part.column(c).to_numpy() for c in ("length", "gram", "n"))
        known = list(sent.value)
        for k in range(shared, order + 1):
            keys, counts = gram[kind == k], n[kind == k]
            at = np.argsort(keys)
            known.append((keys[at], counts[at]))
        asks = gram[kind < 0]
        return batch({"gram": asks, "log": unseen_logs(asks, known)}, schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows in batches:
            held.append(rows)
            size += rows.num_rows
            if size >= CHUNK:
                part = joined(held)
                keys = part.column("key").to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut:
                    yield solved(part.slice(0, cut))
                held, size = [part.slice(cut)], len(keys) - cut
        if size:
            yield solved(joined(held))

    return dealt.mapInArrow(work, schema)


def _narrow(rows: pd.DataFrame) -> pd.DataFrame:
    """The trie as it is sent: bytes where bytes do."""
    return rows.astype({"length": "uint8", "context": "int64", "symbol": "uint8", "n": "int64"})


#: What this worker was sent last, and what it made of it.
_opened: list = []


def _open(sent: tuple, order: int) -> tuple[dict[bytes, float], Machine, np.ndarray, np.ndarray]:
    """Logarithms of the frequent tokens, the machine of a sent trie, and the sorted list, made once in a worker.

    Where the trie is not whole, the machine leaves out what it does not know to the full order.
    """
    if not _opened or _opened[0] is not sent:
        _opened.clear()
        words, counts, rows, partial, grams, gram_logs = sent
        logs = dict(zip(words.to_pylist(), np.log10(counts + ADDED).tolist()))
        machine = compiled(rows, order)
        _opened[:] = [sent, logs, machine.without_short() if partial else machine, grams, gram_logs]
    return tuple(_opened[1:])


def scored(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, contexts: int = CONTEXTS, frequent: int = FREQUENT, most_sent: int = SENT
) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Rows whose crc32 of the id modulo 10 is 0 are held out; all others train, rows without an id
    among them. Null and empty texts consist of the end alone. Repeated rows count as often as they
    occur and are scored one by one. Without training rows the baseline is that of an empty count
    and every byte has an even share. An empty table gives no row.
    """
    held = F.coalesce(crc_share(F.col(id_col), 10) == 0, F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    counts = durable(training_counts(rows.where("NOT held_out"), order))
    is_token = F.col("gram").isNull()
    n, kinds, ends = (
        counts.where(is_token)
        .agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("word").isNull(), F.col("n"))))
        .first()
    )
    n, kinds, ends = n or 0, kinds or 0, ends or 0
    common = _class("n") >= _cutoff(counts.where(is_token & F.col("word").isNotNull()), "n", frequent)[0]
    known = counts.where(is_token & F.col("word").isNotNull() & common).select("word", "n").toArrow().combine_chunks()
    words = known.column("word").combine_chunks()
    sums = levels(counts, order)
    hot, partial = cached(sums, contexts)
    cache = sums.where(hot).select("length", "context", "symbol", "n").toArrow().to_pandas()
    seen = _beyond(sums, hot, order)
    listed = _class("n") >= _cutoff(seen, "n", most_sent)[0]
    grams, logs = (x.combine_chunks().to_numpy() for x in seen.where(listed).select("gram", "log").toArrow().columns)
    in_order = np.argsort(grams)
    sent = docs.sparkSession.sparkContext.broadcast(
        (words, known.column("n").to_numpy(), _narrow(cache), partial, grams[in_order], logs[in_order])
    )
    end_log = float(np.log10(ends + ADDED))
    rare_type = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())]))
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("held_out", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("base", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rare", rare_type),
            T.StructField("cold", T.ArrayType(T.LongType())),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, machine, grams, gram_logs = _open(sent.value, order)
        for part in by_shard(batches, "text", SHARD_BYTES):
            lines = lines_of(utf8(part.column("text")))
            sizes, codes, distinct = words_of(lines)
            value = np.fromiter((logs.get(w, np.nan) for w in distinct), np.float64, len(distinct))
            owner = np.repeat(np.arange(len(lines)), sizes)
            log = value[codes]
            is_rare = np.isnan(log)
            base = np.bincount(owner[~is_rare], log[~is_rare], len(lines)) + end_log
            pair, times = np.unique(owner[is_rare] * max(1, len(distinct)) + codes[is_rare], return_counts=True)
            of, which = pair // max(1, len(distinct)), pair % max(1, len(distinct))
            inner = pa.StructArray.from_arrays(
                [pa.array(distinct, pa.binary()).take(pa.array(which)), pa.array(times.astype(np.int64))], ["word", "n"]
            )
            offsets = np.searchsorted(of, np.arange(len(lines) + 1)).astype(np.int32)
            score, line, gram = machine.score_known(lines)
            if len(grams) and len(gram):
                at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
                found = grams[at] == gram
                score += np.bincount(line[found], gram_logs[at[found]], len(lines))
                line, gram = line[~found], gram[~found]
            cold = np.searchsorted(line, np.arange(len(lines) + 1)).astype(np.int32)
            yield batch(
                {
                    "doc_id": part.column("doc_id"),
                    "held_out": part.column("held_out"),
                    "n_tokens": sizes + 1,
                    "n_known": sizes - np.bincount(owner[is_rare], minlength=len(lines)) + int(ends > 0),
                    "base": base,
                    "score": score,
                    "rare": pa.ListArray.from_arrays(pa.array(offsets), inner),
                    "cold": pa.ListArray.from_arrays(pa.array(cold), pa.array(gram)),
                },
                schema,
            )

    found = durable(rows.mapInArrow(work, schema).withColumn("row", F.monotonically_increasing_id()))
    sent.destroy()  # nothing reads it again: the scores are written
    rare = found.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    others = counts.where(is_token & F.col("word").isNotNull() & ~common).select("word", F.col("n").alias("c"))
    log = F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADDED))
    base = (
        rare.join(others, "word", "left")
        .groupBy("row")
        .agg(F.sum(F.col("times") * log).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("times"))).alias("known"))
    )
    whole = float(np.log10(n + ADDED * (kinds + 1)))
    zero = F.lit(0)
    every = found.drop("rare", "cold").join(base, "row", "left")
    score = F.col("score")
    if partial:
        every = every.join(_cold_scores(found, seen.where(~listed), sums, order), "row", "left")
        score = score + F.coalesce("rest", F.lit(0.0))
    return every.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", zero)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        score.alias("score"),
    )


def _beyond(sums: DataFrame, hot: Column, order: int) -> DataFrame:
    """(gram, n, log) of the symbols after contexts of full length that are not in the cache."""
    gram = F.shiftleft("context", 8).bitwiseOR(F.col("symbol")).alias("gram")
    # A symbol that its longest context has seen needs no escape.
    log = F.log10((F.col("n") - F.lit(ESCAPE)) / F.col("held")).alias("log")
    return sums.where((F.col("length") == order) & ~hot).select(gram, "n", log)


def _cold_scores(found: DataFrame, seen: DataFrame, sums: DataFrame, order: int) -> DataFrame:
    """(row, rest): log10 probability of what neither cache nor list had of each row; ``seen`` is what training saw of it."""
    # Training texts hold nothing unseen.
    asked = found.where("held_out").select(F.explode("cold").alias("gram")).distinct().join(seen, "gram", "left_anti")
    logs = seen.select("gram", "log").unionByName(durable(unseen(asked, sums, order)))
    cold = found.select("row", F.explode("cold").alias("gram"))
    return cold.join(logs, "gram").groupBy("row").agg(F.sum("log").alias("rest"))
