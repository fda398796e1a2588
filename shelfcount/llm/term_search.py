"""Ranked lexical search, term at a time with a limit on accumulators.

Texts are searched in shards of bounded size. A shard keeps the postings of the queries' terms: the places
of the texts that hold a term and what it adds to their scores. For each query, terms are taken
rarest first (by document frequency in the whole corpus) and add up into one accumulator per text. Before
a term, the bounds of it and of all terms after it are known (the most that each adds to any text of
the shard). Once they cannot lift a new text to the kth best partial score, no accumulator is created any
more, and the postings that are left only update the ones there are, exactly. The threshold is the better of
the shard's own kth partial score and the kth final score of the shards that the task searched before.

Corpus figures (texts with terms, all terms, document frequencies) are summed over the whole corpus by a first
pass. Both passes read rows where they lie; only sums and each task's best k per query are shuffled.
Queries go to the tasks in blocks of bounded size, with two passes for every block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_TABLE, batch, by_shard, letter_words, utf8

TOP = 10
SHARD_BYTES = 8 << 20
#: (Query, term) pairs that are sent to the tasks at once.
BLOCK_TERMS = 200_000
#: Of the score: part of a text's length in its norm (in hundredths), and the scales of weight, frequency and norm.
LENGTH_PART = 90
WEIGHT_SCALE, FREQUENCY_SCALE = 1000, 1_000_000_000
NORM_FACTOR = 8
#: Not a term's number: the counts of texts with terms and of all terms.
TEXTS, LENGTHS = -1, -2


@dataclass
class Block:
    """Some queries: their ids, their terms as numbers, and the terms in order of number."""

    ids: list
    terms: list[np.ndarray]
    known: list[bytes]


def query_blocks(queries: DataFrame, id_col: str, text_col: str, most: int = BLOCK_TERMS) -> Iterator[Block]:
    """Blocks of about ``most`` (query, term) pairs; rows that share an id, null included, are one query."""
    rows = queries.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("terms", T.ArrayType(T.BinaryType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            terms = [sorted(set(letter_words(t or b""))) for t in utf8(some.column("text"))]
            yield batch({"id": some.column("id"), "terms": terms}, schema)

    single = rows.mapInArrow(work, schema).select("id", F.explode_outer("terms").alias("term")).distinct()
    block, number, held = Block([], [], []), {}, 0
    for name, own in single.groupBy("id").agg(F.collect_list("term")).toLocalIterator():
        block.ids.append(name)
        block.terms.append(np.array([number.setdefault(w, len(number)) for w in sorted(map(bytes, own))], np.int64))
        held += len(own)
        if held >= most:
            block.known = list(number)
            yield block
            block, number, held = Block([], [], []), {}, 0
    if block.ids:
        block.known = list(number)
        yield block


@dataclass
class Postings:
    """The queries' terms in a shard: entries sorted by term and place, and the number of terms of every text."""

    lengths: np.ndarray
    terms: np.ndarray
    places: np.ndarray
    counts: np.ndarray


def shard_postings(texts: list[bytes | None], known: pa.Array) -> Postings:
    """All terms of the shard are counted; those among ``known`` get postings."""
    raw = np.frombuffer(b" ".join([(t or b"").translate(WORD_TABLE) for t in texts]) + b" ", np.uint8)
    sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    letter = np.concatenate(([False], raw != 0x20))
    edges = np.flatnonzero(letter[1:] != letter[:-1])
    begins, ends = edges[::2], edges[1::2]
    upto = np.searchsorted(begins, np.cumsum(sizes))
    lengths = np.diff(np.concatenate(([0], upto)))
    offsets = np.concatenate(([0], np.cumsum(ends - begins)))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(raw[letter[1:]].tobytes())]
    )
    found = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy()
    at = np.flatnonzero(found >= 0)
    owner = np.searchsorted(upto, at, "right")
    key, counts = np.unique(found[at].astype(np.int64) * len(texts) + owner, return_counts=True)
    return Postings(lengths, key // len(texts), key % len(texts), counts)


def weights(n_texts: int, frequency: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * n_texts + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)


def added(postings: Postings, weight: np.ndarray, n_texts: int, n_terms: int) -> np.ndarray:
    """What every posting adds to its text's score, in whole numbers."""
    norm = 100 - LENGTH_PART + (LENGTH_PART * postings.lengths.astype(np.int64) * n_texts) // max(1, n_terms)
    tf = postings.counts.astype(np.int64)
    return weight[postings.terms] * ((FREQUENCY_SCALE * tf) // (1000 * tf + NORM_FACTOR * norm[postings.places]))


@dataclass
class Searched:
    """The accumulators of one query in a shard, and how many were created."""

    scores: np.ndarray
    created: int


def search_shard(lists: list[tuple[np.ndarray, np.ndarray]], size: int, k: int = TOP, floor: int = 0) -> Searched:
    """Scores of the texts that may be among the best ``k``, from posting lists (places, added) rarest term first.

    ``floor`` is a score that a text must reach. A text's score is exact or, if the text has none of the
    best ``k`` places for sure, 0. Equal scores count as reached, so ties are left to the caller.
    """
    scores = np.zeros(size, np.int64)
    bounds = [int(more.max()) if len(more) else 0 for _, more in lists]
    rest = sum(bounds)
    survivors: np.ndarray | None = None
    created = 0
    for (places, more), bound in zip(lists, bounds):
        if survivors is None:
            least = floor
            if created >= k and rest < int(scores.max(initial=0)):
                least = max(least, int(np.partition(scores, size - k)[size - k]))
            if rest < least:
                survivors = np.flatnonzero(scores)
        if survivors is None:
            created += int(np.count_nonzero((scores[places] == 0) & (more > 0)))
            scores[places] += more
        elif len(survivors) * 16 < len(places):
            at = np.minimum(np.searchsorted(places, survivors), len(places) - 1)
            here = places[at] == survivors
            scores[survivors[here]] += more[at[here]]
        else:
            live = scores[places] > 0
            scores[places[live]] += more[live]
        rest -= bound
    return Searched(scores, created)


def _id_order(ids: list) -> list[int]:
    """Rank of every id among ``ids``, ascending, null last."""
    order = {v: k for k, v in enumerate(sorted({v for v in ids if v is not None}))}
    return [order.get(v, len(order)) for v in ids]


class _Best:
    """A task's best k rows per query."""

    def __init__(self, block: Block, k: int):
        self.k = k
        self.rows: list[list[tuple]] = [[] for _ in block.ids]

    def floor(self, query: int) -> int:
        """The kth best score so far."""
        return self.rows[query][-1][0] if len(self.rows[query]) == self.k else 0

    def add(self, query: int, scores: np.ndarray, ids: list) -> None:
        least = max(1, self.floor(query))
        found = np.flatnonzero(scores >= least)
        if len(found) > self.k:
            cut = np.partition(scores[found], len(found) - self.k)[len(found) - self.k]
            found = found[scores[found] >= cut]
        if len(found):
            every = self.rows[query] + [(int(scores[at]), ids[at]) for at in found.tolist()]
            place = _id_order([x[1] for x in every])
            order = sorted(range(len(every)), key=lambda x: (-every[x][0], place[x]))
            self.rows[query] = [every[x] for x in order[: self.k]]


def corpus_counts(docs: DataFrame, block: Block, shard_bytes: int = SHARD_BYTES) -> tuple[int, int, np.ndarray]:
    """Texts with a term, all their terms, and the document frequency of each of the block's terms."""
    sent = docs.sparkSession.sparkContext.broadcast(block.known)
    schema = T.StructType.fromDDL("term long, n long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value, pa.large_binary())
        frequency = np.zeros(len(known), np.int64)
        n_texts = n_terms = 0
        for rows in by_shard(batches, "text", shard_bytes):
            postings = shard_postings(utf8(rows.column("text")), known)
            frequency += np.bincount(postings.terms, minlength=len(known))
            n_texts += int(np.count_nonzero(postings.lengths))
            n_terms += int(postings.lengths.sum())
        held = np.flatnonzero(frequency)
        yield batch({"term": [*held.tolist(), TEXTS, LENGTHS], "n": [*frequency[held].tolist(), n_texts, n_terms]}, schema)

    sums = docs.select("text").mapInArrow(work, schema).groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    total = dict(zip(sums.column("term").to_pylist(), sums.column("n").to_pylist()))
    frequency = np.array([total.get(t, 0) for t in range(len(block.known))], np.int64)
    return total.get(TEXTS, 0), total.get(LENGTHS, 0), frequency


def _block_hits(docs: DataFrame, block: Block, places: range, k: int, shard_bytes: int, schema: T.StructType) -> DataFrame:
    """The best k rows of every task for every query of a block."""
    n_texts, n_terms, frequency = corpus_counts(docs, block, shard_bytes)
    weight = weights(n_texts, frequency)
    # A term that no text has adds nothing.
    rarest = [t[np.argsort(frequency[t], kind="stable")] for t in block.terms]
    rarest = [t[frequency[t] > 0] for t in rarest]
    sent = docs.sparkSession.sparkContext.broadcast((block, rarest, weight, places))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rarest, weight, places = sent.value
        known = pa.array(block.known, pa.large_binary())
        best = _Best(block, k)
        for rows in by_shard(batches, "text", shard_bytes):
            postings = shard_postings(utf8(rows.column("text")), known)
            more = added(postings, weight, n_texts, n_terms)
            edges = np.searchsorted(postings.terms, np.arange(len(known) + 1))
            lists = [(postings.places[a:b], more[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            ids = rows.column("id").to_pylist()
            for query, terms in enumerate(rarest):
                own = [lists[t] for t in terms.tolist() if len(lists[t][0])]
                if own:
                    best.add(query, search_shard(own, len(ids), k, best.floor(query)).scores, ids)
        for at in range(0, len(block.ids), 1000):
            out = [(places[q], block.ids[q], d, s) for q in range(at, min(at + 1000, len(block.ids))) for s, d in best.rows[q]]
            if out:
                yield batch(dict(zip(schema.names, zip(*out))), schema)

    return docs.mapInArrow(work, schema)


def ranked(
    docs: DataFrame,
    queries: DataFrame,
    k: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_col: str = "item_id",
    query_text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The ``k`` highest-scoring rows of ``docs`` for every query: query id, rank, id, score.

    Terms are lower-cased (A-Z only) runs of letters, digits and non-ASCII characters of whole texts. Equal scores are
    ranked by ascending id, null last; rows that share an id are ranked one by one. Query rows that share
    an id, null included, are one query with the terms of all; one without terms, or whose terms no text
    has, gives no row. Null and empty texts have no terms. Ids are numbers or texts; other columns
    are not read, and an empty table on either side gives an empty one.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type, query_type = rows.schema["id"].dataType, queries.schema[query_col].dataType
    schema = T.StructType(
        [T.StructField("query", T.LongType()), T.StructField("of", query_type), T.StructField("id", id_type), T.StructField("score", T.LongType())]
    )
    hits, done = docs.sparkSession.createDataFrame([], schema), 0
    for block in query_blocks(queries, query_col, query_text_col, block_terms):
        places = range(done, done + len(block.ids))
        hits = hits.unionByName(_block_hits(rows, block, places, k, shard_bytes, schema))
        done += len(block.ids)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select(F.col("of").alias(query_col), "rank", F.col("id").alias(id_col), "score")
