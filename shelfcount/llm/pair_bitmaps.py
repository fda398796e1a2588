"""Alignment of two tokenizers, with an inverted index of token pairs kept as bitmaps.

Each text (a space in front) is encoded by a byte-level BPE (A) and by a piece BPE with byte fallback (B).
Where tokens of both end at the same byte, the two tokens are linked and the text is cut into groups.

Both tokenizers cut a text between a character that is no white space and a space, and no merge crosses
such a place. So a text is worked out segment by segment, and each distinct segment once for a worker.
(If a vocabulary of B had a piece that goes on after such a place, texts are taken whole.)

The index has one entry for each pair and chunk of texts: the texts' places in the chunk as bitmaps, one
for each binary digit of how often the text holds the pair linked (multiplicity planes). The planes OR-merged
and counted give the documents of a pair; each plane's count, weighted by its digit, gives its links.
The counts go back along the same bitmaps: a text's score is the sum over the pairs whose planes hold it.

Nothing is broadcast but the two vocabularies. A chunk holds at most CHUNK_BYTES of text (or one longer text)
and SLOTS texts, so a hot source or a group of copies is spread like all other rows, and the entries of
a pair that stands in every text are split by chunk.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcount.session import durable

from .common import batch, by_shard, utf8

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Bytes of text worked out at once, and in a chunk of the index.
SHARD_BYTES = 4 << 20
CHUNK_BYTES = 16 << 20
#: Texts in a chunk, a power of two; ids of tokens must stay below ID_LIMIT.
SLOTS = 1 << 14
ID_LIMIT = 1 << 24
#: Distinct segments that a worker remembers; it forgets all of them beyond that.
REMEMBERED = 300_000


# ---- bitmaps -----------------------------------------------------------------------------------------------

_LISTED, _BITS = b"\x00", b"\x01"


def packed(slots: np.ndarray) -> bytes:
    """Ascending places as a list of 16-bit numbers or as bits, whichever is shorter."""
    if not len(slots) or 16 * len(slots) <= int(slots[-1]) + 1:
        return _LISTED + slots.astype("<u2").tobytes()
    bits = np.zeros(int(slots[-1]) + 1, np.uint8)
    bits[slots] = 1
    return _BITS + np.packbits(bits, bitorder="little").tobytes()


def unpacked(bitmap: bytes) -> np.ndarray:
    """The ascending places of a bitmap."""
    if bitmap[:1] == _LISTED:
        return np.frombuffer(bitmap, "<u2", offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8, offset=1), bitorder="little"))


def popcount(bitmap: bytes) -> int:
    if bitmap[:1] == _LISTED:
        return (len(bitmap) - 1) // 2
    return int.from_bytes(bitmap[1:], "little").bit_count()


def or_merged(bitmaps: list[bytes]) -> bytes:
    """The bitmap of places that stand in any of ``bitmaps``."""
    if len(bitmaps) == 1:
        return bitmaps[0]
    if all(b[:1] == _LISTED for b in bitmaps):
        return packed(np.unique(np.concatenate([unpacked(b) for b in bitmaps])))
    every = 0
    for b in bitmaps:
        if b[:1] == _BITS:
            every |= int.from_bytes(b[1:], "little")
        else:
            places = unpacked(b)
            if len(places):
                bits = np.zeros(int(places[-1]) + 1, np.uint8)
                bits[places] = 1
                every |= int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    return _BITS + every.to_bytes((every.bit_length() + 7) // 8, "little")


def planes_of(slots: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Multiplicity planes: bitmap k holds the places whose count has binary digit k."""
    return [packed(slots[counts >> k & 1 == 1]) for k in range(int(counts.max()).bit_length())]


# ---- the two tokenizers --------------------------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level BPE writes for bytes: printable ones stand for themselves, others follow 255."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass
class Vocabularies:
    """What is sent to the tasks: the two files' contents."""

    a_json: str
    b_proto: bytes

    @classmethod
    def read(cls, a_path: str = A_PATH, b_path: str = B_PATH) -> Vocabularies:
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return cls(a.read(), b.read())


class Pair:
    """Both tokenizers over segments of texts."""

    def __init__(self, files: Vocabularies):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(files.a_json)
        self.a.encode_special_tokens = True
        letters = byte_alphabet()
        size = self.a.get_vocab_size()
        entries = json.loads(files.a_json)["model"]["vocab"]
        self.a_bytes = [b""] * size
        for entry, k in entries.items():
            self.a_bytes[k] = bytes(letters[c] for c in entry)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b_proto)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(MARK, " ").encode() for k, p in enumerate(pieces)
        ]
        if max(size, len(pieces)) > ID_LIMIT:
            raise ValueError(f"vocabularies of up to {ID_LIMIT} entries")
        #: No piece goes on with a space after another character.
        self.cuts = not any(" " in p.replace(MARK, " ").lstrip(" ") for p in pieces)
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)

    def encode(self, segments: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B; each segment begins with the space that B adds by itself."""
        texts = [s.decode() for s in segments]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        return a, self.b.encode([t[1:] for t in texts], num_threads=1)


class Known:
    """What a worker remembers of segments, one entry each."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        #: The groups as text, or None if a tokenizer does not give back the segment's bytes.
        self.groups: list[str | None] = []
        self.n_a, self.n_b, self.n_links, self.links = (np.zeros(0, np.int64) for _ in range(4))
        self.first = np.zeros(0, np.int64)

    def numbers(self, segments: list[bytes]) -> np.ndarray:
        """The entry of each of some distinct segments."""
        if len(self.number) > REMEMBERED:
            self.forget()
        new = [s for s in segments if s not in self.number]
        for k in range(0, len(new), 50_000):
            self._add(new[k : k + 50_000])
        return np.fromiter(map(self.number.__getitem__, segments), np.int64, len(segments))

    def _add(self, segments: list[bytes]) -> None:
        pair = self.pair
        self.number.update(zip(segments, range(len(self.number), len(self.number) + len(segments))))
        a, b = pair.encode(segments)
        bad = np.zeros(len(segments), bool)
        if not self._given_back(segments, a, b):
            bad = np.array([not self._given_back([s], [x], [y]) for s, x, y in zip(segments, a, b)])
            a, b = ([[] if no else x for no, x in zip(bad.tolist(), each)] for each in (a, b))
        n_a, n_b = np.fromiter(map(len, a), np.int64, len(a)), np.fromiter(map(len, b), np.int64, len(b))
        flat_a = np.fromiter((k for x in a for k in x), np.int64, n_a.sum())
        flat_b = np.fromiter((k for x in b for k in x), np.int64, n_b.sum())
        # Laid end to end, both tokenizers end at every segment's end.
        _, at_a, at_b = np.intersect1d(
            np.cumsum(pair.a_sizes[flat_a]), np.cumsum(pair.b_sizes[flat_b]), assume_unique=True, return_indices=True
        )
        upto = np.searchsorted(at_a, np.cumsum(n_a))  # groups before the end of each segment
        text_a, text_b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
        groups, i, j = [], 0, 0
        for p, q in zip((at_a + 1).tolist(), (at_b + 1).tolist()):
            left = text_a[i] if p == i + 1 else ",".join(text_a[i:p])
            groups.append(f"{left}|{text_b[j]}" if q == j + 1 else f"{left}|{','.join(text_b[j:q])}")
            i, j = p, q
        edges = [0, *upto.tolist()]
        self.groups += [None if no else ";".join(groups[x:y]) for x, y, no in zip(edges, edges[1:], bad.tolist())]
        n_links = np.diff(edges)
        self.first = np.append(self.first, len(self.links) + np.cumsum(n_links) - n_links)
        self.links = np.append(self.links, flat_a[at_a] * ID_LIMIT + flat_b[at_b])
        self.n_links = np.append(self.n_links, n_links)
        self.n_a, self.n_b = np.append(self.n_a, n_a), np.append(self.n_b, n_b)

    def _given_back(self, segments: list[bytes], a: list[list[int]], b: list[list[int]]) -> bool:
        """Whether both tokenizers give back every segment (their bytes laid end to end are the same)."""
        of_a, of_b = self.pair.a_bytes, self.pair.b_bytes
        sizes = np.cumsum([len(s) for s in segments])
        whole = b"".join(segments)
        for ids, each, lengths in ((a, of_a, self.pair.a_sizes), (b, of_b, self.pair.b_sizes)):
            flat = [k for x in ids for k in x]
            if b"".join([each[k] for k in flat]) != whole:
                return False
            ends = np.append(0, np.cumsum(lengths[flat]))[np.cumsum([len(x) for x in ids])]
            if (ends != sizes).any():
                return False
        return True


def segments_of(texts: list[bytes], cuts: bool = True) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """Segments per text, and all segments; each begins with a space, the first with one put in front.

    A segment ends where a space follows a character that is surely no white space: a visible ASCII one
    or one of the two-byte characters from U+00C0 up. A single space at the end stays with the segment before it.
    """
    spaced = [b" " + t if t else b"" for t in texts]
    sizes = np.fromiter(map(len, spaced), np.int64, len(spaced))
    data = b"".join(spaced)
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[sizes > 0]
    cut = np.zeros(len(data) + 1, bool)
    if cuts:
        raw = np.frombuffer(data, np.uint8)
        visible = (raw > 0x20) & (raw < 0x7F)
        visible[1:] |= (raw[1:] >= 0x80) & (raw[:-1] >= 0xC3) & (raw[:-1] <= 0xDF)
        cut[1:-1] = (raw[1:] == 0x20) & visible[:-1] if len(raw) else False
        cut[ends[sizes > 0] - 1] = False
    cut[starts] = True
    begins = np.flatnonzero(cut[:-1])
    per_text = np.searchsorted(begins, ends) - np.searchsorted(begins, ends - sizes)
    offsets = np.append(begins, len(data)).astype(np.int64)
    return per_text, pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


# ---- index -------------------------------------------------------------------------------------------------


def _shard(texts: list[bytes | None], known: Known) -> tuple[dict[str, list], np.ndarray, np.ndarray]:
    """Columns per text, and (place * pair) links of the shard as places and packed pairs."""
    filled = [t or b"" for t in texts]
    per_text, segments = segments_of(filled, known.pair.cuts)
    coded = segments.dictionary_encode()
    distinct = known.numbers(coded.dictionary.to_pylist())
    codes = coded.indices.to_numpy()
    owner = np.repeat(np.arange(len(filled)), per_text)
    groups = [known.groups[k] for k in distinct.tolist()]
    n_links = known.n_links[distinct]
    bad = np.array([g is None for g in groups], bool)
    good = np.ones(len(filled), bool)
    good[owner[bad[codes]]] = False
    good &= per_text > 0

    def summed(each: np.ndarray) -> np.ndarray:
        return np.where(good, np.bincount(owner, each[codes], len(filled)).astype(np.int64), 0)

    rendered, edges = [], np.concatenate(([0], np.cumsum(per_text)))
    listed = codes.tolist()
    for k, ok in enumerate(good.tolist()):
        rendered.append(";".join([groups[c] for c in listed[edges[k] : edges[k + 1]]]) if ok else "")
    kept = good[owner]
    codes, owner = codes[kept], owner[kept]
    sizes = n_links[codes]
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    pairs = known.links[np.repeat(known.first[distinct][codes], sizes) + inner]
    total = summed(n_links)
    columns = {"n_a": summed(known.n_a[distinct]), "n_b": summed(known.n_b[distinct]), "n_groups": total, "n_links": total, "groups": rendered}
    return columns, np.repeat(owner, sizes), pairs


def _entries(pairs: np.ndarray, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """The distinct pairs of a chunk and their planes, from entries sorted by pair and place."""
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1]))) if len(pairs) else np.zeros(0, np.int64)
    edges = np.append(first, len(pairs)).tolist()
    planes = [planes_of(places[a:b], counts[a:b]) for a, b in zip(edges, edges[1:])]
    return pairs[first], planes


def _index_schema(id_type: T.DataType) -> T.StructType:
    long = T.LongType()
    return T.StructType(
        [
            T.StructField("chunk", long),
            T.StructField("a", T.IntegerType()),
            T.StructField("b", T.IntegerType()),
            T.StructField("planes", T.ArrayType(T.BinaryType())),
            T.StructField("slot", T.IntegerType()),
            T.StructField("id", id_type),
            *[T.StructField(c, long) for c in ("n_a", "n_b", "n_groups", "n_links")],
            T.StructField("groups", T.StringType()),
        ]
    )


def build_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    files: Vocabularies | None = None,
    digest: bool = False,
    shard_bytes: int = SHARD_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    slots: int = SLOTS,
) -> DataFrame:
    """A written table with two kinds of rows: texts (``a`` null) and entries of pairs (``slot`` null).

    ``groups`` is the alignment as text, ``a1,a2|b1;a3|b2`` with ids in order, or with ``digest`` its
    SHA-256 in hex. Null and empty texts, and texts that a tokenizer does not give back byte for
    byte, have no tokens: zeros and an empty ``groups``. Repeated rows are texts of their own, ids may be
    null or repeated, and columns other than the two named are not read.
    """
    schema = _index_schema(docs.schema[id_col].dataType)
    sent = docs.sparkSession.sparkContext.broadcast(files or Vocabularies.read())
    held: list[Known] = []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Known(Pair(sent.value)))
        chunk = TaskContext.get().partitionId() << 32
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        used = size = 0

        def finished() -> Iterator[pa.RecordBatch]:
            pairs, places, counts = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(pairs, kind="stable")  # places ascend from shard to shard
            distinct, planes = _entries(pairs[order], places[order], counts[order])
            for k in range(0, len(distinct), 20_000):
                some = distinct[k : k + 20_000]
                empty = dict.fromkeys(schema.names, [None] * len(some))
                columns = {"chunk": np.full(len(some), chunk), "a": some // ID_LIMIT, "b": some % ID_LIMIT}
                yield batch(empty | columns | {"planes": planes[k : k + 20_000]}, schema)

        for rows in by_shard(batches, "text", shard_bytes):
            for at in range(0, rows.num_rows, slots):
                piece = rows.slice(at, slots)
                texts = utf8(piece.column("text"))
                n = len(texts)
                if parts and (used + n > slots or size >= chunk_bytes):
                    yield from finished()
                    chunk, parts, used, size = chunk + 1, [], 0, 0
                columns, owner, pairs = _shard(texts, held[0])
                if digest:
                    columns["groups"] = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in columns["groups"]]
                key, counts = np.unique(pairs * SLOTS + owner, return_counts=True)
                parts.append((key // SLOTS, key % SLOTS + used, counts))
                empty = dict.fromkeys(schema.names, [None] * n)
                own = {"chunk": np.full(n, chunk), "slot": np.arange(used, used + n), "id": piece.column("id")}
                yield batch(empty | own | columns, schema)
                used += n
                size += sum(len(t or b"") for t in texts)
        if parts:
            yield from finished()

    chosen = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return durable(chosen.mapInArrow(work, schema))


def pair_counts(index: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links) of every pair: its texts and its links, from the bitmaps alone."""
    schema = T.StructType.fromDDL("a int, b int, n_docs long, n_links long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            every = rows.column("planes").to_pylist()
            columns = {
                "a": rows.column("a"),
                "b": rows.column("b"),
                "n_docs": [popcount(or_merged(p)) for p in every],
                "n_links": [sum(popcount(x) << k for k, x in enumerate(p)) for p in every],
            }
            yield batch(columns, schema)

    counted = index.where("a IS NOT NULL").select("a", "b", "planes").mapInArrow(work, schema)
    return counted.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))


def with_best(counts: DataFrame) -> DataFrame:
    """``counts`` and ``best``: whether no pair of the same b has more links. A b has at most one pair per id of A."""
    top = F.max("n_links").over(Window.partitionBy("b"))
    return counts.withColumn("best", F.col("n_links") == top)


def aligned(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    files: Vocabularies | None = None,
    digest: bool = False,
    **options: int,
) -> DataFrame:
    """Per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    ``count_sum`` adds up, over the text's links, how many links of all texts have the same pair; ``n_best``
    counts the links whose pair is the most frequent one of its b, ties included. Rows as in
    ``build_index``; an empty table gives an empty one.
    """
    index = build_index(docs, id_col, text_col, files, digest, **options)
    counts = durable(with_best(pair_counts(index)))
    postings = index.where("a IS NOT NULL").select("chunk", "a", "b", "planes").join(counts.drop("n_docs"), ["a", "b"])
    texts = index.where("slot IS NOT NULL").drop("a", "b", "planes")
    both = postings.select("chunk", "planes", F.col("n_links").alias("links"), "best").unionByName(texts, allowMissingColumns=True)
    fields = _index_schema(index.schema["id"].dataType)
    kept = ["n_a", "n_b", "n_groups", "n_links"]
    long = T.LongType()
    schema = T.StructType(
        [T.StructField(id_col, fields["id"].dataType)]
        + [T.StructField(c, long) for c in [*kept, "n_best", "count_sum"]]
        + [T.StructField("groups", T.StringType())]
    )

    def scored(rows: pa.Table) -> pa.Table:
        """The scores of one chunk's texts."""
        is_text = rows.column("slot").is_valid()
        texts, postings = rows.filter(is_text), rows.filter(rows.column("slot").is_null())
        best, total = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        found = zip(postings.column("planes").to_pylist(), postings.column("links").to_pylist(), postings.column("best").to_pylist())
        for planes, links, is_best in found:
            for k, plane in enumerate(planes):
                places = unpacked(plane)
                total[places] += links << k
                if is_best:
                    best[places] += 1 << k
        slot = texts.column("slot").to_numpy()
        columns = {c: texts.column(c).combine_chunks() for c in [*kept, "groups"]}
        columns |= {id_col: texts.column("id").combine_chunks(), "n_best": best[slot], "count_sum": total[slot]}
        return pa.Table.from_batches([batch(columns, schema)])

    return both.groupBy("chunk").applyInArrow(scored, schema)


def alignment_digest(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """Per row of documents the counts, the scores and the SHA-256 of its groups."""
    return aligned(docs, files=Vocabularies.read(a_path, b_path), digest=True).withColumnRenamed("groups", "groups_sha256")
