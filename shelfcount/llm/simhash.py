"""SimHash near-duplicates through one-wildcard variants of fingerprint halves.

A fingerprint of 64 bits is cut into two halves. If two fingerprints differ in at most three bits,
one of their halves differs in at most one bit. Every distinct fingerprint is therefore indexed
under its halves as they are and under each half with one bit left out; fingerprints that share
such a key are compared. A key keeps 31 or 32 of the bits.

Copies collapse before this: keys are built for distinct fingerprints. Around a large group of near
copies one key may still hold very many of them. Such keys are refined by the same rule on the
other half, cut into two quarters; a refined key leaves at most 17 of the 64 bits open, so its
members are bounded however large the corpus is. Within a key the members are linked by a local
forest, never by all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcount.session import durable

from .common import batch, by_shard, space_words, utf8
from .components import components

#: Words in a shingle, and bits in which linked fingerprints may differ.
SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Members of a key that are compared as they are; larger keys are refined.
KEY_MEMBERS = 20_000
SHARD_BYTES = 4 << 20
#: Shingles of a text that are hashed at once.
PART = 1 << 14


def shingles(text: bytes | None, size: int = SHINGLE) -> tuple[bytes, list[int], list[int]]:
    """Words of a UTF-8 text joined by single spaces, and where its shingles start and end in that."""
    words = space_words(text or b"")
    if not words:
        return b"", [], []
    line = b" ".join(words)
    if len(words) <= size:
        return line, [0], [len(line)]
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    return line, [0, *(e + 1 for e in ends[: len(words) - size])], ends[size - 1 :]


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint: bits set in over half of the shingles' hashes, repeats included."""
    line, starts, ends = shingles(text, size)
    if not starts:
        return 0
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, len(starts), PART):
        part = [digest(line[a:b], SEED) for a, b in zip(starts[k : k + PART], ends[k : k + PART])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(texts: list[bytes | None], size: int = SHINGLE) -> np.ndarray:
    """Signed 64-bit fingerprint of every text."""
    return np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint", size: int = SHINGLE) -> DataFrame:
    """All rows and columns of ``docs`` plus the signed 64-bit fingerprint, 0 for texts without words."""
    schema = T.StructType([f for f in docs.schema.fields if f.name != name] + [T.StructField(name, T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_shard(batches, text_col, SHARD_BYTES):
            columns = {f.name: rows.column(f.name) for f in schema.fields if f.name != name}
            columns[name] = fingerprints(utf8(rows.column(text_col)), size)
            yield batch(columns, schema)

    return docs.mapInArrow(work, schema)


def _half(high: bool) -> Column:
    return F.shiftrightunsigned("f", 32) if high else F.col("f").bitwiseAND(F.lit(0xFFFFFFFF))


def _keys(bits: Column, width: int, tag: int) -> Column:
    """Array of structs (kind, value): the bits as they are, then with each bit left out."""
    whole = F.struct(F.lit(tag).cast("byte").alias("kind"), bits.alias("value"))
    wild = [
        F.struct(F.lit(tag + 1 + k).cast("byte").alias("kind"), bits.bitwiseAND(F.lit(~(1 << k))).alias("value"))
        for k in range(width)
    ]
    return F.array(whole, *wild)


def _forest(members: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links (larger, smaller number) that join exactly the members joined by distances up to ``most``."""
    n = len(members)
    root = np.arange(n)
    links = []
    bare = members.view(np.uint64)
    for k in range(1, n):
        near = np.flatnonzero(np.bitwise_count(bare[:k] ^ bare[k]) <= most)
        if len(near):
            for r in np.unique(root[near]).tolist():
                links.append((int(members[k]), int(members[r])))
                root[root == r] = k
    return links


def _forests(keys: list[str], most: int):
    """Body over rows sorted by key: the forest links of every key's members."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def links(rows: pa.Table) -> pa.RecordBatch:
        prints = rows.column("f").to_numpy()
        new = np.zeros(len(prints), bool)
        new[0] = True
        for k in keys:
            values = rows.column(k).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(prints)))
        two = first[sizes == 2]
        bare = prints.view(np.uint64)
        two = two[np.bitwise_count(bare[two] ^ bare[two + 1]) <= most]
        a, b = prints[two + 1].tolist(), prints[two].tolist()
        for start, size in zip(first[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            for x, y in _forest(prints[start : start + size], most):
                a.append(x)
                b.append(y)
        return batch({"a": a, "b": b}, schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for rows in batches:
            if not rows.num_rows:
                continue
            # The last key of a batch may go on in the next.
            cut = rows.num_rows
            last = [rows.column(k)[rows.num_rows - 1].as_py() for k in keys]
            same_key = np.ones(rows.num_rows, bool)
            for k, v in zip(keys, last):
                same_key &= rows.column(k).to_numpy() == v
            cut = int(np.argmax(same_key))
            if held and cut == 0 and [held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in keys] == last:
                held.append(rows)
                continue
            done = pa.Table.from_batches([*held, rows.slice(0, cut)])
            if done.num_rows:
                yield links(done)
            held = [rows.slice(cut)]
        if held:
            yield links(pa.Table.from_batches(held))

    return work, schema


def links_within(prints: DataFrame, most: int = MAX_BITS, key_members: int = KEY_MEMBERS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``prints.f`` within ``most`` bits.

    ``prints`` holds distinct fingerprints. Keys of up to ``key_members`` members are compared at
    once; keys of more are split by quarters of their other half.
    """
    if most > 3:
        raise ValueError("two halves cover up to three differing bits")
    # Every fingerprint becomes 66 rows, so few files must not mean few tasks.
    spread = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "f")
    keyed = spread.select("f", F.explode(F.concat(_keys(_half(False), 32, 0), _keys(_half(True), 32, 33))).alias("k"))
    keyed = keyed.select("f", "k.kind", "k.value")
    half = F.when(F.col("kind") < 33, _half(False)).otherwise(_half(True))
    # Members that agree in the left-out bit too are together under the whole half already.
    whole = F.col("kind").isin(0, 33)
    sizes = durable(
        keyed.groupBy("kind", "value")
        .agg(F.count("*").alias("members"), F.min(half).alias("least"), F.max(half).alias("most"))
        .where((F.col("members") > 1) & (whole | (F.col("least") != F.col("most"))))
        .select("kind", "value", "members")
    )
    shared = durable(keyed.join(sizes, ["kind", "value"]))
    links = _linked(shared.where(F.col("members") <= key_members), ["kind", "value"], most)
    other = F.when(F.col("kind") < 33, _half(True)).otherwise(_half(False))
    low, high = other.bitwiseAND(F.lit(0xFFFF)), F.shiftright(other, 16)
    refined = (
        shared.where(F.col("members") > key_members)
        .select("f", "kind", "value", F.explode(F.concat(_keys(low, 16, 0), _keys(high, 16, 17))).alias("q"))
        .select("f", "kind", "value", F.col("q.kind").alias("kind2"), F.col("q.value").alias("value2"))
    )
    return links.unionByName(_linked(refined, ["kind", "value", "kind2", "value2"], most))


def _linked(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Forest links of each key's members."""
    work, schema = _forests(keys, most)
    return rows.select(*keys, "f").repartition(*keys).sortWithinPartitions(*keys, "f").mapInArrow(work, schema)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, most: int = MAX_BITS
) -> DataFrame:
    """``id_col``, text fingerprint and component of every row.

    Texts without words (null and empty ones too) have fingerprint zero and are linked like any
    other. Repeated rows and ids stay as they are and share a component. A null id is never a
    component's id; a component of null ids alone has a null id. An empty table gives no row.
    """
    prints = durable(with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), size=size).select("doc_id", "fingerprint"))
    roots = component_roots(prints, most)
    return prints.join(roots, prints["fingerprint"] == roots["f"], "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def component_roots(prints: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """(f, root, component_id) of every distinct fingerprint in ``prints`` (doc_id, fingerprint)."""
    distinct = durable(prints.groupBy(F.col("fingerprint").alias("f")).agg(F.min("doc_id").alias("low")))
    found = durable(components(links_within(distinct.select("f"), most)))
    rooted = distinct.join(found, distinct["f"] == found["node"], "left").select(
        "f", "low", F.coalesce("root", "f").alias("root")
    )
    least = rooted.groupBy(F.col("root").alias("of")).agg(F.min("low").alias("component_id"))
    return rooted.join(least, rooted["root"] == least["of"]).select("f", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, then the smallest row hash.

    A row with a null id is kept only where its component has no other; wholly equal rows are one
    row. Columns stay as they are.
    """
    whole = [F.col(f"`{c}`") for c in docs.columns]
    r1, r2 = F.xxhash64(*whole).alias("__r1"), F.xxhash64(F.lit(1), *whole).alias("__r2")
    slim = durable(
        with_fingerprint(
            docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), r1, r2), size=size
        ).drop("text")
    )
    roots = component_roots(slim.select("doc_id", "fingerprint"), most)
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__r1"), F.col("__r2"))
    best = (
        slim.join(roots, slim["fingerprint"] == roots["f"])
        .groupBy("root")
        .agg(F.min(rank).alias("best"))
        .select(F.col("best.__r1").alias("__r1"), F.col("best.__r2").alias("__r2"))
    )
    kept = docs.select(*whole, r1, r2).join(durable(best), ["__r1", "__r2"], "left_semi")
    return kept.dropDuplicates(["__r1", "__r2"]).select(*whole)
