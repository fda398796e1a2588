"""What the operators share: reading tables, byte words, Arrow batches, durable cuts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that op texts treat as letters of a word: digits, a-z and everything above ASCII; A-Z become a-z.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def letter_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text."""
    return text.translate(WORD_TABLE).split()


def space_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text."""
    return text.lower().split()


def utf8(values: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of a text column, null kept."""
    return values.cast(pa.binary()).to_pylist()


def arrow_type(kind: T.DataType) -> pa.DataType:
    """Arrow's type for a Spark type, as Spark's own Arrow transfer expects it."""
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def batch(columns: dict[str, object], schema: T.StructType) -> pa.RecordBatch:
    """A record batch of ``schema`` by name; Arrow arrays come from Spark and stay as they are."""
    arrays = []
    for field in schema.fields:
        values = columns[field.name]
        arrays.append(values if isinstance(values, pa.Array) else pa.array(values, type=arrow_type(field.dataType)))
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def by_shard(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Regroup a task's rows so that the texts of each piece hold about ``limit`` bytes.

    A piece ends after the row that reaches the limit, so one longer text is a piece of its own.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for rows in batches:
        if not rows.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(rows.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        start, done = 0, 0
        while start < rows.num_rows:
            stop = int(np.searchsorted(ends, done + limit - size, "left")) + 1
            if stop > rows.num_rows:
                held.append(rows.slice(start))
                size += int(ends[-1]) - done
                break
            held.append(rows.slice(start, stop - start))
            yield joined(held)
            held, size = [], 0
            start, done = stop, int(ends[stop - 1])
    if held:
        yield joined(held)


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Several record batches as one."""
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def crc_share(column: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; null for a null id."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(parts)


def same(left: Column, right: Column) -> Column:
    """Equality that holds for two nulls."""
    return left.eqNullSafe(right)
