"""Lines and records of delimited files, read where they lie.

* ``heads`` opens only the first bytes of every file, many files at a time, through the file system that
  Spark itself reads with.
* ``body`` drops the first lines of every file in the one scan that reads them: a split is read in
  order by one task, so the task that has a file's first split counts its lines. No line is numbered across
  scans and nothing is joined or shuffled.
* ``records`` cuts records whose quoted cells hold line ends, and still splits large files. A first pass counts the
  quote marks of every split. Their running sum says of each split whether it begins inside quotes; then all
  splits are cut at the line ends that have an even number of marks before them. Ends of records that reach into
  another split are put together by a second, small reading of the files concerned, if there are any.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of a file that are looked at first; twice as many each time while they hold no whole first line.
HEAD_BYTES = 4096
#: Files that are opened at the same time.
OPEN_FILES = 32
#: In place of a number of lines: through the first line that is not blank.
HEADER = -1

_BLANK = "".join(map(chr, range(0x21)))


# ---- first lines -------------------------------------------------------------------------------------------


def heads(spark: SparkSession, files: list[str], charset: str) -> list[str | None]:
    """The first line of each file that is not blank, None if there is none; a byte order mark is no part of it.

    ``files`` are paths as ``DataFrame.inputFiles`` gives them. Compressed files are unpacked by their ending.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(name: str) -> str | None:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        system = path.getFileSystem(conf)
        codec = codecs.getCodec(path)
        size = HEAD_BYTES
        while True:
            stream = system.open(path)
            opened = codec.createInputStream(stream) if codec is not None else stream
            try:
                data = bytes(opened.readNBytes(size))
            finally:
                opened.close()
            text = data.decode(charset, "replace").removeprefix("﻿")
            lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            whole = len(data) < size
            found = next((x for x in (lines if whole else lines[:-1]) if x.strip(_BLANK)), None)
            if found is not None or whole:
                return found
            size *= 2

    with ThreadPoolExecutor(OPEN_FILES) as pool:
        return list(pool.map(first_line, files))


# ---- lines in the order of a file --------------------------------------------------------------------------


def _placed(reader: DataFrameReader, path: str | list[str]) -> DataFrame:
    """Lines with their file (as a number), the start of their split, and whether the split ends the file."""
    m = "_metadata."
    ends = F.col(f"{m}file_block_start") + F.col(f"{m}file_block_length") >= F.col(f"{m}file_size")
    return reader.text(path).select(
        "value",
        F.xxhash64(f"{m}file_path").alias("file"),
        F.col(f"{m}file_path").alias("path"),
        F.col(f"{m}file_block_start").alias("start"),
        ends.alias("last"),
    )


@dataclass
class _Split:
    """Where a task is within a file."""

    file: int
    start: int
    last: bool
    left: int
    path: str | None = None
    #: Quote marks so far are odd; the split began inside a record; lines of the record that is open.
    odd: bool = False
    inside: bool = False
    open: list[str] = field(default_factory=list)
    marks: int = 0

    def check(self) -> None:
        if self.left and self.start == 0 and not self.last:
            raise ValueError("the lines to skip do not fit into a file's first split; raise spark.sql.files.maxPartitionBytes")

    def after_head(self, values: pa.Array, lone_returns: bool) -> pa.Array:
        """The lines that are not among those to skip."""
        if not self.left:
            return values
        if self.left > 0 and not lone_returns:
            dropped = min(self.left, len(values))
            self.left -= dropped
            return values.slice(dropped)
        at = 0
        while self.left and at < len(values):
            line = values[at].as_py()
            # With line feeds as the only ends, a line may hold others.
            parts = line.removesuffix("\r").split("\r") if lone_returns else [line]
            if self.left > 0:
                taken = min(self.left, len(parts))
                self.left -= taken
            else:
                blank = next((k for k, p in enumerate(parts) if p.strip(_BLANK)), None)
                taken = len(parts) if blank is None else blank + 1
                self.left = HEADER if blank is None else 0
            if taken < len(parts):
                rest = pa.array(["\r".join(parts[taken:])], values.type)
                return pa.concat_arrays([rest, values.slice(at + 1)])
            at += 1
        return values.slice(at)


def _runs(batches: Iterator[pa.RecordBatch], skip: int) -> Iterator[tuple[_Split, pa.RecordBatch, bool]]:
    """Rows of one split at a time, and whether they are its last ones (then perhaps none)."""
    now: _Split | None = None
    for rows in batches:
        if not rows.num_rows:
            continue
        files, starts = (rows.column(c).to_numpy() for c in ("file", "start"))
        edges = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
        bounds = [0, *edges.tolist(), rows.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            key = int(files[a]), int(starts[a])
            if now is None or (now.file, now.start) != key:
                if now is not None:
                    now.check()
                    yield now, rows.slice(a, 0), True
                now = _Split(*key, rows.column("last")[a].as_py(), skip if key[1] == 0 else 0)
                if "path" in rows.schema.names:
                    now.path = rows.column("path")[a].as_py()
                if "odd" in rows.schema.names:
                    now.odd = now.inside = bool(rows.column("odd")[a].as_py())
            yield now, rows.slice(a, b - a), False
    if now is not None:
        now.check()
        yield now, rows.slice(0, 0), True


def body(reader: DataFrameReader, path: str | list[str], skip: int) -> DataFrame:
    """(value) of every physical line but the first ``skip`` of each file; blank lines count."""
    if not skip:
        return reader.text(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, rows, _ in _runs(batches, skip):
            kept = split.after_head(rows.column("value"), False)
            if len(kept):
                yield pa.RecordBatch.from_arrays([kept], ["value"])

    return _placed(reader, path).drop("path").mapInArrow(work, "value string")


# ---- records over several lines ----------------------------------------------------------------------------


def _counted(skip: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Quote marks per split, those of skipped lines left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for split, rows, done in _runs(batches, skip):
            kept = split.after_head(rows.column("value"), True)
            split.marks += pc.sum(pc.count_substring(kept, '"')).as_py() or 0
            if done:
                found.append((split.file, split.start, split.marks))
        columns = [pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * 3
        yield pa.RecordBatch.from_arrays(columns, ["file", "start", "marks"])

    return work


def _joined(values: pa.Array, ends: np.ndarray) -> pa.Array:
    """The lines up to each end as one value, line feeds between."""
    if len(ends) == len(values):
        return values
    offsets = np.concatenate(([0], ends + 1)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), values), "\n")


def _cut(split: _Split, values: pa.Array) -> tuple[str | None, pa.Array]:
    """The end of a record that began in an earlier split, if it is among the lines, and the whole records."""
    marks = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
    odd = (np.cumsum(marks) + split.odd) & 1
    ends = np.flatnonzero(odd == 0)
    if not len(ends):
        split.open += values.to_pylist()
        split.odd = bool(odd[-1]) if len(odd) else split.odd
        return None, values.slice(0, 0)
    split.odd = bool(odd[-1])
    before, head = split.open, None
    split.open = values.slice(ends[-1] + 1).to_pylist()
    values = values.slice(0, ends[-1] + 1)
    if not before and not split.inside:
        return None, _joined(values, ends)
    first = "\n".join([*before, *values.slice(0, ends[0] + 1).to_pylist()])
    rest = _joined(values.slice(ends[0] + 1), ends[1:] - ends[0] - 1)
    if split.inside:
        split.inside, head = False, first
    else:
        rest = pa.concat_arrays([pa.array([first], values.type), rest])
    return head, rest


def _whole_records(skip: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records that lie in one split; one that the end of the file leaves open is whole too."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, rows, done in _runs(batches, skip):
            values = split.after_head(rows.column("value"), True)
            if len(values):
                _, found = _cut(split, values)
            elif done and split.last and split.open and not split.inside:
                found = pa.array(["\n".join(split.open)], values.type)
            else:
                continue
            if len(found):
                yield pa.RecordBatch.from_arrays([found, pa.array([split.path] * len(found), pa.string())], ["value", "path"])

    return work


def _fragments(skip: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Parts of records that reach over the end of a split; ``begins`` marks the first part of each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "start", "begins", "value"]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.string()]
        for split, rows, done in _runs(batches, skip):
            values = split.after_head(rows.column("value"), True)
            found = []
            if len(values):
                head, _ = _cut(split, values)
                if head is not None:
                    found.append((split.path, split.start, False, head))
            if done and split.open and (split.inside or not split.last):
                found.append((split.path, split.start, not split.inside, "\n".join(split.open)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    return work


def records(reader: DataFrameReader, path: str | list[str], skip: int) -> DataFrame:
    """(value, path): records of all files without their first ``skip`` lines, or through their header.

    A line end inside quotes belongs to the record; the mark count starts after the skipped lines. Line ends
    other than line feeds are left in the value. A file is read by as many tasks as it has splits.
    """
    lines = _placed(reader.option("lineSep", "\n"), path)
    marks = lines.drop("path").mapInArrow(_counted(skip), "file long, start long, marks long")
    in_file = Window.partitionBy("file").orderBy("start")
    before = F.coalesce(F.sum("marks").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    odd = marks.withColumn("odd", before % 2 == 1).filter("odd").select("file", "start", "odd")
    # Only splits after a file's first can begin inside quotes: less of them than splits in the input.
    placed = lines.join(F.broadcast(odd), ["file", "start"], "left").select(*lines.columns, "odd")
    whole = placed.mapInArrow(_whole_records(skip), "value string, path string")
    # Without such a split this side is empty and its scan is left out.
    reaching = F.broadcast(odd.select("file").distinct())
    parts = placed.join(reaching, "file", "left_semi").mapInArrow(_fragments(skip), "path string, start long, begins boolean, value string")
    order = Window.partitionBy("path").orderBy("start", "begins")
    numbered = parts.withColumn("record", F.sum(F.col("begins").cast("int")).over(order))
    collected = F.array_sort(F.collect_list(F.struct("start", "begins", "value")))
    stitched = numbered.groupBy("path", "record").agg(collected.alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    return whole.unionByName(stitched.select(text.alias("value"), "path"))
