"""Delimited text sources. Every column arrives as text; casts come later."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import _col, zfill
from ..operators.clean import clean_cells, clean_name, normalise_names, require, with_constants
from . import lines

LATIN_1 = "ISO-8859-1"
THAI_CODE_PAGES = {"cp874", "windows-874", "tis-620", "tis620"}


def all_strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _thai_tables() -> tuple[str, str, str]:
    """Latin-1 characters of the Thai code page, their Thai letters, and the unused bytes."""
    # The code page puts U+0E01.. at 0xA1 and leaves 0xDB-0xDE, 0xFC-0xFF unused.
    used = [b for b in range(0xA1, 0xFC) if not 0xDB <= b <= 0xDE]
    pairs = {b: chr(0x0E01 + b - 0xA1) for b in used}
    pairs.update({0x80: "€", 0x85: "…", 0x91: "‘", 0x92: "’"})
    pairs.update({0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—"})
    unused = [b for b in range(0x80, 0x100) if b not in pairs and b != 0xA0]
    return "".join(map(chr, pairs)), "".join(pairs.values()), "".join(map(chr, unused))


def decode_thai(c: Column | str, errors: str = "replace") -> Column:
    """Thai text of a column that was read byte by byte as Latin-1.

    Reading as Latin-1 never fails and keeps files splittable. Unused bytes become U+FFFD
    (``replace``) or vanish (``ignore``).
    """
    source, letters, unused = _thai_tables()
    tail = "�" * len(unused) if errors == "replace" else ""
    return F.translate(_col(c), source + unused, letters + tail)


def decode_text(df: DataFrame, charset: str, errors: str = "replace") -> DataFrame:
    """Decode every text column of a Latin-1 read; other charsets were decoded by the reader."""
    if charset.lower() not in THAI_CODE_PAGES:
        return df
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = df.withColumns({c: decode_thai(F.col(f"`{c}`"), errors) for c in names})
    return out


def _options(sep: str) -> dict[str, str]:
    return {"sep": sep, "quote": '"', "escape": '"'}


def _reader(spark: SparkSession, sep: str, encoding: str, glob: str | None):
    thai = encoding.lower() in THAI_CODE_PAGES
    reader = spark.read.options(**_options(sep)).option("encoding", LATIN_1 if thai else encoding)
    return reader.option("pathGlobFilter", glob) if glob else reader


def _text_reader(spark: SparkSession, encoding: str, glob: str | None = None):
    thai = encoding.lower() in THAI_CODE_PAGES
    reader = spark.read.option("encoding", LATIN_1 if thai else encoding)
    return reader.option("pathGlobFilter", glob) if glob else reader


def scan_positional(
    spark: SparkSession,
    path: str | list[str],
    names: Sequence[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    errors: str = "replace",
    glob: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Headerless file with given names; missing trailing cells are null.

    With ``multiline`` quoted cells may hold line ends; a large file is still read by many tasks.
    """
    if multiline:
        rows = _recorded(spark, path, names, sep, encoding, glob, 0).drop("path")
    else:
        rows = _reader(spark, sep, encoding, glob).schema(all_strings(names)).csv(path, header=False)
    return decode_text(rows, encoding, errors)


def _by_header(
    spark: SparkSession,
    path: str | list[str],
    sep: str,
    encoding: str,
    glob: str | None,
    multiline: bool,
    names: Sequence[str] | None,
) -> DataFrame:
    """Rows of files that each have a header of their own; columns by cleaned name, with the file's path.

    A file's header is its first non-blank line, read from its first bytes. All files are read by one scan, whose
    cells are picked by the number of the file's header; columns that a file lacks are null. Without
    ``names`` the columns are all that occur, in the order of the headers as text.
    """
    files = _text_reader(spark, encoding, glob).text(path).inputFiles()
    found = dict(zip(files, lines.heads(spark, files, LATIN_1 if encoding.lower() in THAI_CODE_PAGES else encoding)))
    # One entry for each layout, not for each file.
    layouts = sorted({h for h in found.values() if h is not None})
    parsed = _cells(spark, layouts, sep, encoding)
    every = list(names) if names is not None else list(dict.fromkeys(c for cells in parsed for c in cells))
    wanted = {clean_name(n): n for n in every}
    if not layouts:
        empty = T.StructType([*all_strings(every).fields, T.StructField("__path", T.StringType())])
        return spark.createDataFrame([], empty)
    cells = [f"_{k}" for k in range(max([1, *map(len, parsed)]))]
    if multiline:
        rows = _recorded(spark, path, cells, sep, encoding, glob, lines.HEADER).withColumnRenamed("path", "__path")
    else:
        reader = _reader(spark, sep, encoding, glob).schema(all_strings(cells))
        rows = reader.csv(path, header=True).select("*", F.col("_metadata.file_path").alias("__path"))
    if len(layouts) > 1:
        number = {h: k for k, h in enumerate(layouts)}
        # The scan names files of a system without a host with fewer slashes than the list of files does.
        pairs = [(re.sub("^([^:/]+):///", r"\1:/", f), number[h]) for f, h in found.items() if h is not None]
        table = pa.table([pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs], pa.int32())], ["__path", "__layout"])
        # One row for each file; Spark knows its size and sends it to the tasks if it is small.
        rows = rows.join(spark.createDataFrame(table), "__path", "left")
        late = F.raise_error(F.concat(F.lit("a file came after the headers were read: "), "__path")).cast("int")
        rows = rows.withColumn("__layout", F.coalesce("__layout", late))
    places: dict[str, dict[int, list[int]]] = {}
    for layout, cells in enumerate(parsed):
        for cell in dict.fromkeys(cells):
            places.setdefault(cell, {}).setdefault(cells.index(cell), []).append(layout)

    def picked(name: str) -> Column:
        """The cell of that name by the file's layout."""
        cell = F.lit(None).cast("string")
        for place, of in places.get(name, {}).items():
            here = F.col(f"_{place}")
            cell = here if len(layouts) == 1 else F.when(F.col("__layout").isin(of), here).otherwise(cell)
        return cell

    return rows.select(*[picked(c).alias(n) for c, n in wanted.items()], "__path")


def _cells(spark: SparkSession, headers: Sequence[str], sep: str, encoding: str) -> list[list[str]]:
    """Cleaned names of header lines, as the reader would cut them; later repeats get no column."""
    if not headers:
        return []
    width = max(h.count(sep) + 1 for h in headers)
    table = spark.createDataFrame(list(enumerate(headers)), "number int, value string")
    decoded = decode_text(_parsed(table, [f"_{k}" for k in range(width)], sep, "number"), encoding)
    out = []
    for row in decoded.orderBy("number").drop("number").collect():
        found = [clean_name(c) if c is not None else "" for c in row]
        while found and not found[-1]:
            found.pop()
        out.append(found)
    return out


def _parsed(rows: DataFrame, names: Sequence[str], sep: str, *kept: str) -> DataFrame:
    """Cells of the lines in ``value``, beside the columns that are kept; blank lines are no rows."""
    cells = F.from_csv("value", ",".join(f"`{n}` string" for n in names), _options(sep))
    filled = rows.filter(F.col("value").rlike(r"[^\x00-\x20]"))
    return filled.select(*kept, cells.alias("__cells")).select(*kept, "__cells.*")


def _recorded(
    spark: SparkSession, path: str | list[str], names: Sequence[str], sep: str, encoding: str, glob: str | None, skip: int
) -> DataFrame:
    """Cells of records whose quoted cells may hold line ends, and ``path``, the file they are from."""
    rows = _unbroken(lines.records(_text_reader(spark, encoding, glob), path, skip))
    return _with_breaks(_parsed(rows, names, sep, "path"), names)


def scan_headered(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    errors: str = "replace",
    glob: str | None = None,
    quotes: str = "edges",
    multiline: bool = False,
) -> DataFrame:
    """Files with headers; names lower-cased, quote marks stripped from names and cells.

    Every file is read by its own header, whatever its order.
    """
    raw = _by_header(spark, path, sep, encoding, glob, multiline, None).drop("__path")
    return clean_cells(normalise_names(decode_text(raw, encoding, errors)), quotes)


def scan_pipe(
    spark: SparkSession,
    path: str | list[str],
    names: Sequence[str],
    encoding: str = "cp874",
    store: str | None = "stcode",
    store_width: int = 3,
    multiline: bool = False,
    **constants: object,
) -> DataFrame:
    """Pipe-separated master file with padded store code and constant columns."""
    df = scan_positional(spark, path, names, sep="|", encoding=encoding, multiline=multiline)
    if store:
        df = df.withColumn(store, zfill(store, store_width))
    return with_constants(df, **constants)


#: Stand for line ends inside quoted cells while records are cut; private-use characters.
BREAKS = "\uf8fe\uf8ff"


def _unbroken(rows: DataFrame) -> DataFrame:
    """Records of one line each: line ends inside quotes are written as ``BREAKS``, others end the record."""
    # Every second part between quote marks is inside a cell.
    parts = F.transform(F.split("value", '"'), lambda x, k: F.when(k % 2 == 1, F.translate(x, "\r\n", BREAKS)).otherwise(x))
    lines = F.explode(F.split(F.array_join(parts, '"'), r"\r\n|\r|\n"))
    return rows.select(*[c for c in rows.columns if c != "value"], lines.alias("value"))


def _with_breaks(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    return rows.withColumns({n: F.translate(F.col(f"`{n}`"), BREAKS, "\r\n") for n in names})


def scan_skip(
    spark: SparkSession,
    path: str | list[str],
    names: Sequence[str],
    skip: int = 1,
    key: str | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
    multiline: bool = False,
) -> DataFrame:
    """Drop the first ``skip`` physical lines of every file, then rows lacking ``key``.

    Blank lines count as lines; blank lines after them are no rows. With ``multiline`` quoted cells
    may hold line ends. Lines are dropped in the scan that reads them; they must lie in a file's first split.
    """
    reader = _text_reader(spark, encoding)
    body = _unbroken(lines.records(reader, path, skip)) if multiline else lines.body(reader, path, skip)
    parsed = F.from_csv("value", ",".join(f"`{n}` string" for n in names), _options(sep))
    df = body.filter(F.trim("value") != "").select(parsed.alias("r")).select("r.*")
    df = decode_text(_with_breaks(df, names) if multiline else df, encoding)
    return require(df, [key]) if key else df


def scan_folder(
    spark: SparkSession,
    folder: str,
    names: Sequence[str],
    suffixes: Sequence[str] = (".csv", ".txt"),
    sep: str = ",",
    encoding: str = "UTF-8",
    header: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """All files of a folder with the given endings, plus the file each row came from.

    With a header, ``names`` are found in every file's own header; a file that lacks one has nulls.
    Empty files hold no rows and drop out by themselves.
    """
    endings = ",".join(s.lstrip(".") for s in suffixes)
    glob = f"*.{{{endings}}}" if len(suffixes) > 1 else f"*.{endings}"
    if header:
        df = _by_header(spark, folder, sep, encoding, glob, multiline, names).withColumnRenamed("__path", "path")
    elif multiline:
        df = _recorded(spark, folder, names, sep, encoding, glob, 0)
    else:
        reader = _reader(spark, sep, encoding, glob).schema(all_strings(names))
        df = reader.csv(folder, header=False).select("*", F.col("_metadata.file_path").alias("path"))
    # Paths are written as in a link, where a plus sign is no space.
    decoded = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    return decode_text(df.withColumn("file", F.element_at(F.split(decoded, "/"), -1)).drop("path"), encoding)
