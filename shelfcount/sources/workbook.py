"""Workbook (.xlsx) sheets as rows: files are listed by Spark, each is unpacked inside a task.

A workbook is a zip of XML parts; the small reader below streams one sheet, so a task holds
one batch of rows, not a sheet.
"""

from __future__ import annotations

import datetime as dt
import io
import itertools
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from operator import itemgetter
from xml.etree import ElementTree
from xml.sax.saxutils import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..operators.clean import clean_name
from ..operators.sets import union_all
from ..session import durable

BATCH = 10_000
# Built-in date and time number formats of the file format.
DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def column_number(letters: str) -> int:
    """0-based position of a column such as A, Z or AB."""
    n = 0
    for ch in letters.upper():
        n = n * 26 + ord(ch) - 64
    return n - 1


def column_range(usecols: str) -> range:
    first, _, last = usecols.partition(":")
    return range(column_number(first), column_number(last or first) + 1)


def _tag(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _parts(book: zipfile.ZipFile, name: str, wanted: str) -> Iterator[ElementTree.Element]:
    if name in book.namelist():
        with book.open(name) as stream:
            for _, element in ElementTree.iterparse(stream):
                if _tag(element) == wanted:
                    yield element
                    element.clear()


def _text(element: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in element.iter() if _tag(t) == "t")


def _sheet_file(book: zipfile.ZipFile, sheet: str | None) -> str | None:
    relation = {}
    for e in _parts(book, "xl/_rels/workbook.xml.rels", "Relationship"):
        relation[e.get("Id")] = e.get("Target", "")
    for e in _parts(book, "xl/workbook.xml", "sheet"):
        name = "".join(e.get("name", "").lower().split())
        if sheet is None or name == "".join(sheet.lower().split()):
            ref = next(v for k, v in e.attrib.items() if k.rpartition("}")[2] == "id")
            target = relation[ref].lstrip("/")
            return target if target.startswith("xl/") else f"xl/{target}"
    return None


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    custom = {
        int(e.get("numFmtId", "0"))
        for e in _parts(book, "xl/styles.xml", "numFmt")
        if re.search(r"[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", e.get("formatCode", "").lower()))
    }
    found: set[int] = set()
    for formats in _parts(book, "xl/styles.xml", "cellXfs"):
        for i, xf in enumerate(formats):
            if int(xf.get("numFmtId", "0")) in DATE_FORMATS | custom:
                found.add(i)
    return found


def _value(kind: str, raw: str | None, style: str | None, shared: Sequence[str], date_styles: set[int]) -> str | None:
    """Text of a cell that holds a value."""
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(raw)] or None
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind == "n" and int(style or "0") in date_styles:
        day = dt.datetime(1899, 12, 30) + dt.timedelta(days=float(raw))
        return day.replace(microsecond=0).strftime("%Y-%m-%d %H:%M:%S")
    return raw


def _cell(cell: ElementTree.Element, shared: Sequence[str], date_styles: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _text(cell) or None
    raw = next((v.text for v in cell if _tag(v) == "v"), None)
    return _value(kind, raw, cell.get("s"), shared, date_styles)


# Rows and cells as spreadsheet programs write them; a sheet with anything else goes to the XML parser.
_PLAIN = r"([^<&\r]*+(?:&(?:amp|lt|gt|quot|apos);[^<&\r]*+)*+)"
ROW_OR_CELL = re.compile(
    r'<(?:c r="([A-Z]{1,3})\d*+"(?: s="(\d+)")?(?: t="(\w+)")?(?:/>|>(?:<f(?: [^<>]*)?(?:/>|>[^<]*</f>))?'
    rf'(?:<v>{_PLAIN}</v>|<is><t(?: xml:space="preserve")?>{_PLAIN}</t></is>)?</c>)'
    r'|row r="(\d+)"(?: [^<>]*)?/?>|(/row>))'
)
_GROUPS = ROW_OR_CELL.groups + 1
CHUNK = 1 << 20


def _plain_blocks(book: zipfile.ZipFile, target: str) -> Iterator[list[str | None] | None]:
    """The rows of a sheet, cut at the patterns of ``ROW_OR_CELL``, in blocks; ends with None if some are left."""
    with book.open(target) as stream:
        held = stream.read(CHUNK)
        head, found, held = held.partition(b"<sheetData>")
        coding = re.search(rb"""encoding=["']([^"']*)""", head)
        if not found or b"<!" in head or coding and coding.group(1).lower() != b"utf-8":
            yield None
            return
        while True:
            rows, end, rest = held.rpartition(b"</row>")
            if end:
                split = ROW_OR_CELL.split((rows + end).decode("utf-8"))
                # What stands between the patterns may be white space only.
                if "".join(split[::_GROUPS]).strip():
                    yield None
                    return
                yield split
            if rest.lstrip().startswith(b"</sheetData>"):
                return
            more = stream.read(CHUNK)
            if not more:
                yield None
                return
            held = rest + more


def _plain_text(text: str) -> str:
    return unescape(text, {"&quot;": '"', "&apos;": "'"}) if "&" in text else text


def sheet_rows(content: bytes, sheet: str | None, wanted: range) -> Iterator[tuple[int, list[str | None]]]:
    """(line number, cells of the wanted columns as text) of the non-empty rows of one sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        target = _sheet_file(book, sheet)
        if target is None or target not in book.NameToInfo:
            return
        shared = [_text(e) for e in _parts(book, "xl/sharedStrings.xml", "si")]
        styles = _date_styles(book)
        width = len(wanted)
        places: dict[str, int] = {}
        read = line = 0
        for split in _plain_blocks(book, target):
            if split is None:
                break
            cells: list[str | None] = [None] * width
            for column, style, kind, raw, text, number, end in zip(*(split[g::_GROUPS] for g in range(1, _GROUPS))):
                if column is not None:
                    at = places.get(column)
                    if at is None:
                        at = places[column] = column_number(column) - wanted.start
                    if 0 <= at < width:
                        if kind == "inlineStr":
                            cells[at] = _plain_text(text) or None if text else None
                        elif raw is not None:
                            cells[at] = _value(kind or "n", _plain_text(raw) or None, style, shared, styles)
                elif end is None:
                    line, cells = int(number), [None] * width
                    read += 1
                elif cells.count(None) < width:
                    yield line, cells
        else:
            return
        for row in itertools.islice(_parts(book, target, "row"), read, None):
            line = int(row.get("r", line + 1))
            cells = [None] * width
            at = -1
            for c in row:
                ref = re.match(r"[A-Za-z]+", c.get("r", ""))
                at = column_number(ref.group()) if ref else at + 1
                if at in wanted:
                    cells[at - wanted.start] = _cell(c, shared, styles)
            if any(v is not None for v in cells):
                yield line, cells


def workbooks(spark: SparkSession, path: str | list[str], glob: str = "*.xlsx") -> DataFrame:
    """(file, content) of the non-empty workbooks below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.filter(F.col("length") > 0).select(name.alias("file"), "content")


@dataclass(frozen=True)
class Wanted:
    """What is read from one sheet: a table, a block or a title.

    With a header the columns are found by cleaned name, whatever their order, and names a file
    lacks are null; without one they are named by position. ``promote`` moves the header down by
    that many rows, ``max_rows`` bounds the lines after it.
    """

    columns: Sequence[str]
    sheet: str | None = None
    usecols: str = "A:ZZ"
    skip_rows: int = 0
    max_rows: int | None = None
    header: bool = True
    promote: int = 0

    @property
    def top(self) -> int:
        return self.skip_rows + self.promote + (1 if self.header else 0)


def _picked(at: Sequence[int | None], width: int) -> Callable[[list[str | None]], tuple[str | None, ...]]:
    """The cells of a row at the given places; a place that is None, or beyond the row, gives null."""
    places = [width if i is None or i >= width else i for i in at]
    if len(places) < 2:
        return lambda cells: tuple([*cells, None][i] for i in places)
    pick = itemgetter(*places)
    return lambda cells: pick([*cells, None])


def _wanted_rows(content: bytes, wanted: Sequence[Wanted]) -> Iterator[tuple[int | str | None, ...]]:
    """(number of the request, line, cells) of a workbook; a sheet that several want is walked once.

    There are as many cells as the widest request has.
    """
    widest = max(len(w.columns) for w in wanted)

    def filled(at: Sequence[int | None]) -> list[int | None]:
        return [*at, *[None] * (widest - len(at))]

    sheets: dict[str | None, list[int]] = {}
    for k, w in enumerate(wanted):
        sheets.setdefault(w.sheet, []).append(k)
    for sheet, requests in sheets.items():
        ranges = {k: column_range(wanted[k].usecols) for k in requests}
        first, last = min(r.start for r in ranges.values()), max(r.stop for r in ranges.values())
        picks = {k: _picked(filled([None if wanted[k].header else i for i in range(len(wanted[k].columns))]), len(ranges[k])) for k in requests}
        cuts = [(k, wanted[k], slice(ranges[k].start - first, ranges[k].stop - first), len(ranges[k])) for k in requests]
        for line, all_cells in sheet_rows(content, sheet, range(first, last)):
            for k, w, cut, width in cuts:
                if w.max_rows is not None and line > w.top + w.max_rows:
                    continue
                cells = all_cells[cut]
                if cells.count(None) == width:
                    continue
                if w.header and line == w.top:
                    found = {clean_name(v): i for i, v in reversed(list(enumerate(cells))) if v is not None}
                    picks[k] = _picked(filled([found.get(clean_name(c)) for c in w.columns]), width)
                elif line > w.top:
                    yield k, line, *picks[k](cells)


def _read(files: DataFrame, wanted: Sequence[Wanted]) -> DataFrame:
    """(request, file, line, c0, c1, ...) in one pass over ``files(file, content)``."""
    wanted = [replace(w, columns=tuple(w.columns)) for w in wanted]
    names = [f"c{i}" for i in range(max(len(w.columns) for w in wanted))]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"]):
                rows = _wanted_rows(content.as_py(), wanted)
                while some := list(itertools.islice(rows, BATCH)):
                    request, line, *cells = zip(*some)
                    columns = [pa.array(request, pa.int32()), pa.repeat(file, len(some)), pa.array(line, pa.int64())]
                    columns += [pa.array(c, pa.string()) for c in cells]
                    yield pa.record_batch(columns, ["request", "file", "line", *names])

    schema = ["request int", "file string", "line long", *[f"{n} string" for n in names]]
    return files.select("file", "content").mapInArrow(read, ", ".join(schema))


def _named(rows: DataFrame, wanted: Wanted) -> DataFrame:
    cells = [F.col(f"c{i}").alias(c) for i, c in enumerate(wanted.columns)]
    return rows.select("file", "line", *cells)


def read_many(files: DataFrame, wanted: Sequence[Wanted]) -> list[DataFrame]:
    """Several tables, blocks or titles of the same workbooks, each as ``read_workbooks`` gives it.

    The workbooks are parsed once and the wanted cells stored, so whatever is derived from them,
    how often soever, does not parse them again.
    """
    stored = durable(_read(files, wanted))
    return [_named(stored.filter(F.col("request") == k), w) for k, w in enumerate(wanted)]


def read_workbooks(
    files: DataFrame,
    columns: Sequence[str],
    sheet: str | None = None,
    usecols: str = "A:ZZ",
    skip_rows: int = 0,
    max_rows: int | None = None,
    header: bool = True,
    promote: int = 0,
) -> DataFrame:
    """Rows of one sheet of every workbook in ``files(file, content)``.

    Result: ``file``, ``line`` (physical row number) and ``columns``, all text; see ``Wanted``.
    Files without the sheet give no rows.
    """
    wanted = Wanted(columns, sheet, usecols, skip_rows, max_rows, header, promote)
    return _named(_read(files, [wanted]), wanted)


def scan_workbook(spark: SparkSession, path: str | list[str], columns: Sequence[str], **options) -> DataFrame:
    """``read_workbooks`` over a folder; see there for the options."""
    return read_workbooks(workbooks(spark, path), columns, **options)


def sheets_wanted(sheets: Sequence[str], positions: dict[int, str], usecols: str = "A:O", skip_rows: int = 0) -> list[Wanted]:
    """Requests for several sheets whose columns are named by 0-based position."""
    names = [positions.get(i, f"_{i}") for i in range(len(column_range(usecols)))]
    return [Wanted(names, s, usecols, skip_rows, header=False) for s in sheets]


def sheets_union(frames: Sequence[DataFrame], sheets: Sequence[str], positions: dict[int, str]) -> DataFrame:
    """Rows of the sheets of ``sheets_wanted``, tagged with the sheet and united."""
    keep = ["file", "line", *[positions[i] for i in sorted(positions)]]
    return union_all(*[f.select(*keep).withColumn("sheet", F.lit(s)) for f, s in zip(frames, sheets)])


def read_sheets_union(
    files: DataFrame, sheets: Sequence[str], positions: dict[int, str], usecols: str = "A:O", skip_rows: int = 0
) -> DataFrame:
    """Several sheets, columns named by 0-based position, tagged with the sheet and united."""
    return sheets_union(read_many(files, sheets_wanted(sheets, positions, usecols, skip_rows)), sheets, positions)


def title_wanted(sheet: str | None = None) -> Wanted:
    return Wanted(["title"], sheet, "A:A", 0, 1, header=False)


def dated_titles(titles: DataFrame) -> DataFrame:
    """(file, DATE): last word of the first cell, written ``d-Mon-yyyy``; files without such a date are absent."""
    word = F.element_at(F.split(F.trim("title"), r"\s+"), -1)
    return titles.select("file", dates.date_key(word, "d-MMM-yyyy").alias("DATE")).filter(F.col("DATE").isNotNull())


def title_date(files: DataFrame, sheet: str | None = None) -> DataFrame:
    """Dates of the titles of one sheet, see ``dated_titles``."""
    wanted = title_wanted(sheet)
    return dated_titles(_named(_read(files, [wanted]), wanted))


def block_wanted(sheet: str, usecols: str, skip_rows: int, names: Sequence[Sequence[str]]) -> Wanted:
    """Request for a block beside the table: one line for each entry of ``names``."""
    return Wanted([f"c{i}" for i in range(len(names[0]))], sheet, usecols, skip_rows, len(names), header=False)


def block_rows(block: DataFrame, skip_rows: int, names: Sequence[Sequence[str]]) -> DataFrame:
    """A block as one row per file; files with an incomplete block are absent.

    ``names[row][column]`` are the output columns; an empty cell of a complete block reads 0.
    """
    width = len(names[0])
    cells = [f"c{i}" for i in range(width)]

    def pick(row: int, col: int) -> Column:
        value = F.max(F.when(F.col("line") == skip_rows + 1 + row, F.col(cells[col])))
        return F.coalesce(value, F.lit("0")).alias(names[row][col])

    picked = [pick(r, c) for r in range(len(names)) for c in range(width)]
    complete = F.count(F.lit(1)) == len(names)
    for c in cells:
        complete = complete & (F.count(c) > 0)
    out = block.groupBy("file").agg(complete.alias("__ok"), *picked)
    return out.filter("__ok").drop("__ok")


def side_block(
    files: DataFrame, sheet: str, usecols: str, skip_rows: int, names: Sequence[Sequence[str]]
) -> DataFrame:
    """A block beside the table of every workbook, see ``block_rows``."""
    wanted = block_wanted(sheet, usecols, skip_rows, names)
    return block_rows(_named(_read(files, [wanted]), wanted), skip_rows, names)
