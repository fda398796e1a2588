"""Main text of HTML pages by differencing neighbours.

A page becomes lines, one per block of text. Elements that are certainly no text of the article
(scripts, menus, page headers and footers, sidebars, notices, adverts, forms, comments) give no
lines. Pages of a host are put in the order of their paths; each is aligned with the page before
and the page after it by the longest common subsequence of their lines, and lines that it shares
with either are deleted. Pages with the same lines count as one in that order, so copies do not
delete each other. A neighbour that shares nearly all lines may be a copy (a print or paging variant) or
a page of the same long template with a short text. Lines shared with it are deleted only if they
stand on many distinct pages of the host, as a template does and copies of one text do not.

Where a page marks its article (``article`` or ``main``), its lines are the article's lines. The mark
is a vote for them, so that a neighbour has a line too is not enough to delete it: articles share
paragraphs, and repeated sayings stand in articles everywhere. A shared line inside a marked article
goes if it is the host's own template: on at least half of the host's distinct pages, five or more,
and on no other host.

Only hashes of lines are sorted. A host is not kept together: the sorted table is cut into slices
of equal size, and the rows at the cuts are handed to the slice next to them.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcount.session import durable

from .common import batch, by_shard

SHARD_BYTES = 4 << 20
#: Share of a page's lines beyond which a neighbour may be its copy.
COPY = 0.8
#: Distinct pages of a host, and share of them, on which a line shared with such a neighbour is template.
SPREAD = 5
SPREAD_SHARE = 0.1
#: Share of a host's distinct pages on which a shared line inside a marked article is the host's template.
INSIDE_SHARE = 0.5

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>|[!?/][^>]*+>)", re.S
)
_RAW = {
    name: re.compile(f"</{name}(?=[\\s/>])", re.I)
    for name in ("script", "style", "noscript", "template", "iframe", "textarea", "title", "xmp", "noembed", "noframes")
}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
#: An opening tag ends an open element of these, if that is the innermost block.
_ENDED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_DROPPED = frozenset(
    "aside audio button canvas datalist dialog footer form frameset head map menu nav object optgroup option select svg video".split()
)
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words in class and id that mark what is no article text.
_WORDS = frozenset(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice pager "
    "pagination popup promo promoted promotion recommended related replies share sharing sidebar signup skip social sponsor "
    "sponsored subscribe toolbar".split()
)
_NAMED = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
_KEPT = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())


def _marked(attributes: str, inside: bool) -> bool:
    """True if the attributes say that an element is no article text."""
    for m in _NAMED.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in _ROLES:
            return True
        if name in ("class", "id"):
            words = {w.lower() for w in _SPLIT.split(value)}
            # The header of an article holds its title.
            if words & _WORDS and not (inside and words & _WORDS == {"header"}):
                return True
    return False


class _Reader:
    """Walks the tags of a page and collects its lines."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, bool]] = []
        self.text: list[str] = []
        self.stack: list[str] = []
        self.open: dict[str, int] = {}
        self.dropped = 0  # stack size in which the dropped element was opened, plus one
        self.articles = 0

    def end_block(self) -> None:
        if self.text:
            line = " ".join(entities.unescape("".join(self.text)).split())
            if line:
                self.lines.append((line, self.articles > 0))
            self.text = []

    def pop(self) -> str:
        name = self.stack.pop()
        self.open[name] -= 1
        if self.dropped > len(self.stack):
            self.dropped = 0
        elif not self.dropped and name in ("article", "main"):
            self.articles -= 1
        return name

    def pop_to(self, size: int) -> None:
        while len(self.stack) > size:
            self.pop()

    def innermost(self) -> int:
        """Place of the innermost open block."""
        at = len(self.stack) - 1
        while at >= 0 and self.stack[at] not in _BLOCK:
            at -= 1
        return at

    def start(self, name: str, attributes: str) -> None:
        if name in _BLOCK:
            if not self.dropped:
                self.end_block()
            at = self.innermost()
            if at >= 0 and (self.stack[at] == "p" or self.stack[at] in _ENDED.get(name, ())):
                self.pop_to(at)
                at = self.innermost()
                if name == "tr" and at >= 0 and self.stack[at] == "tr":
                    self.pop_to(at)
        if name in ("article", "main") and self.dropped:
            # A menu or page header that was never closed does not swallow the article.
            if self.stack[self.dropped - 1] in ("nav", "header", "head") and not self.articles:
                self.pop_to(self.dropped - 1)
        if name in _VOID:
            if name == "br" and not self.dropped:
                self.text.append(" ")
            return
        self.stack.append(name)
        self.open[name] = self.open.get(name, 0) + 1
        if self.dropped:
            return
        inside = self.articles > 0
        if name in _DROPPED or (name == "header" and not inside) or (name not in _KEPT and _marked(attributes, inside)):
            self.dropped = len(self.stack)
        elif name in ("article", "main"):
            if name == "article" and attributes and _marked(attributes, False) and "comment" in attributes.lower():
                self.dropped = len(self.stack)
            else:
                self.articles += 1

    def end(self, name: str) -> None:
        if name == "br" and not self.dropped:
            self.text.append(" ")
        if name in _BLOCK and not self.dropped:
            self.end_block()
        if self.open.get(name):
            while self.pop() != name:
                pass


def page_lines(page: str | None) -> list[tuple[str, bool]]:
    """(line, inside a marked article) of every block of a page that may be text, in page order."""
    reader = _Reader()
    if not page:
        return []
    at, last = 0, page.rfind(">") + 1
    while True:
        m = _TAG.search(page, at, max(last, at)) if at < last else None
        text_end = m.start() if m else len(page)
        if text_end > at and not reader.dropped:
            reader.text.append(page[at:text_end])
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            reader.end(name)
        elif name in _RAW:
            if name in _BLOCK and not reader.dropped:
                reader.end_block()
            close = _RAW[name].search(page, at)
            at = page.find(">", close.end()) + 1 if close else len(page)
            if not at:
                break
        else:
            reader.start(name, m[3])
    if not reader.dropped:
        reader.end_block()
    return reader.lines


def common_lines(own: list[int], other: list[int]) -> set[int]:
    """Places in ``own`` that a longest common subsequence with ``other`` uses."""
    head = 0
    while head < min(len(own), len(other)) and own[head] == other[head]:
        head += 1
    tail = 0
    while tail < min(len(own), len(other)) - head and own[-1 - tail] == other[-1 - tail]:
        tail += 1
    used = set(range(head)) | set(range(len(own) - tail, len(own)))
    both = set(own[head : len(own) - tail]) & set(other[head : len(other) - tail])
    a = [k for k in range(head, len(own) - tail) if own[k] in both]
    b = [x for x in other[head : len(other) - tail] if x in both]
    if not a:
        return used
    places: dict[int, int] = {}
    for k, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(b)) - 1

    def rows(start: int, state: int, count: int) -> list[int]:
        out = [state]
        for k in range(start, min(start + count, len(a))):
            hit = state & places[own[a[k]]]
            state = (state + hit | state - hit) & full
            out.append(state)
        return out

    # Every so many rows are kept; those between are worked out again on the way back.
    step = math.isqrt(len(a)) + 1
    kept = [full]
    for start in range(0, len(a), step):
        kept.append(rows(start, kept[-1], step)[-1])
    i, j, block = len(a), len(b), -1
    part: list[int] = []
    while i and j:
        if (i - 1) // step != block:
            block = (i - 1) // step
            part = rows(block * step, kept[block], step)
        mask = (1 << j) - 1
        here, above = part[i - block * step] & mask, part[i - 1 - block * step] & mask
        if here >> (j - 1) & 1:
            j -= 1  # as long without the other's last line
        elif here.bit_count() == above.bit_count():
            i -= 1  # as long without the own last line
        else:
            used.add(a[i - 1])
            i, j = i - 1, j - 1
    return used


def shared_lines(own: list[int], *neighbours: list[int] | None) -> tuple[set[int], set[int]]:
    """Places of lines shared with a neighbour that is no copy, and of others shared with one that may be."""
    out: set[int] = set()
    doubtful: set[int] = set()
    for other in neighbours:
        if other and own:
            shared = common_lines(own, other)
            if len(shared) <= COPY * len(own):
                out |= shared
            else:
                doubtful |= shared
    return out, doubtful - out


def deleted_lines(own: list[int], *neighbours: list[int] | None) -> set[int]:
    """Places of lines shared with a neighbour that is no copy."""
    return shared_lines(own, *neighbours)[0]


def _mark(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def _identity(lines: list[tuple[str, bool]]) -> tuple[list[int], str]:
    """Hashes of the lines, and a digest of them all and of which are inside the article."""
    marks = [_mark(line) for line, _ in lines]
    digest = xxhash.xxh3_128(b"".join(x.to_bytes(8, "little", signed=True) for x in marks) + bytes(inside for _, inside in lines))
    return marks, digest.hexdigest()


#: Host and path of a URL; a missing or odd one is a path without host.
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)"


def _line_table(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, path, digest, inside, marks): one row for each distinct list of lines of a host.

    ``inside`` holds the places of the lines of a marked article and is empty where no article is marked.
    """
    url = F.coalesce(F.col(url_col), F.lit(""))
    rows = pages.select(
        F.lower(F.regexp_extract(url, _HOST, 1)).alias("host"), F.regexp_extract(url, _PATH, 1).alias("path"), F.col(html_col).alias("html")
    )
    schema = T.StructType(
        [
            T.StructField("host", T.StringType()),
            T.StructField("path", T.StringType()),
            T.StructField("digest", T.StringType()),
            T.StructField("inside", T.ArrayType(T.IntegerType())),
            T.StructField("marks", T.ArrayType(T.LongType())),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_shard(batches, "html", SHARD_BYTES):
            found = [page_lines(h) for h in part.column("html").to_pylist()]
            both = [_identity(lines) for lines in found]
            yield batch(
                {
                    "host": part.column("host"),
                    "path": part.column("path"),
                    "digest": [d for _, d in both],
                    "inside": [[k for k, (_, inside) in enumerate(lines) if inside] for lines in found],
                    "marks": [m for m, _ in both],
                },
                schema,
            )

    # The digest holds lines and their places in the article, so pages of a digest differ in their path only.
    least = F.min(F.struct("path", "inside", "marks")).alias("x")
    return rows.mapInArrow(work, schema).groupBy("host", "digest").agg(least).select("host", "digest", "x.path", "x.inside", "x.marks")


_ORDER = ["host", "path", "digest"]


def _sliced(lines: DataFrame) -> DataFrame:
    """The rows in the order of their hosts and paths, with the slice that each is in."""
    return durable(
        lines.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).withColumn("slice", F.spark_partition_id())
    )


def _with_neighbours(sliced: DataFrame) -> DataFrame:
    """Rows with the lines of the rows before and after them in their host."""
    order = _ORDER
    page = F.struct("host", "marks")
    own = Window.partitionBy("slice").orderBy(*order)
    rows = sliced.select("*", F.lag(page).over(own).alias("before"), F.lead(page).over(own).alias("after"))
    # One row per slice: its first and last page, handed to the slices next to it.
    key = F.struct(*order, "marks")
    ends = sliced.groupBy("slice").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    along = Window.orderBy("slice")
    handed = ends.select(
        F.col("slice").alias("at"),
        F.lag(F.struct("last.host", "last.marks")).over(along).alias("left"),
        F.lead(F.struct("first.host", "first.marks")).over(along).alias("right"),
    )
    whole = rows.join(handed, F.col("slice") == F.col("at")).select(
        "host", "digest", "inside", "marks", F.coalesce("before", "left").alias("before"), F.coalesce("after", "right").alias("after")
    )
    same = [F.when(F.col(f"{c}.host") == F.col("host"), F.col(f"{c}.marks")).alias(c) for c in ("before", "after")]
    return whole.select("host", "digest", "inside", "marks", *same)


def boilerplate(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, digest, lost): places of the lines that pages of these lines lose, where there are any."""
    places = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [T.StructField("host", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("marked", T.BooleanType())]
        + [T.StructField("lost", places), T.StructField("doubtful", places), T.StructField("doubtful_marks", T.ArrayType(T.LongType()))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            quads = list(zip(*(part.column(c).to_pylist() for c in ("inside", "marks", "before", "after"))))
            lost, doubtful = [], []
            for inside, *near in quads:
                sure, doubt = shared_lines(*near)
                if inside:
                    sure, doubt = set(), (sure | doubt) & set(inside)
                lost.append(sorted(sure))
                doubtful.append(sorted(doubt))
            yield batch(
                {
                    "host": part.column("host"),
                    "digest": part.column("digest"),
                    "marked": [bool(q[0]) for q in quads],
                    "lost": lost,
                    "doubtful": doubtful,
                    "doubtful_marks": [[q[1][k] for k in doubt] for q, doubt in zip(quads, doubtful)],
                },
                schema,
            )

    sliced = _sliced(_line_table(pages, url_col, html_col))
    found = durable(_with_neighbours(sliced).mapInArrow(work, schema).where((F.size("lost") > 0) | (F.size("doubtful") > 0)))
    doubts = found.where(F.size("doubtful") > 0).select(
        "host", "digest", "marked", F.explode(F.arrays_zip(F.col("doubtful").alias("place"), F.col("doubtful_marks").alias("mark"))).alias("x")
    ).select("host", "digest", "marked", "x.place", "x.mark")
    lost = found.select("host", "digest", "lost").where(F.size("lost") > 0)
    if doubts.isEmpty():
        return lost
    sizes = sliced.groupBy("host").agg(F.count("*").alias("pages"))
    # Pages of a host, and hosts, that have a doubtful line.
    on = sliced.select("host", F.explode(F.array_distinct("marks")).alias("mark")).join(doubts.select("mark").distinct(), "mark", "left_semi")
    lines = on.groupBy("host", "mark").agg(F.count("*").alias("n"))
    hosts = lines.groupBy("mark").agg(F.count("*").alias("hosts"))
    spread = lines.where(F.col("n") >= SPREAD).join(sizes, "host").where(F.col("n") >= SPREAD_SHARE * F.col("pages")).join(hosts, "mark")
    template = (F.col("hosts") == 1) & (F.col("n") >= INSIDE_SHARE * F.col("pages"))
    gone = doubts.join(spread.select("host", "mark", template.alias("template")), ["host", "mark"]).where(~F.col("marked") | F.col("template"))
    more = gone.groupBy("host", "digest").agg(F.collect_list("place").alias("more"))
    none = F.array().cast(places)
    both = F.concat(F.coalesce("lost", none), F.coalesce("more", none)).alias("lost")
    return lost.join(more, ["host", "digest"], "full").select("host", "digest", both)


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", name: str = "text") -> DataFrame:
    """All rows and columns of ``pages`` plus the main text: kept lines, two line ends between them.

    Null and empty pages, and pages of which no line is left, have an empty text. A null or odd URL
    belongs to the host without a name. Repeated rows, and pages of a host with the same lines,
    have the same text. Character references are decoded and white space within a line is one
    space. An empty table gives no row. A column of that name is replaced.
    """
    lost = durable(boilerplate(pages, url_col, html_col))
    kept = [f for f in pages.schema.fields if f.name != name]
    digests = T.StructType([*kept, T.StructField("__host", T.StringType()), T.StructField("__digest", T.StringType()), T.StructField("__lines", T.ArrayType(T.StringType())), T.StructField("__places", T.ArrayType(T.IntegerType()))])
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), _HOST, 1)).alias("__host")
    rows = pages.select(*[F.col(f"`{f.name}`") for f in kept], host)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_shard(batches, html_col, SHARD_BYTES):
            found = [page_lines(h) for h in part.column(html_col).to_pylist()]
            columns = {c: part.column(c) for c in part.schema.names}
            columns["__digest"] = [_identity(lines)[1] for lines in found]
            columns["__places"] = [[k for k, (_, inside) in enumerate(lines) if inside] or list(range(len(lines))) for lines in found]
            columns["__lines"] = [[lines[k][0] for k in own] for lines, own in zip(found, columns["__places"])]
            yield batch(columns, digests)

    read = rows.mapInArrow(work, digests)
    cut = read.join(
        lost, (read["__host"] == lost["host"]) & (read["__digest"] == lost["digest"]), "left"
    )
    staying = F.when(F.col("lost").isNull(), F.col("__lines")).otherwise(
        F.filter("__lines", lambda line, k: ~F.array_contains("lost", F.get("__places", k)))
    )
    return cut.withColumn(name, F.array_join(staying, "\n\n")).select(*[F.col(f"`{f.name}`") for f in kept], name)


def text_digest(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and its number of code points."""
    return main_text(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
