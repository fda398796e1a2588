"""Personal data: patterns, extended by a skip-chain conditional random field.

The patterns give the base spans. Nodes of the field are the tokens that hold a digit or an @; all
other tokens are certain to be no data. A node's potential comes from its shape and its neighbours'
shapes; neighbouring nodes share a chain potential, and nodes that repeat each other or are similar
(same letters and digits, or the same last digits), however far apart in the document, share a skip
potential. Loopy message passing over all of them gives every node its label, and tokens that are
labelled with enough certainty become further spans. Base spans stay, as nodes of known label.

Potentials are trained piecewise: counts of labels by shape, along chains and along skip links, with
the base spans of all documents as labels. Those of the most frequent shapes go to the tasks, the others
are joined to the documents that need them.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from copy import copy
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcount.session import durable

from .common import batch, by_shard

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
#: Keys of each sort of count that go to the tasks; the others are joined.
KEPT = 50_000
#: Weight of the plainer distribution in a smoothed one.
SMOOTH = 5.0
ROUNDS = 12
DAMPING = 0.5
#: Skip links between equal labels that each label has beside those counted: repeats agree.
AGREE = 200.0
#: Certainty that a further span needs.
CERTAIN = 0.9
#: A token of a base span against its label.
KNOWN = 12.0
#: Digits that similar tokens share at the end, and characters that make a repeat worth a link.
TAIL = 7
SHORTEST = 5
SHARD_BYTES = 4 << 20

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A start within a run of digits fails as its first digit does, so only first digits are tried.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_EDGE = ".,;:!?\"'<>[]{}|"
_SHAPES = ((re.compile(r"[A-Za-z]+"), "a"), (re.compile(r"[0-9]{21,}"), "9*"), (re.compile(r"[0-9]"), "9"), (re.compile(r"[^\x00-\x7F]+"), "u"))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 if d > 4 else d * 2
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the patterns, by start, then kind."""
    found = []
    at, after = text.find("@"), 0
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            after = match.end()
            found.append((start, after, 0))
        at = text.find("@", max(at + 1, after))
    if _MARK.search(text):
        if "." in text:
            found += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
        if "+" in text:
            found += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


def nodes_of(text: str) -> list[tuple[int, int]]:
    """(start, end) of the tokens with a digit or @, without punctuation around them."""
    out, mark = [], _MARK.search(text)
    while mark:
        start = mark.start()
        while start and not text[start - 1].isspace():
            start -= 1
        end = mark.end()
        while end < len(text) and not text[end].isspace():
            end += 1
        token = text[start:end]
        core = token.strip(_EDGE)
        first = start + token.find(core) if core else start
        out.append((first, first + len(core)) if core else (start, end))
        mark = _MARK.search(text, end)
    return out


def shape(token: str) -> str:
    """Letters as one a, digits one by one, up to 32 characters of the result."""
    for pattern, mark in _SHAPES:
        token = pattern.sub(mark, token)
    return token[:32]


def skip_keys(token: str) -> list[str]:
    """Under what a token meets its repeats and similar ones."""
    plain = "".join(c for c in token.lower() if c.isalnum())
    digits = "".join(c for c in token if "0" <= c <= "9")
    keys = [plain] if len(plain) >= SHORTEST else []
    if len(digits) >= TAIL:
        keys.append("#" + digits[-TAIL:])
    return keys


class Graph:
    """Nodes, labels and links of a shard's documents."""

    def __init__(self, texts: list[str | None]):
        self.base: list[list[tuple[int, int, int]]] = []
        self.doc: list[int] = []
        self.span: list[tuple[int, int]] = []
        self.label: list[int] = []
        self.shape: list[str] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        for doc, text in enumerate(texts):
            base = base_spans(text) if text else []
            self.base.append(base)
            if text and _MARK.search(text):
                self._add(doc, text, base)

    def _add(self, doc: int, text: str, base: list) -> None:
        first, last_of, after, upto = len(self.span), {}, 0, None
        for start, end in nodes_of(text):
            node = len(self.span)
            while after < len(base) and base[after][1] <= start:
                after += 1
            hits = [b for b in base[after : after + 4] if b[0] < end and b[1] > start]
            self.doc.append(doc)
            self.span.append((start, end))
            self.label.append(hits[0][2] + 1 if hits else 0)
            self.shape.append(shape(text[start:end]))
            # Neighbours in the text: nothing but punctuation and white space between.
            if node > first and not text[upto:start].strip(_EDGE + " \t\r\n\f\v"):
                self.chain.append((node - 1, node))
            upto = end
            for key in skip_keys(text[start:end]):
                if key in last_of and last_of[key] != node:
                    self.skip.append((last_of[key], node))
                last_of[key] = node

    def neighbours(self) -> tuple[list[str], list[str]]:
        before, after = [""] * len(self.span), [""] * len(self.span)
        for a, b in self.chain:
            before[b], after[a] = self.shape[a], self.shape[b]
        return before, after


COUNTS = T.StructType(
    [T.StructField("sort", T.StringType()), T.StructField("key", T.StringType()), T.StructField("label", T.IntegerType()), T.StructField("n", T.LongType())]
)


@dataclass
class Counts:
    """(sort, key, label, n) of the most frequent keys; (sort, key, by) of all others, if any, and all shapes' label shares."""

    top: pd.DataFrame
    rest: DataFrame | None = None
    total: np.ndarray | None = None


def counted(docs: DataFrame, text_col: str = "text", kept: int = KEPT) -> Counts:
    """Labels by shape, by shape and neighbour, and along links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_shard(batches, text_col, SHARD_BYTES):
            g = Graph(rows.column(text_col).to_pylist())
            before, after = g.neighbours()
            n: Counter = Counter()
            for s, b, a, y in zip(g.shape, before, after, g.label):
                n["s", s, y] += 1
                n["b", b + " " + s, y] += 1
                n["a", s + " " + a, y] += 1
            for sort, links in (("c", g.chain), ("k", g.skip)):
                for a, b in links:
                    n[sort, str(g.label[a]), g.label[b]] += 1
            if n:
                yield batch({"sort": [k[0] for k in n], "key": [k[1] for k in n], "label": [k[2] for k in n], "n": list(n.values())}, COUNTS)

    sums = docs.select(text_col).mapInArrow(work, COUNTS).groupBy("sort", "key", "label").agg(F.sum("n").alias("n"))
    whole = sums.groupBy("sort", "key").agg(F.sum("n").alias("n"), F.collect_list(F.struct("label", "n")).alias("by"))
    whole = durable(whole)

    def local(top: DataFrame) -> pd.DataFrame:
        return top.select("sort", "key", F.explode("by").alias("y")).select("sort", "key", "y.label", "y.n").toArrow().to_pandas()

    sizes = {r["sort"]: r["count"] for r in whole.groupBy("sort").count().collect()}
    large = [sort for sort in "sba" if sizes.get(sort, 0) > kept]
    if not large:
        return Counts(local(whole))
    top = whole.where(~F.col("sort").isin(large))
    for sort in large:
        top = top.unionByName(whole.where(F.col("sort") == sort).orderBy(F.desc("n"), "key").limit(kept))
    top = durable(top)
    rest = durable(whole.where(F.col("sort").isin(large)).join(top.select("sort", "key"), ["sort", "key"], "left_anti").select("sort", "key", "by"))
    shares = whole.where("sort = 's'").select("n", F.explode("by").alias("y")).groupBy("y.label").agg(F.sum(F.col("y.n") / F.col("n")).alias("share"))
    total = np.zeros(len(LABELS))
    for r in shares.collect():  # one row per label
        total[r["label"]] = r["share"]
    return Counts(local(top), rest, total)


class Field:
    """Trained potentials and inference."""

    def __init__(self, counts: Counts | pd.DataFrame):
        if isinstance(counts, pd.DataFrame):
            counts = Counts(counts)
        #: Counts that stay in Spark, and those of them that the texts at hand need.
        self.rest = counts.rest
        self.more: dict[tuple[str, str], np.ndarray] = {}
        self.tables: dict[str, dict[str, np.ndarray]] = {k: {} for k in "sback"}
        for r in counts.top.itertuples(index=False):
            self.tables[r.sort].setdefault(r.key, np.zeros(len(LABELS)))[r.label] += r.n
        # What a shape never seen may be: every shape counts once, however frequent it is.
        total = counts.total
        if total is None:
            total = sum((n / n.sum() for n in self.tables["s"].values()), np.zeros(len(LABELS)))
        self.prior = (total + SMOOTH * np.array([0.96, *[0.01] * len(KINDS)])) / (total.sum() + SMOOTH)
        self.link = {sort: self._link(sort) for sort in "ck"}

    def sent(self) -> Field:
        """What goes to the tasks."""
        out = copy(self)
        out.rest = None
        return out

    def lacking(self, text: str | None) -> list[tuple[str, str]]:
        """(sort, key) that a text needs and the tables do not have."""
        g = Graph([text])
        keys = {x for s, b, a in zip(g.shape, *g.neighbours()) for x in (("s", s), ("b", b + " " + s), ("a", s + " " + a))}
        return sorted(x for x in keys if x[1] not in self.tables[x[0]])

    def _link(self, sort: str) -> np.ndarray:
        """Logarithm of how much more often two labels meet than by chance."""
        n = np.zeros((len(LABELS), len(LABELS)))
        for key, row in self.tables[sort].items():
            n[int(key)] += row
        n = n + n.T
        if sort == "k":
            n += AGREE * np.eye(len(LABELS))
        own = n.sum(axis=1) + SMOOTH * self.prior
        chance = np.outer(own, own) / own.sum()
        return np.log((n + SMOOTH * np.outer(self.prior, self.prior) + 0.1) / (chance + 0.1))

    def _chances(self, sort: str, key: str, plain: np.ndarray) -> np.ndarray:
        n = self.tables[sort].get(key)
        if n is None:
            n = self.more.get((sort, key))
        return plain if n is None else (n + SMOOTH * plain) / (n.sum() + SMOOTH)

    def potentials(self, g: Graph) -> np.ndarray:
        out = np.empty((len(g.span), len(LABELS)))
        held: dict[tuple, np.ndarray] = {}
        before, after = g.neighbours()
        for k, key in enumerate(zip(g.shape, before, after)):
            if key not in held:
                s, b, a = key
                plain = self._chances("s", s, self.prior)
                held[key] = (np.log(self._chances("b", b + " " + s, plain)) + np.log(self._chances("a", s + " " + a, plain))) / 2
            out[k] = held[key]
            if g.label[k]:
                out[k] = -KNOWN
                out[k, g.label[k]] = 0
        return out

    def labels(self, g: Graph) -> tuple[np.ndarray, np.ndarray]:
        """Most likely label and its chance for every node, by loopy message passing."""
        own = self.potentials(g)
        belief = own.copy()
        links = np.array(g.chain + g.skip, np.int64).reshape(-1, 2)
        if len(links):
            pair = np.concatenate((np.tile(self.link["c"], (len(g.chain), 1, 1)), np.tile(self.link["k"], (len(g.skip), 1, 1))))
            source = np.concatenate((links[:, 0], links[:, 1]))
            target = np.concatenate((links[:, 1], links[:, 0]))
            pair = np.concatenate((pair, pair.transpose(0, 2, 1)))
            back = np.concatenate((np.arange(len(links)) + len(links), np.arange(len(links))))
            sent = np.zeros((len(source), len(LABELS)))
            for _ in range(ROUNDS):
                belief = own.copy()
                np.add.at(belief, target, sent)
                value = (belief[source] - sent[back])[:, :, None] + pair
                top = value.max(axis=1, keepdims=True)
                fresh = np.log(np.exp(value - top).sum(axis=1)) + top[:, 0]
                fresh -= np.log(np.exp(fresh - fresh.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) + fresh.max(axis=1, keepdims=True)
                sent = DAMPING * sent + (1 - DAMPING) * fresh
            belief = own.copy()
            np.add.at(belief, target, sent)
        chance = np.exp(belief - belief.max(axis=1, keepdims=True)) if len(belief) else belief
        chance /= chance.sum(axis=1, keepdims=True)
        return chance.argmax(axis=1), chance.max(axis=1, initial=0.0)

    def spans(self, texts: list[str | None]) -> list[tuple[list, list]]:
        """(base spans, all spans) of every text."""
        g = Graph(texts)
        more: list[list] = [[] for _ in texts]
        if g.span:
            label, chance = self.labels(g)
            chained = set(g.chain)
            before = -1
            for k in np.flatnonzero((label > 0) & (chance >= CERTAIN) & (np.array(g.label) == 0)).tolist():
                kind, (start, end), own = int(label[k]) - 1, g.span[k], more[g.doc[k]]
                if own and before == k - 1 and (k - 1, k) in chained and own[-1][2] == kind:
                    own[-1] = (own[-1][0], end, kind)
                else:
                    own.append((start, end, kind))
                before = k
        return [(b, sorted(b + m, key=lambda s: (s[0], s[2], s[1]))) for b, m in zip(g.base, more)]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


Finish = Callable[[pa.RecordBatch, list[tuple[list, list]]], pa.RecordBatch]


def _searched(docs: DataFrame, field: Field, schema: T.StructType, finish: Finish, text_col: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(field.sent())
    joined = field.rest is not None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for rows in by_shard(batches, text_col, SHARD_BYTES):
            own.more = {}
            for found in rows.column("__more").to_pylist() if joined else ():
                for r in found or ():
                    n = own.more[r["sort"], r["key"]] = np.zeros(len(LABELS))
                    for y in r["by"]:
                        n[y["label"]] += y["n"]
            yield finish(rows, own.spans(rows.column(text_col).to_pylist()))

    return (_with_rest(docs, field.rest, sent, text_col) if joined else docs).mapInArrow(work, schema)


def _with_rest(docs: DataFrame, rest: DataFrame, sent, text_col: str) -> DataFrame:
    """The rows plus the counts that each needs beyond those sent."""
    rows = durable(docs.withColumn("__row", F.monotonically_increasing_id()))
    wanted = T.StructType([T.StructField("__row", T.LongType()), T.StructField("sort", T.StringType()), T.StructField("key", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_shard(batches, text_col, SHARD_BYTES):
            out = [(row, *x) for row, text in zip(part.column("__row").to_pylist(), part.column(text_col).to_pylist()) for x in sent.value.lacking(text)]
            if out:
                yield batch(dict(zip(wanted.names, zip(*out))), wanted)

    more = F.collect_list(F.struct("sort", "key", "by")).alias("__more")
    found = rows.select("__row", text_col).mapInArrow(work, wanted).join(rest, ["sort", "key"]).groupBy("__row").agg(more)
    return rows.join(found, "__row", "left").drop("__row")


def find_personal_data(docs: DataFrame, field: Field, text_col: str = "text", name: str = "personal") -> DataFrame:
    """All rows and columns of ``docs`` plus the struct ``name``: base and spans, each (start, end, kind).

    Positions are code points, end exclusive. Null and empty texts have no span. Repeated rows are
    worked on one by one. A column of that name is replaced.
    """
    keys = ("start", "end", "kind")
    one = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.IntegerType())]))
    kind = T.StructType([T.StructField("base", one), T.StructField("spans", one)])
    schema = T.StructType([f for f in docs.schema.fields if f.name != name] + [T.StructField(name, kind)])

    def finish(rows: pa.RecordBatch, found: list[tuple[list, list]]) -> pa.RecordBatch:
        both = [{"base": [dict(zip(keys, s)) for s in b], "spans": [dict(zip(keys, s)) for s in m]} for b, m in found]
        columns = {f.name: rows.column(f.name) for f in schema.fields if f.name != name}
        return batch(columns | {name: both}, schema)

    return _searched(docs, field, schema, finish, text_col)


def personal_digest(docs: DataFrame) -> DataFrame:
    """Per row of documents: counts of base spans by kind, their digest, and all spans."""
    schema = T.StructType(
        [docs.schema["doc_id"], *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    )

    def finish(rows: pa.RecordBatch, found: list[tuple[list, list]]) -> pa.RecordBatch:
        columns: dict = {"doc_id": rows.column("doc_id")}
        for k, kind in enumerate(KINDS):
            columns[f"n_{kind}"] = [sum(s[2] == k for s in base) for base, _ in found]
        columns["base_sha256"] = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
        columns["spans"] = [written(spans) for _, spans in found]
        return batch(columns, schema)

    field = Field(counted(docs.select("text")))
    return _searched(docs.select("doc_id", "text"), field, schema, finish, "text")
