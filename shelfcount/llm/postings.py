"""Approximate nearest neighbours through balanced posting lists in the table, centroids in memory.

Centroids are fitted on a bounded sample by bisection into equal halves and a few rounds that pull
sizes together. They form a graph of near centroids, which a beam walks to find the closest ones.
Every vector goes to the list of its closest centroid and, if it lies near a border, to further
lists whose centroids are almost as close. A query reads the lists whose centroids are within a
ratio of its closest distance, which the walk collects from the closest on and ends beyond. Border
and ratio are fitted together: of the pairs that reach TARGET recall for ASKED vectors, whose
nearest rows of the whole table are known by brute force, the one with the fewest comparisons.
Lists and sample grow with the square root of the rows.

Lists are rows of a table, cut into blocks of bounded size, as are the queries of a list: a list
that holds a third of all vectors is many blocks, each searched on its own, and only the nearest few
of each block go on. Distances are computed on the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcount.session import durable

from .common import batch

NEAREST = 10
EVERY = 100
SEED = 42
#: Most rows that centroids, graph, border and ratio are fitted on, rows of a small table, and rows for each root.
SAMPLE_ROWS = 200_000
LEAST_SAMPLE = 20_000
SAMPLE_PER_ROOT = 32
#: Lists for each square root of the rows, and rows of the sample that a list needs.
LISTS_PER_ROOT = 4
ROWS_PER_LIST = 8
#: Lists a vector may be in, and how much farther than the closest centroid theirs may be: the values to fit.
COPIES = 4
BORDERS = (0.005, 0.01, 0.02, 0.04, 0.08, 0.12)
#: Vectors whose nearest rows are found by brute force, and the share of these rows that lists must reach. They are drawn
#: from the table apart from the sample: centroids are closer to what they were made of, and rows are so only in part.
ASKED = 400
TARGET = 0.94
LINKS = 16
#: Vectors of a list, and queries to it, that meet in one group.
BLOCK_VECTORS = 20_000
BLOCK_QUERIES = 2_000
CHUNK = 512


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between all rows of two blocks."""
    out = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T
    return np.maximum(out, 0, out)


def bisected(vectors: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
    """Centroids of groups of nearly equal size, by repeated halving along the line of two means."""
    groups = [(np.arange(len(vectors)), lists)]
    centroids = []
    while groups:
        own, parts = groups.pop()
        if parts == 1 or len(own) < 2:
            centroids.append(vectors[own].mean(axis=0))
            continue
        pick = vectors[rng.choice(own, 2, replace=False)]
        for _ in range(4):
            gap = squared(vectors[own], pick)
            order = np.argsort(gap[:, 0] - gap[:, 1], kind="stable")
            half = len(own) * (parts // 2) // parts
            left, right = own[order[:half]], own[order[half:]]
            if not len(left) or not len(right):
                break
            pick = np.stack((vectors[left].mean(axis=0), vectors[right].mean(axis=0)))
        if not len(left) or not len(right):
            centroids.append(vectors[own].mean(axis=0))
            continue
        groups += [(left, parts // 2), (right, parts - parts // 2)]
    return np.array(centroids)


def balanced(vectors: np.ndarray, centroids: np.ndarray, rounds: int = 4, pull: float = 0.05) -> np.ndarray:
    """Centroids moved to their vectors' means, where full groups count as farther away."""
    sizes = np.full(len(centroids), len(vectors) / len(centroids))
    scale = None
    for _ in range(rounds):
        fullness = pull * (sizes / sizes.mean() - 1)
        owner, nearest = np.empty(len(vectors), int), np.empty(len(vectors))
        for start in range(0, len(vectors), 2 * CHUNK):
            own = slice(start, start + 2 * CHUNK)
            near = squared(vectors[own], centroids)
            nearest[own] = near.min(axis=1)
            owner[own] = (near + (nearest[own].mean() if scale is None else scale) * fullness).argmin(axis=1)
        scale = nearest.mean()
        sizes = np.bincount(owner, minlength=len(centroids)).astype(float)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, vectors)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return centroids


def _nearest_rows(rows: np.ndarray, others: np.ndarray, count: int, own: np.ndarray | None = None) -> np.ndarray:
    """Places of the ``count`` nearest of ``others`` for every row, nearest first, but not the place in ``own``."""
    out = np.empty((len(rows), count), int)
    for start in range(0, len(rows), 64):
        gap = squared(rows[start : start + 64], others)
        if own is not None:
            gap[np.arange(len(gap)), own[start : start + 64]] = np.inf
        near = np.argpartition(gap, count - 1, axis=1)[:, :count] if count else np.empty((len(gap), 0), int)
        order = np.argsort(np.take_along_axis(gap, near, axis=1), axis=1, kind="stable")
        out[start : start + 64] = np.take_along_axis(near, order, axis=1)
    return out


@dataclass
class Graph:
    """Centroids with links to near ones; searched by a beam from a few entries."""

    centroids: np.ndarray
    links: np.ndarray
    border: float = BORDERS[0]
    ratio: float = 0.0

    @classmethod
    def of(cls, centroids: np.ndarray) -> Graph:
        n = len(centroids)
        near = _nearest_rows(centroids, centroids, min(LINKS, n - 1), np.arange(n))
        # A ring keeps every centroid reachable.
        ring = np.column_stack(((np.arange(n) + 1) % n, (np.arange(n) - 1) % n))
        return cls(centroids, np.concatenate((near, ring), axis=1))

    def closest(self, vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(lists, distances) of up to ``beam`` close centroids per vector, nearest first; -1 pads."""
        n, beam = len(self.centroids), min(beam, len(self.centroids))
        lists = np.full((len(vectors), beam), -1)
        gaps = np.full((len(vectors), beam), np.inf)
        norms = (self.centroids * self.centroids).sum(axis=1)
        entries = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(int))
        for start in range(0, len(vectors), CHUNK):
            own = vectors[start : start + CHUNK]
            rows = np.arange(len(own))
            seen = np.zeros((len(own), n + 1), bool)
            seen[:, n] = True
            seen[:, entries] = True
            mine = (own * own).sum(axis=1)[:, None]
            known = np.tile(entries, (len(own), 1))
            gap = mine + norms[entries] - 2 * own @ self.centroids[entries].T
            done = np.zeros(known.shape, bool)
            while True:
                # Each vector expands its closest open centroid, if that is in its beam.
                waiting = np.where(done, np.inf, gap)
                pick = waiting.argmin(axis=1)
                live = np.isfinite(waiting[rows, pick])
                if not live.any():
                    break
                done[rows, pick] = True
                fresh = self.links[np.where(live, known[rows, pick], 0)]
                fresh = np.where(live[:, None], fresh, n)
                fresh = np.where(seen[rows[:, None], fresh], n, fresh)
                # A centroid that is linked twice is new once.
                order = np.sort(fresh, axis=1)
                order[:, 1:][order[:, 1:] == order[:, :-1]] = n
                fresh = order
                seen[rows[:, None], fresh] = True
                safe = np.minimum(fresh, n - 1)
                far = mine + norms[safe] - 2 * np.einsum("ij,ikj->ik", own, self.centroids[safe])
                far = np.where(fresh < n, far, np.inf)
                known, gap = np.concatenate((known, fresh), axis=1), np.concatenate((gap, far), axis=1)
                done = np.concatenate((done, fresh >= n), axis=1)
                if known.shape[1] > beam:
                    keep = np.argpartition(gap, beam - 1, axis=1)[:, :beam]
                    known, gap, done = (np.take_along_axis(x, keep, axis=1) for x in (known, gap, done))
            order = np.argsort(gap, axis=1, kind="stable")
            known, gap = np.take_along_axis(known, order, axis=1), np.take_along_axis(gap, order, axis=1)
            known = np.where(np.isfinite(gap), known, -1)
            width = known.shape[1]
            lists[start : start + len(own), :width] = known
            gaps[start : start + len(own), :width] = np.sqrt(np.maximum(gap, 0))
        return lists, gaps

    def member_of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every list that a vector belongs to."""
        lists, gaps = self.closest(vectors, 4 * COPIES)
        lists, gaps = lists[:, :COPIES], gaps[:, :COPIES]
        kept = (lists >= 0) & (gaps <= (1 + self.border) * gaps[:, :1])
        return np.nonzero(kept)[0], lists[kept]

    def lists_for(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every list that a query reads.

        From the closest centroids of a beam on, links are followed from every centroid within the
        ratio; centroids beyond it end the walk.
        """
        n = len(self.centroids)
        rows, found = [], []
        for start in range(0, len(queries), CHUNK):
            own = queries[start : start + CHUNK]
            lists, gaps = self.closest(own, 4 * COPIES)
            edge = ((1 + self.ratio) * gaps[:, 0]) ** 2 * (1 + 1e-9)
            row, at = np.nonzero((lists >= 0) & (gaps * gaps <= edge[:, None]))
            front = row * n + lists[row, at]
            seen = np.zeros(len(own) * n, bool)
            seen[front] = True
            inside = [front]
            while len(front):
                step = (front // n * n)[:, None] + self.links[front % n]
                fresh = np.unique(step[~seen[step]])
                seen[fresh] = True
                near = np.empty(len(fresh), bool)
                for k in range(0, len(fresh), 1 << 16):
                    part = fresh[k : k + (1 << 16)]
                    gap = own[part // n] - self.centroids[part % n]
                    near[k : k + len(part)] = np.einsum("ij,ij->i", gap, gap) <= edge[part // n]
                front = fresh[near]
                inside.append(front)
            every = np.sort(np.concatenate(inside))
            rows.append(every // n + start)
            found.append(every % n)
        if not rows:
            return np.empty(0, int), np.empty(0, int)
        return np.concatenate(rows), np.concatenate(found)


def sample_size(rows: int) -> int:
    """Rows of the sample for a table of ``rows`` vectors."""
    return int(min(SAMPLE_ROWS, max(LEAST_SAMPLE, SAMPLE_PER_ROOT * np.sqrt(rows))))


def fitted(sample: np.ndarray, rows: int) -> Graph:
    """Centroid graph for a table of ``rows`` vectors, from a sample without repeats."""
    lists = int(max(1, min(len(sample) // ROWS_PER_LIST, round(LISTS_PER_ROOT * np.sqrt(rows)))))
    return Graph.of(balanced(sample, bisected(sample, lists, np.random.default_rng(SEED))))


def fit_reach(graph: Graph, sample: np.ndarray, asked: np.ndarray, owner: np.ndarray, wanted: np.ndarray) -> None:
    """Sets border and ratio: ``wanted`` are near vectors of the table, row k one of query ``owner[k]`` of ``asked``."""
    if not len(wanted):
        return
    n = len(graph.centroids)
    near, gaps = graph.closest(sample, 4 * COPIES)
    near, gaps = near[:, :COPIES], gaps[:, :COPIES]
    own, far = graph.closest(wanted, 4 * COPIES)
    own, far = own[:, :COPIES], far[:, :COPIES]
    away = np.sqrt(squared(asked, graph.centroids))
    away = away / np.maximum(away.min(axis=1, keepdims=True), 1e-300) - 1
    fewest = np.inf
    for border in BORDERS:
        kept = (near >= 0) & (gaps <= (1 + border) * gaps[:, :1])
        # The ratio at which a query reads a list of a wanted neighbour.
        held = (own >= 0) & (far <= (1 + border) * far[:, :1])
        reach = np.sort(np.where(held, away[owner[:, None], own], np.inf).min(axis=1))
        ratio = float(reach[int(np.ceil(TARGET * len(reach))) - 1])
        compared = ((away <= ratio) @ np.bincount(near[kept], minlength=n)).mean()
        if compared < fewest:
            fewest, graph.border, graph.ratio = compared, border, ratio
    held = (own >= 0) & (far <= (1 + graph.border) * far[:, :1])
    while graph.ratio < away.max():
        # The walk may miss a list that no link inside the ratio leads to.
        read = np.zeros((len(asked), n), bool)
        read[graph.lists_for(asked)] = True
        if (held & read[owner[:, None], own]).any(axis=1).mean() >= TARGET:
            break
        graph.ratio = graph.ratio * 1.05 + 0.005


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one width as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str, *more: str) -> DataFrame:
    """(id, v, and more) of the rows that take part: an id, and a non-zero, finite vector of the usual width.

    The usual width is that of most such rows, the smaller one of two as frequent.
    """
    v = F.col(vector_col)
    wide = F.transform(v, lambda x: x.cast("double"))
    whole = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v"), *more).where(
        F.col("id").isNotNull() & v.isNotNull() & whole.alias("w") & F.exists(wide, lambda x: x != 0)
    )
    width = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    return rows.where(F.size("v") == (width[0] if width else 0))


def _drawn(rows: DataFrame, total: int, size: int, seed: int) -> pa.ChunkedArray:
    """Vectors of the first ``size`` rows by a seeded hash of their ids."""
    place = F.xxhash64(F.lit(seed), "id")
    # Twice the share of the hashes holds them, unless few ids have most rows.
    low = rows.where(place.cast("double") / F.lit(2.0**64) + 0.5 <= 2.0 * size / total)
    for some in (low, rows):
        found = some.orderBy(place, "id", "v").limit(size).select("v").toArrow().column("v")
        if len(found) >= min(size, total):
            break
    return found


def _true_neighbours(rows: DataFrame, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) of the nearest NEAREST rows of the whole table for each of a few vectors, copies of it aside.

    Each task keeps the best few of its rows.
    """
    sent = rows.sparkSession.sparkContext.broadcast(asked)
    schema = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("gap", T.DoubleType()), rows.schema["v"]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        norms = (own * own).sum(axis=1)[:, None]
        best, held = np.full((len(own), 0), np.inf), np.empty((len(own), 0, own.shape[1]))
        for part in batches:
            here = _vectors(part.column("v")) if part.num_rows else np.empty((0, own.shape[1]))
            for start in range(0, len(here), 4 * CHUNK):
                some = here[start : start + 4 * CHUNK]
                gap = squared(own, some)
                gap[gap <= 1e-12 * norms] = np.inf
                take = np.argpartition(gap, NEAREST, axis=1)[:, :NEAREST] if gap.shape[1] > NEAREST else np.tile(np.arange(gap.shape[1]), (len(own), 1))
                best = np.concatenate((best, np.take_along_axis(gap, take, axis=1)), axis=1)
                held = np.concatenate((held, some[take]), axis=1)
                if best.shape[1] > NEAREST:
                    take = np.argpartition(best, NEAREST - 1, axis=1)[:, :NEAREST]
                    best, held = np.take_along_axis(best, take, axis=1), np.take_along_axis(held, take[:, :, None], axis=1)
        q, k = np.nonzero(np.isfinite(best))
        yield batch({"q": q, "gap": best[q, k], "v": list(held[q, k])}, schema)

    order = Window.partitionBy("q").orderBy("gap", "v")
    near = rows.select("v").mapInArrow(work, schema).withColumn("k", F.row_number().over(order)).where(F.col("k") <= NEAREST)
    found = near.select("q", "v").toArrow()  # at most NEAREST rows for each of ASKED vectors
    return found.column("q").to_numpy(), _vectors(found.column("v")) if found.num_rows else np.empty((0, asked.shape[1]))


def _assigned(rows: DataFrame, graph: Graph, schema: T.StructType, whole: bool, queries: bool) -> DataFrame:
    """Rows (list, id, v), one for every list a vector is in, or is searched for in."""
    sent = rows.sparkSession.sparkContext.broadcast(graph)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if not part.num_rows:
                continue
            here = _vectors(part.column("v"))
            if whole:
                n = len(sent.value.centroids)
                row, lists = np.repeat(np.arange(len(here)), n), np.tile(np.arange(n), len(here))
            else:
                row, lists = sent.value.lists_for(here) if queries else sent.value.member_of(here)
            take = pa.array(row)
            yield batch({"list": lists, "id": part.column("id").take(take), "v": part.column("v").take(take)}, schema)

    return rows.mapInArrow(work, schema)


def _nearest_of(id_type: T.DataType, nearest: int):
    """Cogroup body: the nearest few vectors of a block for every query of a block."""
    schema = T.StructType(
        [T.StructField("query_id", id_type), T.StructField("vec_id", id_type), T.StructField("score", T.DoubleType())]
    )

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        query_ids, ids, scores = [], [], []
        if left.num_rows and right.num_rows:
            order = pc.sort_indices(left, sort_keys=[("id", "ascending")])
            left = left.take(order)
            own, base = left.column("id").to_numpy(), _vectors(left.column("v"))
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            asked, wanted = right.column("id").to_numpy(), _vectors(right.column("v"))
            for start in range(0, len(asked), 64):
                gaps = squared(wanted[start : start + 64], base)
                gaps[asked[start : start + 64, None] == own[None]] = np.inf
                # Each id counts once, with its smallest gap.
                least = np.minimum.reduceat(gaps, first, axis=1) if len(first) < len(own) else gaps
                for k, row in enumerate(gaps):
                    count = min(nearest, int(np.isfinite(least[k]).sum()))
                    if not count:
                        continue
                    edge = np.partition(least[k], count - 1)[count - 1]
                    near = np.flatnonzero(row <= edge + 1e-9 * (1 + edge))
                    exact = np.sqrt(((base[near] - wanted[start + k]) ** 2).sum(axis=1))
                    best = _first_of_each(own[near], exact)[:nearest]
                    query_ids += [asked[start + k]] * len(best)
                    ids += own[near][best].tolist()
                    scores += exact[best].tolist()
        return pa.Table.from_batches([batch({"query_id": query_ids, "vec_id": ids, "score": scores}, schema)])

    return work, schema


def _first_of_each(ids: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """Places in order of distance, then id, each id once."""
    order = np.lexsort((ids, gaps))
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)]


def _search(posts: DataFrame, queries: DataFrame, nearest: int) -> DataFrame:
    """(query_id, vec_id, score), each block's nearest; posts and queries are (list, id, v, pos)."""
    sizes = (
        posts.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("vb"))
        .join(queries.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("qb")), "list")
    )
    blocks = {r["list"]: (r["vb"], r["qb"]) for r in sizes.collect()}  # one row per list, at most SAMPLE_ROWS / ROWS_PER_LIST
    known = queries.sparkSession.createDataFrame([(k, *v) for k, v in blocks.items()], "list int, vb int, qb int")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        cut = rows.join(F.broadcast(known), "list")
        return cut.select(
            "list", F.expr(f"cast(pos % {own} as int)").alias(own), F.explode(F.expr(f"sequence(0, {other} - 1)")).alias(other), "id", "v"
        )

    keys = ["list", "vb", "qb"]
    work, schema = _nearest_of(posts.schema["id"].dataType, nearest)
    return dealt(posts, "vb", "qb").groupBy(*keys).cogroup(dealt(queries, "qb", "vb").groupBy(*keys)).applyInArrow(work, schema)


def neighbours(
    vectors: DataFrame,
    queries: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    nearest: int = NEAREST,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest other vectors found for every query row.

    ``queries`` says which rows are queries; left out, those whose id is divisible by EVERY. Vectors
    that are null, zero, of another width, without an id, or hold null or non-finite components take
    no part. Rows that share an id are one item with several vectors: its distance is the smallest,
    and a query never finds its own id. Equal distances go by id. A query that finds too few in its
    lists is searched in all lists. An empty table, or one without other vectors, gives no row.
    """
    spark = vectors.sparkSession
    wants = (F.col(id_col) % EVERY == 0) if queries is None else queries
    checked = usable(vectors.withColumn("__asked", wants), id_col, vector_col, "__asked")
    rows = checked.select("id", "v")
    id_type = rows.schema["id"].dataType
    out = T.StructType(
        [
            T.StructField("query_id", id_type),
            T.StructField("rank", T.IntegerType()),
            T.StructField("vec_id", id_type),
            T.StructField("score", T.DoubleType()),
        ]
    )
    total = rows.count()
    if not total:
        return spark.createDataFrame([], out)
    known = np.unique(_vectors(_drawn(rows, total, sample_size(total), SEED)), axis=0)
    asked = np.unique(_vectors(_drawn(rows, total, ASKED, SEED + 1)), axis=0)
    graph = fitted(known, total)
    fit_reach(graph, known, asked, *_true_neighbours(rows, asked))
    listed = T.StructType([T.StructField("list", T.IntegerType()), rows.schema["id"], rows.schema["v"]])
    pos = F.monotonically_increasing_id().alias("pos")
    posts = durable(_assigned(rows, graph, listed, False, False).select("*", pos))
    wanted = checked.where("__asked").select("id", "v")
    probes = durable(_assigned(wanted, graph, listed, False, True).select("*", pos))
    found = durable(_ranked(_search(posts, probes, nearest), nearest))
    full = found.groupBy(F.col("query_id").alias("id")).count().where(F.col("count") >= nearest)
    few = wanted.join(full, "id", "left_anti")
    if few.isEmpty():
        return found.select(*out.names)
    rest = durable(_assigned(few, graph, listed, True, True).select("*", pos))
    again = _ranked(_search(posts, rest, nearest), nearest)
    return found.join(full, found["query_id"] == full["id"], "left_semi").unionByName(again).select(*out.names)


def _ranked(found: DataFrame, nearest: int) -> DataFrame:
    """The nearest of all blocks for each query, every id once."""
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
