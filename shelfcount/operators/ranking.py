"""Numbering, filling and picking rows inside groups.

A store, stocktake or location may hold a large share of all rows, so no operator here
hands a whole group to one task:

* picking one row per group is ``row_number() = 1``, which Spark cuts to one row per group
  and map task before it shuffles;
* numbering and filling deal the rows once, by ranges of keys and order, which cut a large group wherever a
  range ends. A range is worked through in order by one task; what earlier ranges contribute to a range's first
  group (rows so far, last values) is a prefix sum over the few groups that reach over the end of a range,
  one row per range, and is broadcast.

The exchange is in the plan once and used again for the contributions, so the rows are made once and
even an input that is not repeatable is numbered without gaps. All of a row travels in one column through the
exchange: otherwise Spark would leave out columns on one side only and deal the rows twice. Should that happen
nevertheless (``spark.sql.exchange.reuse`` off), the counts of the two sides differ and the job fails.
Nothing runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import per_key

ROW = "__row"
SLICE = "__slice"
GROUP = "__group"


@dataclass(frozen=True)
class Down:
    """A column that is ordered from its highest value down, nulls last."""

    name: str


def _cols(order: Sequence[str | Down]) -> list[Column]:
    return [F.col(f"`{c.name}`").desc() if isinstance(c, Down) else F.col(f"`{c}`").asc() for c in order]


def _names(order: Sequence[str | Down]) -> list[str]:
    return [c.name if isinstance(c, Down) else c for c in order]


def _group(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`").alias(f"k{n}") for n, c in enumerate(keys)]) if keys else F.struct(F.lit(0).alias("k0"))


def _dealt(df: DataFrame, keys: Sequence[str], order: Sequence[str | Down]) -> DataFrame:
    """(row, slice): whole rows dealt by ranges of keys and order; slices rise with both."""
    whole = df.select(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(ROW))

    def at(c: str | Down) -> Column:
        cell = F.col(ROW)[0][c.name if isinstance(c, Down) else c]
        return cell.desc() if isinstance(c, Down) else cell.asc()

    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = whole.repartitionByRange(slices, *[at(c) for c in [*keys, *order]])
    return ranged.withColumn(SLICE, F.spark_partition_id())


def _sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str | Down]) -> DataFrame:
    """Rows with the number of their slice."""
    return _rows(_dealt(df, keys, order), df.columns)


def _rows(dealt: DataFrame, columns: Sequence[str], *more: str) -> DataFrame:
    return dealt.select(*[F.col(ROW)[0][c].alias(c) for c in columns], SLICE, *more)


def _reaching(sliced: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(slice, rows, first group) of every slice, and the groups that reach over the end of a slice."""
    group = _group(keys).alias(GROUP)
    ends = sliced.select(SLICE, group).groupBy(SLICE).agg(
        F.count(F.lit(1)).alias("__n"), F.min(GROUP).alias("__first"), F.max(GROUP).alias("__last")
    )
    before = F.lag("__last").over(Window.orderBy(SLICE))
    over = ends.withColumn("__before", before).filter(F.col("__before").eqNullSafe(F.col("__first")))
    return ends.select(SLICE, "__n", "__first"), over.select(F.col("__first").alias("__of")).distinct()


def _contributions(
    sliced: DataFrame, keys: Sequence[str], own: Sequence[Column], so_far: Callable[[Column, str], Column]
) -> DataFrame:
    """(slice, rows, contributions): per slice what earlier slices hold of its first group; null if nothing.

    ``own`` are aggregates of the rows that a slice has of such a group; ``so_far`` adds one up over a window.
    """
    ends, over = _reaching(sliced, keys)
    parts = sliced.withColumn(GROUP, _group(keys)).join(F.broadcast(over), F.col(GROUP).eqNullSafe(F.col("__of")))
    sums = parts.groupBy(SLICE, GROUP).agg(*own)
    names = [c for c in sums.columns if c not in (SLICE, GROUP)]
    earlier = Window.partitionBy(GROUP).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(F.col(SLICE).alias("__s"), F.col(GROUP).alias("__g"), *[so_far(F.col(c), c).over(earlier).alias(c) for c in names])
    same = (F.col(SLICE) == F.col("__s")) & F.col("__first").eqNullSafe(F.col("__g"))
    return ends.join(carried, same, "left").select(F.col(SLICE).alias("__at"), "__n", *names)


def _in_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Down], own: Sequence[Column], so_far: Callable[[Column, str], Column]
) -> DataFrame:
    """Rows in order within their slices, with the slice's rows and contributions and two hashes of the group."""
    dealt = _dealt(df, keys, order)
    small = _contributions(_rows(dealt, df.columns), keys, own, so_far)
    # One row per slice.
    joined = dealt.join(F.broadcast(small), F.col(SLICE) == F.col("__at")).drop("__at")
    flat = _rows(joined, df.columns, *[c for c in small.columns if c != "__at"])
    cells = [x for c in keys for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    hashed = flat.withColumns({"__h1": F.xxhash64(F.lit(1), *cells), "__h2": F.xxhash64(F.lit(2), *cells)})
    return hashed.drop(SLICE).sortWithinPartitions(*_cols([*keys, *order]))


class _Scan:
    """A slice's rows as they come, and where their groups start."""

    def __init__(self) -> None:
        self.seen, self.wanted, self.last = 0, 0, None

    def starts(self, rows: pa.RecordBatch) -> np.ndarray:
        """For every row the place of its group's first row in the batch, -1 if the group began before."""
        h1, h2 = (rows.column(c).to_numpy() for c in ("__h1", "__h2"))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        # The first group of a slice goes on from what is contributed to it.
        new[0] = self.last is not None and self.last != (h1[0], h2[0])
        self.last = (h1[-1], h2[-1])
        self.seen += len(h1)
        self.wanted = rows.column("__n")[0].as_py()
        return np.maximum.accumulate(np.where(new, np.arange(len(h1)), -1))

    def check(self) -> None:
        if self.seen != self.wanted:
            raise RuntimeError(f"{self.seen} rows in place of {self.wanted}: rows were dealt twice, spark.sql.exchange.reuse must be on")


def rank_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Down], name: str = "running"
) -> DataFrame:
    """1-based ``row_number`` per group; ``order`` must be a total order inside the group.

    Select the columns you need first: whole rows are dealt.
    """
    kept = [c for c in df.columns if c != name]
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField(name, T.LongType())])
    counted = F.count(F.lit(1)).alias("__before")
    ordered = _in_order(df, keys, order, [counted], lambda c, _: F.sum(c))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, running = _Scan(), 0
        for rows in batches:
            if not rows.num_rows:
                continue
            if not scan.seen:
                running = rows.column("__before")[0].as_py() or 0
            start = scan.starts(rows)
            at = np.arange(rows.num_rows)
            numbers = np.where(start < 0, running + at + 1, at - start + 1)
            running = int(numbers[-1])
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in kept], pa.array(numbers)], schema.names)
        scan.check()

    return ordered.mapInArrow(work, schema)


def visit_rank(plan: DataFrame, tie: Sequence[str | Down] = ()) -> DataFrame:
    """Visits of a store numbered from the latest count date backwards."""
    return rank_rows(plan, ["bu", "stcode"], [Down("cntdate"), *tie], "running")


def occurrence(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Down], name: str = "dup_count"
) -> DataFrame:
    """0-based repeat number of a key."""
    return rank_rows(df, keys, order, name).withColumn(name, F.col(name) - 1)


def sequence_in_group(
    scans: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Down],
    existing: DataFrame | None = None,
    name: str = "seq",
) -> DataFrame:
    """Next sequence numbers per group, going on after the highest existing one."""
    numbered = rank_rows(scans, keys, order, name)
    if existing is None:
        return numbered
    top = per_key(existing, keys, F.max(name).alias("__top"))
    return (
        numbered.join(top, list(keys), "left")
        .withColumn(name, F.col(name) + F.coalesce(F.col("__top"), F.lit(0)))
        .select(*numbered.columns)
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given total order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")


def latest_per_group(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Whole row with the highest ``by`` values per key."""
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in by])


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_first(df, keys, [F.col(c).asc_nulls_last() for c in order])


def forward_fill(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Last non-null value downwards inside each group; ``order`` ascends and is total.

    All of ``cols`` are filled in one pass. Select the columns you need first: whole rows are dealt.
    """
    schema = df.schema
    position = F.struct(*[F.col(f"`{c}`") for c in order]) if order else F.lit(0)
    carried = {c: f"__c{n}" for n, c in enumerate(cols)}
    last = [F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), position)).alias(x) for c, x in carried.items()]
    ordered = _in_order(df, keys, order, last, lambda c, _: F.last(c, ignorenulls=True))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, state = _Scan(), {}
        for rows in batches:
            if not rows.num_rows:
                continue
            if not scan.seen:
                state = {c: rows.column(x).slice(0, 1) for c, x in carried.items()}
            start = scan.starts(rows)
            columns = {c: rows.column(c) for c in schema.names}
            for c in carried:
                filled = pc.is_valid(columns[c]).to_numpy(zero_copy_only=False)
                at = np.maximum.accumulate(np.where(filled, np.arange(rows.num_rows), -1))
                # One place on, as the value carried so far stands first.
                source = np.where(at >= np.maximum(start, 0), at + 1, 0)
                none = (source == 0) & (start >= 0)
                columns[c] = pa.concat_arrays([state[c], columns[c]]).take(pa.array(source, mask=none))
                state[c] = columns[c].slice(rows.num_rows - 1)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema.names)
        scan.check()

    return ordered.mapInArrow(work, schema)


def ranked_output(df: DataFrame, by: str, tie: Sequence[str]) -> DataFrame:
    """Sorted from the highest ``by`` down, ties in the order of ``tie``."""
    return df.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in tie])


def report_order(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.orderBy(*cols)


def history(scans: DataFrame, stocktake: str, location: str, location_col: str = "location") -> DataFrame:
    """Scans of one location, newest sequence number first."""
    return scans.filter((F.col("stocktakeid") == stocktake) & (F.col(location_col) == location)).orderBy(
        F.col("seq").desc()
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
