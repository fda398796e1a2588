"""Live results over scan events. The same functions serve a batch DataFrame."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.measures import exact
from ..operators.ranking import keep_first
from ..session import durable
from ..sources.sinks import remove_partition
from .intake import BATCH, QUERY, _write_batch, query_of

#: When a batch was written; a stream that starts anew writes its versions later than the one before.
WRITTEN = "written_at"


def scan_totals(scans: DataFrame, keys: Sequence[str] = ("stocktakeid", "location", "sku")) -> DataFrame:
    """Quantity and line count per stocktake, location and item."""
    return scans.groupBy(*keys).agg(F.sum(exact(scans, "qty")).alias("qty"), F.count(F.lit(1)).alias("lines"))


def latest_quantity(changes: DataFrame, key: str = "scan_id", order: str = "modified") -> DataFrame:
    """Quantity of each scan after its edits: the last change wins, a tie goes to the larger one.

    ``changes`` holds the scan itself and every edit of it.
    """
    last = F.max(F.struct(F.col(order), F.col("qty"))).alias("__last")
    return changes.groupBy(key).agg(last).select(key, F.col("__last.qty").alias("qty"))


#: Start of the span of arrival that a row of an expiring total is about.
OPENED = "opened"
ARRIVED = "__arrived"


def _by_arrival(rows: DataFrame, span: str, slack: str) -> DataFrame:
    """Rows with the span they arrive in; the state of a span is dropped ``slack`` after its end.

    Rows are stamped with the time of their micro-batch, which a repeated batch keeps. So no row is ever late,
    however old its scan or edit is; ``slack`` only covers a clock that is set back.
    """
    return rows.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, slack)


def arrival_totals(
    scans: DataFrame, keys: Sequence[str] = ("stocktakeid", "location", "sku"), span: str = "1 hour", slack: str = "10 minutes"
) -> DataFrame:
    """``scan_totals`` whose state ends: partial totals for each span of arrival, ``settled_totals`` adds them up.

    State is held for what arrived within the last spans, not for every stocktake ever counted. A
    stocktake that goes on after its state is gone opens another partial total.
    """
    window = F.window(ARRIVED, span)
    sums = [F.sum(exact(scans, "qty")).alias("qty"), F.count(F.lit(1)).alias("lines")]
    return _by_arrival(scans, span, slack).groupBy(window, *keys).agg(*sums).select(*keys, F.col("window.start").alias(OPENED), "qty", "lines")


def settled_totals(changes: DataFrame, keys: Sequence[str] = ("stocktakeid", "location", "sku")) -> DataFrame:
    """Totals from the written partial ones."""
    newest = current_rows(changes, [*keys, OPENED])
    return newest.groupBy(*keys).agg(F.sum("qty").alias("qty"), F.sum("lines").alias("lines"))


def arrival_latest(
    changes: DataFrame, key: str = "scan_id", order: str = "modified", span: str = "1 hour", slack: str = "10 minutes"
) -> DataFrame:
    """``latest_quantity`` whose state ends: the last change among those that arrived in the same span.

    ``settled_latest`` picks among the spans, so changes may arrive in any order, also long after the state of
    their scan is gone; ``late_changes`` lists those that were older than what had arrived in a span before.
    """
    last = F.max(F.struct(F.col(order), F.col("qty"))).alias("__last")
    grouped = _by_arrival(changes, span, slack).groupBy(F.window(ARRIVED, span), key).agg(last)
    return grouped.select(key, F.col("window.start").alias(OPENED), F.col(f"__last.{order}").alias(order), F.col("__last.qty").alias("qty"))


def settled_latest(changes: DataFrame, key: str = "scan_id", order: str = "modified") -> DataFrame:
    """Quantity after all changes that arrived: the last change wins, a tie goes to the larger one."""
    return latest_quantity(current_rows(changes, [key, OPENED]), key, order)


def late_changes(changes: DataFrame, key: str = "scan_id", order: str = "modified") -> DataFrame:
    """Side table of changes that came after a newer one of an earlier span and so changed nothing."""
    newest = current_rows(changes, [key, OPENED])
    before = Window.partitionBy(key).orderBy(OPENED).rowsBetween(Window.unboundedPreceding, -1)
    return newest.withColumn("__top", F.max(order).over(before)).filter(F.col(order) < F.col("__top")).drop("__top")


def fold_totals(spark: SparkSession, path: str, before: str, keys: Sequence[str] = ("stocktakeid", "location", "sku")) -> None:
    """Partial totals of spans that opened before a time become one row per key; run between two runs of the stream.

    Give a time whose spans have ended, slack included: an open span would count twice.
    """
    done = F.col(OPENED) < F.lit(before).cast("timestamp")

    def folded(newest: DataFrame) -> DataFrame:
        old = newest.filter(done).groupBy(*keys).agg(
            F.max(OPENED).alias(OPENED), F.sum("qty").alias("qty"), F.sum("lines").alias("lines"), F.max(WRITTEN).alias(WRITTEN)
        )
        types = {f.name: f.dataType for f in newest.schema.fields}
        cast = old.select(*[F.col(c).cast(types[c]) for c in newest.columns])
        return newest.filter(~done).unionByName(cast)

    compact(spark, path, [*keys, OPENED], folded)


def changed_rows(path: str) -> Callable[[DataFrame, int], None]:
    """Batch function for update mode: the changed groups of a batch go into its partition."""

    def each(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn(WRITTEN, F.lit(time.time_ns()))
        _write_batch(stamped, path, query_of(batch), batch_id)

    return each


def current_rows(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest version of every group written by ``changed_rows``."""
    newest = [F.col(WRITTEN).desc(), F.col(BATCH).desc()]
    return keep_first(changes, keys, newest).drop(QUERY, BATCH, WRITTEN)


def compact(
    spark: SparkSession, path: str, keys: Sequence[str], merged: Callable[[DataFrame], DataFrame] = lambda newest: newest
) -> None:
    """Keep only the newest version of every group, ``merged`` if need be; run between two runs of the stream.

    The newest versions are written with their time into a folder of their own before the folders
    they came from go, so a run that ends in between leaves versions of equal time, of which
    ``current_rows`` takes one.
    """
    stored = spark.read.parquet(path)
    newest = keep_first(stored, keys, [F.col(WRITTEN).desc(), F.col(BATCH).desc()]).drop(QUERY, BATCH)
    before = stored.select(F.col(QUERY).cast("string"), F.col(BATCH).cast("string")).distinct().collect()
    _write_batch(durable(merged(newest)), path, f"compacted-{uuid.uuid4().hex}", 0)
    for folder in before:
        remove_partition(spark, path, folder.asDict())
