"""Sharding by proportional stratified interleaving.

Rows are ranked in a seeded order within their source; row r of a source of n rows has the
fractional rank (r - 1/2) / n. Sorted by fractional rank, every stretch of the table holds the
sources in their overall proportions, so equal cuts give shards that match the mixture and differ
by one row at most.

Neither rank needs a source or the table in one task: rows are dealt into buckets by their seeded
hash (by their fractional rank, for the second), only the bucket sizes are accumulated, and rows
are numbered within a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 16
SEED = 42
#: Mean number of rows that are numbered together.
BUCKET_ROWS = 4_000
#: Slots whose sizes are summed up together.
TOP_SLOTS = 4_096


def _number(df: DataFrame, group: str | None, slot: Column, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``, the row's number from 1 within its group, and ``name``_of, the group's size.

    ``slot`` must rise with ``order``: slots are numbered apart and set off by the sizes of the
    slots before. ``group`` names a column without nulls; without one, the table is one group.
    Sizes are summed up in two levels, so no task sees every slot.
    """
    own_group = [group] if group else []
    keys = [*own_group, "slot"]
    cut = df.withColumn("slot", slot)
    before = (Window.unboundedPreceding, -1)
    sizes = cut.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("top", F.expr(f"slot div {TOP_SLOTS}"))
    tops = sizes.groupBy(*own_group, "top").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*(own_group or [F.lit(0)]))
    tops = tops.select(
        *own_group,
        "top",
        F.coalesce(F.sum("n").over(whole.orderBy("top").rowsBetween(*before)), F.lit(0)).alias("far"),
        F.sum("n").over(whole).alias(f"{name}_of"),
    )
    along = Window.partitionBy(*own_group, "top").orderBy("slot").rowsBetween(*before)
    near = sizes.select(*keys, "top", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("near"))
    base = near.join(tops, [*own_group, "top"]).drop("top")
    own = cut.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return own.join(base, keys).withColumn(name, F.col(name) + F.col("far") + F.col("near")).drop("slot", "far", "near")


def interleaved(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = SEED, shards: int = SHARDS
) -> DataFrame:
    """All rows and columns of ``docs`` plus ``shard`` (from 0) and ``slot`` (gapless from 0 in a shard).

    Shard sizes are at most one apart; rows of one source are spread evenly over the shards. A null
    source is a source of its own. The seeded order is by hashes of the whole row, id included, so
    rows without an id, or with one that is much repeated, are dealt like all others, and only wholly
    equal rows could change places (these are numbered together). Texts play no part but in that
    hash. An empty table gives no row. Columns of ``docs`` that are named ``shard`` or ``slot`` are
    replaced; columns of any other name are kept as they are.
    """
    whole = [F.col(f"`{c}`") for c in docs.columns]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")]
    source = F.col(f"`{source_col}`").cast("string")
    rows = docs.select(
        F.struct(*kept).alias("row"),
        F.xxhash64(F.lit(seed), *whole).alias("h1"),
        F.xxhash64(F.lit(seed + 1), *whole).alias("h2"),
        F.col(f"`{id_col}`").alias("id"),
        F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source)).alias("source"),
    )
    total = max(1, docs.count())
    slots = max(1, total // BUCKET_ROWS)
    order = [F.col(c) for c in ("h1", "id", "h2")]
    # The hash is uniform: its place in the range of all longs is a slot that rises with it.
    by_hash = F.floor((F.col("h1").cast("double") / F.lit(2.0**64) + 0.5) * slots).cast("int")
    ranked = _number(rows, "source", by_hash, order, "rank")
    ranked = ranked.withColumn("at", (F.col("rank") - 0.5) / F.col("rank_of"))
    by_place = F.floor(F.col("at") * slots).cast("int")
    placed = _number(ranked, None, by_place, [F.col("at"), F.col("source"), *order], "place")
    return (
        placed.withColumn("shard", F.expr(f"cast((place - 1) * {shards} div {total} as int)"))
        .withColumn("slot", F.expr(f"place - 1 - (shard * {total}L + {shards - 1}) div {shards}"))
        .select("row.*", "shard", "slot")
    )


def shard_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: size, checksum and place; the law is ``rows``. A null text counts as an empty one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return interleaved(slim).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )
