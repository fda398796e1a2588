"""Table maintenance as pure functions ``(target, incoming) -> new target``.

Parquet tables have no row-level merge, so a replacement is an anti join and a union. The
writers in ``sources.sinks`` put the result into a new folder before it takes the old one's
place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gates import anti_join
from .keys import key_set, per_key


def append(target: DataFrame, incoming: DataFrame) -> DataFrame:
    return target.unionByName(incoming, allowMissingColumns=True)


def replace_keys(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], coming: DataFrame | None = None
) -> DataFrame:
    """Rows of the incoming keys are replaced; ``coming`` holds those keys where a smaller table is at hand."""
    return append(anti_join(target, incoming if coming is None else coming, keys), incoming)


def replace_range(target: DataFrame, incoming: DataFrame, col: str, lo: object, hi: object) -> DataFrame:
    """Rows in the inclusive range are replaced; rows with a null key stay."""
    outside = F.col(col).isNull() | ~F.col(col).between(lo, hi)
    return append(target.filter(outside), incoming)


def listed(col: str, values: Sequence[object], **equal: object) -> Column:
    """Rows of the listed groups and of the ``equal`` values."""
    test = F.col(col).isin(*values)
    for name, value in equal.items():
        test = test & (F.col(name) == value)
    return test


def replace_in_list(
    target: DataFrame, source: DataFrame, col: str, values: Sequence[object], **equal: object
) -> DataFrame:
    """Rows of the listed groups (and of the ``equal`` values) are replaced by the source's."""
    rows = listed(col, values, **equal)
    return append(target.filter(~F.coalesce(rows, F.lit(False))), source.filter(rows))


def unseen_and_reload(
    target: DataFrame, incoming: DataFrame, batch: str, check_keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows that the target lacks, and all rows of the batches that have none of those.

    The target is looked at once, by its keys; whether a row is unseen and whether its batch has
    such a row are then flags on the incoming rows.
    """
    seen = key_set(target, check_keys).withColumn("__seen", F.lit(True))
    flagged = incoming.join(seen, list(check_keys), "left").withColumn("__new", F.col("__seen").isNull()).drop("__seen")
    fresh = per_key(flagged, [batch], F.max("__new").alias("__any"))
    both = flagged.join(fresh, batch, "left").select(*incoming.columns, "__new", F.coalesce("__any", "__new").alias("__any"))
    return both.filter("__new").drop("__new", "__any"), both.filter("NOT __any").drop("__new", "__any")


def insert_new_or_reload(
    target: DataFrame, incoming: DataFrame, batch: str, check_keys: Sequence[str], delete_keys: Sequence[str]
) -> DataFrame:
    """Per batch: unseen rows are appended alone; a batch without any is reloaded whole.

    ``check_keys`` tell seen from unseen, ``delete_keys`` name the rows a reload replaces.
    """
    unseen, reload = unseen_and_reload(target, incoming, batch, check_keys)
    kept = anti_join(target, reload, delete_keys)
    return kept.unionByName(unseen.drop(batch), allowMissingColumns=True).unionByName(
        reload.drop(batch), allowMissingColumns=True
    )


def rows_to_archive(source: DataFrame, archive: DataFrame, keys: Sequence[str], col: str, lo: str, hi: str) -> DataFrame:
    """Rows of the range whose key group the archive lacks.

    Where the range column is among the keys, only the archive's rows of the range can match, so the others are not read.
    """
    in_range = F.col(col).between(lo, hi)
    return anti_join(source.filter(in_range), archive.filter(in_range) if col in keys else archive, keys)


def archive_new(
    source: DataFrame, archive: DataFrame, keys: Sequence[str], col: str, lo: str, hi: str
) -> DataFrame:
    return append(archive, rows_to_archive(source, archive, keys, col, lo, hi))


def archive_move(
    source: DataFrame, archive: DataFrame, keys: Sequence[str], col: str, lo: str, hi: str
) -> tuple[DataFrame, DataFrame]:
    """New archive, and the source without the range."""
    remaining = source.filter(F.col(col).isNull() | ~F.col(col).between(lo, hi))
    return archive_new(source, archive, keys, col, lo, hi), remaining


def backfill_keys(df: DataFrame, bu: str, store: str = "store") -> DataFrame:
    """Where ``bu`` is null, both the unit and the store code are set."""
    missing = F.col("bu").isNull()
    return df.withColumns(
        {
            "stcode": F.when(missing, F.col(store)).otherwise(F.col("stcode")),
            "bu": F.coalesce("bu", F.lit(bu)),
        }
    )


def upsert_header(header: DataFrame, row: DataFrame, key: str = "id") -> DataFrame:
    """Columns of the header rows with the incoming ids are rewritten; absent ids are not added."""
    changed = [c for c in row.columns if c != key]
    renamed = row.select(key, *[F.col(c).alias(f"__n_{c}") for c in changed], F.lit(True).alias("__hit"))
    joined = header.join(renamed, key, "left")
    return joined.select(
        *[
            (F.when(F.col("__hit"), F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c))
            for c in header.columns
        ]
    )


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    return append(target, anti_join(incoming.dropDuplicates(list(keys)), target, keys))


# Decisions of a stocktake registration.
REGISTER, RELOAD, REJECT = "new", "reload", "none"


def registration_state(
    incoming: DataFrame, plan: DataFrame, registered: DataFrame, master: DataFrame, key: str = "stocktakeid"
) -> DataFrame:
    """State per incoming stocktake: planned and unknown, planned with master to replace, or neither."""

    def flagged(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        return df.select(*keys).distinct().withColumn(name, F.lit(True))

    plan_keys = ["bu", "stcode", "cntdate"]
    joined = (
        incoming.join(flagged(plan, plan_keys, "__p"), plan_keys, "left")
        .join(flagged(registered, [key], "__r"), key, "left")
        .join(flagged(master, [key], "__m"), key, "left")
    )
    planned, known, loaded = (F.col(c).isNotNull() for c in ("__p", "__r", "__m"))
    state = (
        F.when(planned & ~known & ~loaded, REGISTER).when(planned & known & loaded, RELOAD).otherwise(REJECT)
    )
    return joined.withColumn("state", state).select(*incoming.columns, "state")
