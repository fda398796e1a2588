"""Gates: semi and anti joins, and whole-file checks.

The checked side is often a row-level table of which only the key groups matter, so its keys
are made distinct first: every task reduces its part before anything is shuffled. No broadcast
is forced: Spark broadcasts a side by its measured size, shuffles a large one, and AQE splits a
skewed left side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import key_set


def _semi(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(key_set(other, keys), list(keys), "left_semi")


def _anti(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(key_set(other, keys), list(keys), "left_anti")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def open_plan(plan: DataFrame, atypes: Sequence[str] = ()) -> DataFrame:
    """Plan rows that an import may rely on: with a branch, and of the given visit types if any are named."""
    rows = plan.filter(F.col("branch").isNotNull())
    return rows.filter(F.col("atype").isin(*atypes)) if atypes else rows


def planned_only(df: DataFrame, plan: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with at least one plan row; duplicate plan rows do not multiply them."""
    return _semi(df, plan, keys)


def not_loaded(df: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key group is not in the target yet."""
    return _anti(df, loaded, keys)


def anti_join(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` without a partner, by any number of key columns."""
    return _anti(df, other, keys)


def unreported(plan: DataFrame, result: DataFrame, keys: Sequence[str] = ("stcode", "cntdate")) -> DataFrame:
    """Planned visits without any result."""
    return _anti(plan, result, keys)


def exclude_blocked_sku(
    df: DataFrame, block: DataFrame, keys: Sequence[str] = ("bu", "stcode", "cntdate", "sku")
) -> DataFrame:
    return _anti(df, block, keys)


def exclude_blocked_vendor(
    df: DataFrame, block: DataFrame, vendor: str = "vendor", sub_dept: str = "sdpt", wildcard: str = "all"
) -> DataFrame:
    """Drop rows of vendors blocked everywhere, then of vendors blocked in the sub-department."""
    everywhere = block.filter(F.col("sdpt") == wildcard).select(F.col("veno").alias("__veno"))
    partly = block.filter(F.col("sdpt") != wildcard).select(
        F.col("veno").alias("__veno"), F.col("sdpt").alias("__sdpt")
    )
    kept = df.join(everywhere, F.col(vendor) == F.col("__veno"), "left_anti")
    return kept.join(
        partly,
        (F.col(vendor) == F.col("__veno")) & (F.col(sub_dept) == F.col("__sdpt")),
        "left_anti",
    )


def exists_gate(df: DataFrame, plan: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups (whole files) pass only when planned and not loaded before.

    The two key sets are subtracted first, so the rows are joined once.
    """
    return _semi(df, _anti(key_set(plan, keys), loaded, keys), keys)


def _reject(df: DataFrame, file_col: str, bad: Column) -> DataFrame:
    return _anti(df, df.filter(F.coalesce(bad, F.lit(True))), [file_col])


def matches_filename(df: DataFrame, file_col: str, value: Column, expected: Column) -> DataFrame:
    """Reject every row of a file when one row disagrees with the file name."""
    return _reject(df, file_col, value != expected)


def rows_matching_filename(df: DataFrame, value: Column, expected: Column) -> DataFrame:
    """Row form: keep only the rows that agree with the file name."""
    return df.filter(value == expected)


def reject_file_if_null(df: DataFrame, file_col: str, cols: Sequence[str]) -> DataFrame:
    """Reject files with a null in a required column."""
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.col(c).isNull()
    return _reject(df, file_col, bad)


def reject_if_all_unknown(
    df: DataFrame, file_col: str, col: str = "skutype", unknown: str = "Unknown"
) -> DataFrame:
    """Reject files in which no row has a known value."""
    return _semi(df, df.filter(F.col(col) != unknown), [file_col])


def rejects_summary(df: DataFrame, other: DataFrame, keys: Sequence[str], group: Sequence[str], matched: bool) -> DataFrame:
    """Sizes of the groups that have (``matched``) or lack a partner in ``other``."""
    gate = _semi if matched else _anti
    return gate(df, other, keys).groupBy(*group).agg(F.count(F.lit(1)).alias("counts"))


def upload_gate(
    df: DataFrame, plan: DataFrame, loaded: DataFrame, plan_keys: Sequence[str], loaded_keys: Sequence[str]
) -> Mapping[str, DataFrame]:
    """Accepted rows plus the two reject reports of an upload."""
    planned = planned_only(df, plan, plan_keys)
    return {
        "accepted": not_loaded(planned, loaded, loaded_keys),
        "unplanned": rejects_summary(df, plan, plan_keys, loaded_keys, matched=False),
        "already_loaded": rejects_summary(planned, loaded, loaded_keys, loaded_keys, matched=True),
    }
