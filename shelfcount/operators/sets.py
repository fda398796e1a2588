"""Unions and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import keep_first


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns missing in one are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def concat_diagonal_unique(
    first: DataFrame, second: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Union with missing columns, one row per key; a tie goes to the lowest ``order`` values."""
    both = first.unionByName(second, allowMissingColumns=True)
    return keep_first(both, keys, [F.col(c).asc_nulls_last() for c in order])


def drop_dupes(df: DataFrame) -> DataFrame:
    """One copy of every distinct row."""
    return df.distinct()
