"""Reduced key sides for joins with row-level tables.

AQE splits a skewed partition of a join only when both sides come straight from a shuffle on
the join keys. A side that was just grouped by those keys needs no such shuffle, and a hot key
on the other side would then stay in one task. Grouping by the packed keys gives the reduced
side a shuffle of its own, which is small, and leaves the large side to be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = "__key"


def packed(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{k}`") for k in keys]).alias(KEY)


def key_set(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys, reduced by every task before they are shuffled."""
    return df.select(packed(keys)).distinct().select(f"{KEY}.*")


def per_key(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """One row of aggregates per key."""
    grouped = df.groupBy(packed(keys)).agg(*aggregates)
    return grouped.select(f"{KEY}.*", *grouped.columns[1:])


def first_of_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given total order."""
    window = Window.partitionBy(KEY).orderBy(*order)
    numbered = df.withColumn(KEY, packed(keys)).withColumn("__rn", F.row_number().over(window))
    return numbered.filter("__rn = 1").drop("__rn", KEY)
