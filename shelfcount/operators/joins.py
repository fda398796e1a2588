"""Lookups and matching joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .keys import first_of_key, key_set, per_key
from .ranking import keep_first


def enrich(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left lookup of a dimension."""
    return df.join(dim, list(keys), "left")


def join_renamed(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]) -> DataFrame:
    """Left join on differently named keys; the right keys are dropped."""
    temp = {r: f"__r_{r}" for r in right_keys}
    renamed = right.withColumnsRenamed(temp)
    same = reduce(
        lambda a, b: a & b,
        [left[f"`{a}`"] == renamed[f"`{temp[b]}`"] for a, b in zip(left_keys, right_keys)],
    )
    return left.join(renamed, same, "left").drop(*temp.values())


def natural_left(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on every common column."""
    return left.join(right, [c for c in left.columns if c in right.columns], "left")


def inner_master(fact: DataFrame, master: DataFrame, keys: Sequence[str] = ("sku",)) -> DataFrame:
    return fact.join(master, list(keys), "inner")


def cross_dims(base: DataFrame, **dims: Sequence[object]) -> DataFrame:
    """Every row of ``base`` with every combination of small in-code dimensions.

    A dimension is a list of values, or of tuples whose names are joined by ``__`` in the
    keyword. Each list is exploded in place, so rows multiply where they are.
    """
    out = base
    for name, values in dims.items():
        names = name.split("__")
        if len(names) == 1:
            out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
        else:
            items = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, value)]) for value in values]
            out = out.select("*", F.inline(F.array(*items)))
    return out


def barcode_lookup(master: DataFrame, keys: Sequence[str] = (), sku: str = "sku", barcode: str = "barcode") -> DataFrame:
    """(keys, barcode) -> sku, where an item answers to its sku and to its barcode."""
    by_sku = master.select(*keys, F.col(sku).alias("barcode"), F.col(sku).alias("sku"))
    by_barcode = master.select(*keys, F.col(barcode).alias("barcode"), F.col(sku).alias("sku"))
    return by_sku.unionByName(by_barcode)


def explode_barcode_lookup(scans: DataFrame, master: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Scans joined to the item by sku or barcode."""
    return scans.join(barcode_lookup(master, keys), [*keys, "barcode"], "inner")


def lookup_two_step(scans: DataFrame, master: DataFrame, keys: Sequence[str] = (), barcode: str = "barcode") -> DataFrame:
    """Exact barcode first; what is left is matched with leading zeros removed.

    The lowest master barcode wins among several candidates, so one item is found per scan.
    Scans of unknown items keep nulls.
    """
    attributes = [c for c in master.columns if c not in keys and c != barcode]
    found = master.withColumnRenamed(barcode, "master_barcode")
    order = [F.col(c).asc_nulls_last() for c in ["master_barcode", *attributes]]
    exact = first_of_key(found.withColumn("__b", F.col("master_barcode")), [*keys, "__b"], order)
    loose = first_of_key(found.withColumn("__b", text.strip_zeros("master_barcode")), [*keys, "__b"], order)
    payload = ["master_barcode", *attributes]
    hit = F.col("__hit").isNotNull()
    first = scans.withColumn("__b", F.col(barcode)).join(
        exact.withColumn("__hit", F.lit(True)), [*keys, "__b"], "left"
    )
    # A matched scan keeps a key that no stripped barcode has, so it neither matches again nor
    # piles up on a null key.
    second_key = F.when(hit, F.concat(F.lit("="), F.col(barcode))).otherwise(text.strip_zeros(barcode))
    renamed = loose.withColumnsRenamed({c: f"__l_{c}" for c in payload})
    both = first.withColumn("__b", second_key).join(renamed, [*keys, "__b"], "left")
    chosen = [F.when(hit, F.col(c)).otherwise(F.col(f"__l_{c}")).alias(c) for c in payload]
    return both.select(*scans.columns, *chosen)


def year_round_match(counts: DataFrame, visits: DataFrame) -> DataFrame:
    """Start of posting time: earliest visit of the same store, year and round, else the count date."""
    keys = ["bu", "stcode", "year", "round"]
    dated = visits.withColumn("year", F.left(F.col("cntdate"), F.lit(4)))
    earliest = per_key(dated, keys, F.min("cntdate").alias("__visit"))
    return (
        counts.withColumn("year", F.left(F.col("cntdate"), F.lit(4)))
        .join(earliest, keys, "left")
        .withColumn("start_date", F.coalesce("__visit", "cntdate"))
        .select(*counts.columns, "start_date")
    )


def infer_skutype(stk: DataFrame, var: DataFrame, key: str = "cntnum", kind: str = "prtype") -> DataFrame:
    """Type of a count from its variance detail, 'Unknown' without one."""
    types = key_set(var.select(F.col(key), F.col(kind).alias("skutype")), [key, "skutype"])
    return (
        stk.drop("skutype")
        .join(types, key, "left")
        .withColumn("skutype", F.coalesce("skutype", F.lit("Unknown")))
    )


def rejoin_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Whole row at the top of each group in the given order."""
    return keep_first(df, keys, order)
