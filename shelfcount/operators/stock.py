"""Stock-on-hand summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, text
from ..functions.measures import MONEY, as_double, exact
from ..policy import SohPolicy
from .gates import anti_join, exclude_blocked_vendor, planned_only
from .ranking import keep_first


def sum_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum every numeric column; rows with a null key are left out, an all-null sum is 0."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in keys]

    def total(name: str) -> Column:
        dtype = df.schema[name].dataType
        summed = F.coalesce(F.sum(exact(df, name)), F.lit(0))
        return (summed if isinstance(dtype, T.IntegralType) else as_double(summed)).alias(name)

    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*[total(c) for c in numeric])


def split_measures(df: DataFrame, kind: str, value: str, columns: dict[str, str]) -> DataFrame:
    """One value column becomes one column per type code, 0 where the code differs."""
    return df.withColumns(
        {name: F.when(F.col(kind) == code, F.col(value)).otherwise(F.lit(0)) for name, code in columns.items()}
    )


def intake_record(
    df: DataFrame, bu: str, date: Column | str, store: str, value: str, sku: str
) -> DataFrame:
    """Audit row per store and day: sum of the value and number of items read."""
    date = F.col(date) if isinstance(date, str) else date
    keyed = df.select(
        date.alias("as_date"),
        F.col(store).alias("stcode"),
        exact(df, value).alias("__v"),
        F.col(sku).alias("__s"),
    ).dropna(subset=["as_date", "stcode"])
    counted = keyed.groupBy("as_date", "stcode").agg(
        as_double(F.coalesce(F.sum("__v"), F.lit(0))).alias("soh"),
        F.count("__s").alias("record"),
    )
    return counted.select(F.lit(bu).alias("bu"), "*")


def soh_snapshot(df: DataFrame, policy: SohPolicy, block: DataFrame | None = None) -> DataFrame:
    """On-hand value per store and day split by type, by the business unit's policy.

    ``df`` carries the policy's value, type, store and date columns (plus vendor and
    sub-department where the policy blocks vendors).
    """
    value = F.col(policy.value)
    rows = df
    if policy.null_to_zero:
        rows = rows.withColumn(policy.value, F.coalesce(value, F.lit(0)))
    if policy.positive_only:
        rows = rows.filter(value > 0)
    if policy.skip_sub_depts:
        sub = F.col(policy.sub_dept)
        rows = rows.filter(sub.isNull() | ~sub.isin(*policy.skip_sub_depts))
    gated = policy.blocks_vendors and block is not None
    amount = exact(rows, policy.value)
    if policy.kind is None or (policy.kind not in df.columns and policy.kind_if_missing):
        kind = F.lit(policy.kind_if_missing).cast("string")
    else:
        kind = F.col(policy.kind)

    def part(code: str | None) -> Column:
        zero = F.lit(0)
        if code is None:
            return zero.cast(MONEY)
        if code == "*":
            return amount
        return F.when(kind == code, amount).otherwise(zero)

    credit, consign, perishable = (part(c) for c in policy.codes)
    total = amount if policy.total == "all" else credit + perishable
    date = F.col(policy.date)
    if policy.checked_date:
        date = dates.date_key(date, "yyyyMMdd")
    keyed = rows.select(
        F.col(policy.store).alias("stcode"),
        (text.century(date) if policy.add_century else date).alias("DATE"),
        credit.alias("food_credit"),
        consign.alias("nonfood_consign"),
        perishable.alias("perishable_nonmer"),
        total.alias("totalsoh"),
        *([F.col(policy.vendor).alias("__vendor"), F.col(policy.sub_dept).alias("__sub")] if gated else []),
    )
    if gated:
        # A block concerns a vendor and sub-department, so their sums meet it, not the rows.
        keys = ["stcode", "DATE", "__vendor", "__sub"]
        sums = keyed.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in keyed.columns if c not in keys])
        keyed = exclude_blocked_vendor(sums, block, "__vendor", "__sub").drop("__vendor", "__sub")
    # The unit is constant and the code follows from the store, so neither is a grouping key.
    return sum_by(keyed, ["stcode", "DATE"]).select(
        text.store_code(F.lit(policy.bu), "stcode").alias("code"),
        F.lit(policy.bu).alias("bu"),
        "stcode",
        "DATE",
        "food_credit",
        "nonfood_consign",
        "perishable_nonmer",
        "totalsoh",
    )


def carry_forward(soh: DataFrame, plan: DataFrame, floor: str, day: str) -> DataFrame:
    """Latest snapshot per store since ``floor``, dated ``day``, for stores in the plan."""
    keys = ["code", "bu", "stcode"]
    recent = soh.filter(F.col("DATE") >= floor)
    latest = keep_first(recent, keys, [F.col("DATE").desc()])
    planned = plan.filter(F.col("branch").isNotNull())
    return planned_only(latest, planned, ["bu", "stcode"]).select(
        *keys, F.lit(day).alias("DATE"), *[c for c in soh.columns if c not in [*keys, "DATE"]]
    )


def snapshot_diff(
    a: DataFrame, b: DataFrame, keys: Sequence[str], b_keys: Sequence[str] | None = None, show: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``a`` (keys and ``show`` columns) whose keys are absent in ``b``."""
    other = b.select(*[F.col(r).alias(k) for k, r in zip(keys, b_keys or keys)])
    return anti_join(a.select(*keys, *show), other, keys)


def high_water(df: DataFrame, target: DataFrame | int | None, id_col: str) -> DataFrame:
    """Rows above the highest id already stored; everything when the target is empty.

    ``target`` is the stored table, or its highest id if that is known (``tables.stored_max`` tells it without reading rows).
    """
    if isinstance(target, DataFrame):
        top = target.agg(F.coalesce(F.max(id_col), F.lit(-1)).alias("top")).scalar()
    else:
        top = F.lit(-1 if target is None else target)
    return df.filter(F.col(id_col) > top)


def next_run_number(ids: DataFrame, id_col: str, prefix_length: int, digits: int = 3) -> DataFrame:
    """Next run suffix per identifier prefix, starting at 001."""
    prefix = F.left(F.col(id_col), F.lit(prefix_length)).alias("prefix")
    run = F.right(F.col(id_col), F.lit(digits)).try_cast("int").alias("run")
    return (
        ids.select(prefix, run)
        .groupBy("prefix")
        .agg(F.lpad((F.coalesce(F.max("run"), F.lit(0)) + 1).cast("string"), digits, "0").alias("next_run"))
    )


def next_run_for(prefixes: DataFrame, ids: DataFrame, id_col: str, prefix_length: int, digits: int = 3) -> DataFrame:
    """Next run per wanted prefix; a prefix never used starts at 001."""
    known = next_run_number(ids, id_col, prefix_length, digits)
    first = F.lpad(F.lit("1"), digits, "0")
    return prefixes.join(known, "prefix", "left").withColumn("next_run", F.coalesce("next_run", first))
