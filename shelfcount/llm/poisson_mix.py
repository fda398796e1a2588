"""Mixing sources to target weights by Poisson replication.

A source's target repetition rate is its share of the target amount divided by what it has. Each
document takes a uniform number from a seeded hash of its id and repeats as often as the inverse
Poisson distribution with that rate says: independently of all others, so any task can decide it
alone and a rerun decides the same. Copies are then spread over the table by a seeded hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcount.session import durable

SEED = 42
#: Numbers up to which the logarithm of the factorial is a table; beyond, a series holds to the last digit.
FACTORIALS = 128
#: Exponent on a source's size where no target weights are given: 1 keeps the mixture, 0 levels it.
TEMPERATURE = 0.5


def uniform(seed: int, label: str, *columns: Column) -> Column:
    """A number in [0, 1) with 52 bits from the md5 of seed, label and columns; null counts as a text of its own."""
    parts = [F.coalesce(c.cast("string"), F.lit("\u0000")) for c in columns]
    digest = F.md5(F.concat_ws("|", F.lit(f"{seed}:{label}"), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def log_factorial(k: Column) -> Column:
    """Natural logarithm of k!."""
    table = F.array(*[F.lit(math.lgamma(n + 1)) for n in range(FACTORIALS)])
    x = k.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(F.lit(2 * math.pi) * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(k < FACTORIALS, F.get(table, k.cast("int"))).otherwise(series)


def poisson_steps(rates: DataFrame) -> DataFrame:
    """(source, rate, first, steps) of rates above 0: probabilities of at most first, first + 1, ... copies.

    Only the numbers within ten standard deviations of the mean are looked at (and the first 20), the others have a
    probability below what a double can tell from 0 or 1. Terms are built from logarithms, so large rates do not
    underflow, and are added up by a window, so their number is that of the steps and not its square.
    """
    spread = 10 * F.sqrt("rate") + 20
    first = F.greatest(F.floor(F.col("rate") - spread), F.lit(0)).cast("long")
    last = F.ceil(F.col("rate") + spread).cast("long")
    every = rates.where("rate > 0").select("source", "rate", first.alias("first"), F.explode(F.sequence(first, last)).alias("k"))
    term = F.exp(F.col("k") * F.log("rate") - F.col("rate") - log_factorial(F.col("k")))
    upto = F.sum(term).over(Window.partitionBy("source").orderBy("k"))
    listed = F.array_sort(F.collect_list(F.struct("k", "upto")))
    steps = every.withColumn("upto", upto).groupBy("source", "rate", "first").agg(listed.alias("listed"))
    return steps.select("source", "rate", "first", F.transform("listed", lambda s: s["upto"]).alias("steps"))


def source_rates(docs: DataFrame, weights: DataFrame | None = None, source_col: str = "source", text_col: str = "text", temperature: float = TEMPERATURE) -> DataFrame:
    """(source, size, weight, rate) of every source in ``docs``.

    Size is UTF-8 bytes plus one per document, so it is never zero. The target amount is what
    ``docs`` holds in all. ``weights`` (source, weight) are relative; a source that it does not
    name, or names with a null or negative weight, has weight zero, and repeated names add up.
    Without ``weights`` a source weighs its size to the power ``temperature``.
    """
    size = (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long")
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        given = weights.groupBy(F.col("source").alias("__of")).agg(
            F.sum(F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))).alias("weight")
        )
        weighed = sizes.join(given, sizes["source"].eqNullSafe(given["__of"]), "left").select(
            "source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    weighed = durable(weighed)  # one row per source, looked at three times
    # A rounded sum, as the order of addition must not decide a rate.
    weight_sum, size_sum = weighed.agg(
        F.sum(F.col("weight").cast("decimal(38,10)")).cast("double"), F.sum("size").cast("double")
    ).first()
    share = F.col("weight") / F.lit(weight_sum) if weight_sum else F.lit(0.0)
    return weighed.withColumn("rate", share * F.lit(size_sum or 0.0) / F.col("size"))


def replicated(docs: DataFrame, rates: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """``docs`` with every row repeated by its Poisson count, plus ``__copies``, ``__copy`` (from 1) and ``__place``.

    Rows with count zero go. Rows that share an id and a source share a count. A null source is a
    source of its own; a null id hashes as a text of its own. ``__place`` is the seeded position in
    [0, 1) of a copy in the shuffled table.
    """
    # One row for each source, written so that Spark knows its size: few are sent to the tasks and no row moves.
    steps = durable(poisson_steps(rates.select("source", "rate"))).select(
        F.col("source").alias("__of"), F.col("first").alias("__first"), F.col("steps").alias("__steps")
    )
    # Sources without steps have rate 0 and no copies.
    dealt = docs.join(steps, docs[source_col].eqNullSafe(steps["__of"]))
    count = F.col("__first") + F.size(F.filter("__steps", lambda s: s <= F.col("__u")))
    return (
        dealt.withColumn("__u", uniform(seed, "count", F.col(id_col), F.col(source_col)))
        .withColumn("__copies", count.cast("int"))
        .where("__copies > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .withColumn("__place", uniform(seed, "place", F.col(id_col), F.col(source_col), F.col("__copy")))
        .drop("__of", "__first", "__steps", "__u")
    )


def shuffled(rows: DataFrame, place: str = "__place") -> DataFrame:
    """Rows in the order of ``place`` over the whole table."""
    return rows.repartitionByRange(F.col(place)).sortWithinPartitions(place)


def mixed(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``docs`` mixed to the target weights and shuffled globally; columns stay as they are."""
    rates = source_rates(docs, weights, source_col, text_col)
    return shuffled(replicated(docs, rates, id_col, source_col, seed)).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_digest(docs: DataFrame) -> DataFrame:
    """Per copy: doc_id, source, n_copies, copy and place, in shuffled order."""
    slim = docs.select("doc_id", "source")
    return shuffled(replicated(slim, source_rates(docs))).select(
        "doc_id", "source", F.col("__copies").alias("n_copies"), F.col("__copy").alias("copy"), F.col("__place").alias("place")
    )
