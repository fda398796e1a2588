"""Connected components of a link table by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.session import durable


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Link the larger (or the smaller and own) neighbours of every node to its smallest one.

    A node's smallest neighbour is a partial aggregate, so a node with very many links is split
    again by the join, whose two sides are plain shuffles.
    """
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("low"))
    pairs = both.join(least, both["a"] == least["node"])
    if larger:
        return pairs.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    own = least.select(F.col("node").alias("a"), F.col("low").alias("b"))
    return pairs.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(own).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root the smallest node that is reachable.

    Each round is written below the shared folder, which cuts the lineage. Self-links, repeated
    links and either direction are the same link; nodes that are only linked to themselves do not
    appear. Rounds go on until one changes nothing: the stars then all point at their smallest node.
    """
    now = durable(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    while mark[0]:
        now = durable(_star(_star(now, True), False))
        after = _mark(now)
        if after == mark:
            break
        mark = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _mark(links: DataFrame) -> tuple:
    """What two rounds are compared by: number of links and two sums over them."""
    return tuple(
        links.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            F.bit_xor(F.xxhash64("b", "a")),
        ).first()
    )
