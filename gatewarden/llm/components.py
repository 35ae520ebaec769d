"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once


def connected(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) of every node that is not its component's smallest; roots are left out.

    Each round links every node's larger neighbours to its smallest one, then
    its smaller neighbours likewise, until only stars around the smallest nodes
    are left (logarithmically many rounds). A node's links are never gathered:
    minima are taken before they are joined back, from a stored table, so that
    Spark can split the join at a node with many links. Loops, repeated links
    and nulls are ignored.
    """
    pair = links.select(F.col(left).alias("x"), F.col(right).alias("y")).where("x <> y")
    stars = computed_once(pair.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    before = _mark(stars)
    while before[0]:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = computed_once(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = computed_once(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = computed_once(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = computed_once(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
        after = _mark(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(stars: DataFrame) -> tuple:
    """Changes whenever the set of links does."""
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
