"""Connected components of a link table, by alternating large and small stars.

Every round hangs all larger neighbours of a node on its smallest one, first for all
neighbours and then for the smaller ones; the links end as stars around the smallest
members. Each half round is one aggregation (the smallest neighbour, combined before the
shuffle) and one join with it. The aggregate is written before the join, so both sides of
the join are shuffled for it and adaptive execution can split a node with very many links.
The driver sees counts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import staged


def _is_stars(links: DataFrame) -> bool:
    """Every node is the larger end of one link or the smaller end of some, never both."""
    ends = links.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
            )
        ).alias("e")
    ).select("e.*")
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def _ordered(links: DataFrame) -> DataFrame:
    return (
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _large_stars(links: DataFrame) -> DataFrame:
    """Larger neighbours of every node go to its smallest neighbour (or itself)."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = staged(both.groupBy("a").agg(F.min("b").alias("m")), "stars-low")
    # ``links`` has each neighbour pair once, the larger end in ``a``: its centre is ``b``.
    joined = links.join(low.withColumnRenamed("a", "b"), "b")
    return joined.select("a", F.least("b", "m").alias("b"))


def _small_stars(links: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, go to the smallest of them."""
    low = staged(links.groupBy("a").agg(F.min("b").alias("m")), "stars-low")
    moved = links.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest member) for every node of at least one link.

    Links to oneself, nulls and repeated links are allowed and change nothing.
    """
    current = staged(_ordered(links.select(F.col(a).alias("a"), F.col(b).alias("b"))), "stars")
    while not _is_stars(current):
        large = staged(_ordered(_large_stars(current)), "stars")
        current = staged(_ordered(_small_stars(large)), "stars")
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
