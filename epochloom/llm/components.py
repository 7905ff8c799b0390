"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from epochloom.llm.shared import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the component's smallest node.

    Each round hangs every node's larger neighbours below its smallest neighbour, then its
    smaller ones; neighbours are joined to their minimum, never gathered in a list. Loops and
    repeated edges don't matter; without edges the result is empty.
    """
    parts = edges.select(
        F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")
    ).distinct()
    current = saved(parts.where(F.col("child") != F.col("parent")))
    before = None
    while True:
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("child", "parent"))).first()
        if state == before:
            return (
                current.select(F.col("child").alias("node"), F.col("parent").alias("root"))
                .union(current.select("parent", "parent"))
                .distinct()
            )
        before = state
        current = saved(_hang_smaller(_hang_larger(current)))


def _hang_larger(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("child").alias("u"), F.col("parent").alias("v")).union(
        edges.select("parent", "child")
    )
    both = both.repartition("u")  # once, for the minimum and for the join with it
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("child"), F.col("m").alias("parent"))
    )


def _hang_smaller(edges: DataFrame) -> DataFrame:
    laid = edges.repartition("child")
    least = laid.groupBy("child").agg(F.min("parent").alias("m"))
    moved = (
        laid.join(least, "child")
        .where("parent != m")
        .select(F.col("parent").alias("child"), F.col("m").alias("parent"))
    )
    return moved.union(least.select("child", "m")).distinct()
