"""Connected components of a link table by rounds of min-label joins, all on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.session import WrittenFrame, cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long, not null); root is the smallest node that can be reached.

    Each round does a large-star and a small-star step: neighbours are re-linked to the smallest node seen. The number
    of links never grows, rounds are logarithmic in the longest chain, and each round's links are a written table.
    A hub's links are pre-aggregated by ``min``; its joins are ordinary ones that adaptive execution may split.
    Repeated links and loops are harmless, an empty table gives an empty one.
    """
    kept = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    before = None
    while True:
        state = _state(kept.rows)
        if state == before or not state[0]:
            break
        before = state
        kept = _next(kept, _small_star(_large_star(kept.rows)))
    return kept.rows.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        kept.rows.select(F.col("lo").alias("node"), F.col("lo").alias("root"))
    ).distinct()


def _state(rows: DataFrame) -> tuple:
    """Count and order-free digest of the links; equal on two rounds once nothing moves any more."""
    found = rows.select(F.xxhash64("hi", "lo").alias("h")).agg(
        F.count("*"), F.sum(F.col("h").bitwiseAND((1 << 40) - 1)), F.expr("bit_xor(h)")
    ).first()
    return tuple(found)


def _next(kept: WrittenFrame, rows: DataFrame) -> WrittenFrame:
    after = cut_lineage(rows)
    kept.drop()
    return after


def _large_star(rows: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest among the node and its neighbours."""
    both = rows.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(rows.select("lo", "hi"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(rows: DataFrame) -> DataFrame:
    """Link a node's smaller neighbours, and the node, to the smallest of them."""
    least = rows.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = rows.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    own = least.select("hi", F.col("m").alias("lo"))
    return moved.union(own).where("hi <> lo").distinct()
