"""Connected components by alternating star contraction.

Every round is two joins and two aggregates over the remaining edges, staged
in the shared folder; the number of rounds grows with the logarithm of the
longest chain.  No component is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, unaligned


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of each node, and the node, to the smallest."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(low.select(unaligned(F.col("u")).alias("u"), "m"), "u")
             .where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(
        unaligned(F.col("u")).alias("u"), F.least("u", "m").alias("m"))
    return (both.join(low, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _signature(edges: DataFrame):
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, label)`` for every node of ``edges(a long, b long)``.

    ``label`` is the smallest node of the component.  Loops and repeated edges
    are allowed; rows with a null end are no edges; no edges give no rows."""
    current = staged(edges.where("a <> b")
                     .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                     .distinct(), name)
    before = _signature(current)
    while True:
        current = staged(_small_star(_large_star(current)), name)
        now = _signature(current)
        if now == before:
            break
        before = now
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return nodes.unionByName(roots)
