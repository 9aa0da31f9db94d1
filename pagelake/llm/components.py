"""Connected components by alternating star contraction, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the least node it reaches.

    Every round first links each neighbour above a node to the node's least
    neighbour, then each node and its lower neighbours to the least of them,
    and writes the edges, so no lineage builds up. It ends when a round leaves
    the edges as they were; the number of rounds grows with the logarithm of
    the longest path. Minima are combined before the shuffle, and the joins are
    plain equi-joins that adaptive execution splits at hub nodes. Nulls and
    self-links are ignored; an empty table gives an empty result.
    """
    current = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(),
        "edges",
    )
    before = None
    while True:
        both = current.union(current.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u != v").distinct()
        )
        current = written(small, "edges")
        # Order-free sums of the edges tell whether a round changed anything.
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v"), F.col("v")).distinct())
