"""Connected components of a distributed edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()


def _with_least(edges: DataFrame) -> DataFrame:
    """Each edge (a, b) with m, the least of a and all its b.

    The minima are cut off from their aggregate, so that both sides of the join come straight out
    of an exchange and adaptive execution can split the edges of a hub.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    least = checkpointed(least.select(F.col("a").alias("n"), F.least("a", "m").alias("m")))
    return edges.join(least, F.col("a") == F.col("n")).drop("n")


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to rows (node, root): root is the least node of the component.

    Nodes without an edge to another node have no row. Large stars hang every greater neighbour on
    the least neighbour, small stars every lesser one; the edges end as one star per component
    after a number of rounds that grows with the logarithm of the longest path. Only a count and a
    checksum of the edges reach the driver.
    """
    edges = edges.select("a", "b").where("a <> b").distinct()
    edges = checkpointed(edges)
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both.distinct()).where("b > a")
        large = checkpointed(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        small = _with_least(large)  # every edge points from the greater to the lesser node
        small = small.select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        ).select("e.*")
        edges = checkpointed(small.where("a <> b").distinct())
        if (now := _state(edges)) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
