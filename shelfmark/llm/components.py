"""Connected components of a graph of 64-bit nodes, by stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.text import materialise


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """The least neighbour of each node, as a written table: a join with it is one of two plain shuffles, which Spark can split."""
    return materialise(edges.groupBy("u").agg(F.min("v").alias("least")), "least")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of an edge list (u, v) that isn't the least of its component.

    Rounds of large-star (each node hands its larger neighbours its least one) and small-star (each node hands its smaller
    neighbours their least one) until nothing changes; each edge list is written to the shared scratch folder. The smallest
    neighbour is an aggregate with partial sums, so a node with many edges meets in no single task. Self-loops and repeated
    edges are harmless; an edge with a NULL end is left out; no edges give an empty table.
    """
    edges = (
        edges.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    edges = materialise(edges, "edges")
    before = _state(edges)
    while before[0]:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least_neighbour(both), "u")
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
            .distinct()
        )
        large = materialise(large, "large-star")
        small = large.join(_least_neighbour(large), "u")
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
        edges = materialise(small.filter(F.col("u") != F.col("v")).distinct(), "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
