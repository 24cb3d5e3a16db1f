"""Connected components of a graph of any size, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.scratch import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; `root` is the smallest node that can be reached.

    `edges` has two columns of the same type; their order, repeats and loops do not matter, rows
    with a null are ignored. Each round writes its edges to the shared folder, and the rounds
    (logarithmic in the size of the components) end when nothing changes any more.
    """
    a, b = (F.col(c) for c in edges.columns)
    current = edges.filter(a != b).select(
        F.greatest(a, b).alias("high"), F.least(a, b).alias("low")
    )
    current = written(current.distinct(), "edges")
    seen = _state(current)
    while True:
        current = written(_small_star(_large_star(current)), "edges")
        state = _state(current)
        if state == seen:
            break
        seen = state
    roots = current.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return current.select(F.col("high").alias("node"), F.col("low").alias("root")).union(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("high", "low")), F.bit_xor(F.xxhash64("low", "high"))
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(
        edges.select("low", "high")
    )
    smallest = both.groupBy("u").agg(F.min("v").alias("m"))
    smallest = smallest.select("u", F.least("u", "m").alias("m"))
    tied = both.join(smallest, "u").filter("v > u")
    return tied.select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    smallest = edges.groupBy("high").agg(F.min("low").alias("m"))
    tied = edges.join(smallest, "high").select(
        F.explode(F.array("high", "low")).alias("high"), F.col("m").alias("low")
    )
    return tied.filter("high != low").distinct()
