"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitflow.llm.store import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge (columns a, b).

    Each round hangs the larger neighbours of a node on its smallest one, then the smaller ones; it takes a number
    of rounds in the order of the squared logarithm of the longest path. Only minima are aggregated (combined
    before the shuffle) and the joins are plain ones that AQE may split, so a node with very many neighbours is no
    single task. Every round is written, which cuts the lineage.
    """
    current = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = _state(current)
    while True:
        both = current.union(current.select("v", "u"))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(
            lowest.select("u", F.col("m").alias("v"))
        )
        current = stored(small.distinct(), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
