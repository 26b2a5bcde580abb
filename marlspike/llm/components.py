"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marlspike.llm.scratch import dropped, stored


def _smallest(both: DataFrame, label: str) -> DataFrame:
    """Per node: the smallest of it and its neighbours; stored, so that joins with it can be split at hot nodes."""
    return stored(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")), label)


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` (its smallest node) for every node of an edge between different nodes.

    Edges with a null end are left out. Rounds alternate: larger neighbours of each node are
    hung on its smallest neighbour, then so are its smaller ones; the edges end as stars.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
    now = stored(now.distinct(), "edges")
    before = _signature(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _smallest(both, "large")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "edges")  # v < u: every node hangs on smaller ones
        low = _smallest(large, "small")
        hung = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        last, now = now, stored(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        dropped(last, least, large, low)
        after = _signature(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
