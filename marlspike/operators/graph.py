"""Directed graphs as edge tables: neighbours, multi-source personalised PageRank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.operators.relational import broadcast_if_small
from marlspike.session import cut_lineage

# Damping and number of rounds.
ALPHA = 0.85
ROUNDS = 10

EDGES_PER_SLOT = 100_000
NEIGHBOURS_PER_SEGMENT = 4096


def distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").distinct()


def all_nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()


def out_degrees(edges: DataFrame) -> DataFrame:
    """Out-degree of every node, zero for nodes without out-edges."""
    degrees = edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("d"))
    return all_nodes(edges).join(degrees, "node", "left").select(
        "node", F.coalesce("d", F.lit(0)).alias("out_degree"))


def adjacency(edges: DataFrame) -> DataFrame:
    """``node, out_degree, segment, neighbours``: sorted neighbour lists of numeric nodes.

    A segment covers a fixed range of neighbour ids, which bounds its length
    however many edges the node has. Nodes without out-edges have one row with
    a null segment.
    """
    e = cut_lineage(distinct_edges(edges))
    # both sides are materialised, so that the join can be split at a node with very many segments
    lists = cut_lineage(
        e.withColumn("segment", F.floor(F.col("dst") / NEIGHBOURS_PER_SEGMENT))
        .groupBy(F.col("src").alias("node"), "segment")
        .agg(F.sort_array(F.collect_list("dst")).alias("neighbours"))
    )
    degrees = cut_lineage(lists.groupBy("node").agg(F.sum(F.size("neighbours")).alias("out_degree")))
    ends = all_nodes(e).join(degrees, "node", "left_anti").select(
        "node", F.lit(0).cast("bigint").alias("out_degree"), F.lit(None).cast("bigint").alias("segment"),
        F.lit(None).cast(lists.schema["neighbours"].dataType).alias("neighbours"))
    return lists.join(degrees, "node").select("node", "out_degree", "segment", "neighbours").unionByName(ends)


def personalized_pagerank(
    edges: DataFrame, sources: Sequence, alpha: float = ALPHA, rounds: int = ROUNDS,
    edges_per_slot: int = EDGES_PER_SLOT,
) -> DataFrame:
    """``node, score`` after ``rounds`` steps from an equal start on the sources.

    The edge table is partitioned once by (source node, slot) and kept; a node
    with very many edges has several slots, and its rank is copied to each.
    Every round then moves only ranks and partial sums. Ranks are checkpointed
    per round, so the plan does not grow and a lost executor costs one round.
    """
    sources = sorted(set(sources))
    e = cut_lineage(distinct_edges(edges))
    degrees = out_degrees(e).withColumn(
        "slots", F.greatest(F.ceil(F.col("out_degree") / edges_per_slot), F.lit(1)).cast("int"))
    start = F.when(F.col("node").isin(sources), 1.0 / len(sources)).otherwise(0.0)
    state = cut_lineage(degrees.withColumn("mass", start))

    split = broadcast_if_small(state.filter("slots > 1").select(F.col("node").alias("src"), "slots"))
    slot = F.when(F.col("slots").isNull(), 0).otherwise(F.pmod(F.hash("dst"), F.col("slots")))
    partitions = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = (
        e.join(split, "src", "left").select("src", "dst", slot.alias("slot"))
        .repartition(partitions, "src", "slot").sortWithinPartitions("src", "slot")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    links.count()  # once filled, the kept table's partitioning is known to the rounds' plans

    for _ in range(rounds):
        state = cut_lineage(_step(links, state, sources, alpha))
    links.unpersist()
    total, _ = _masses(state)
    return state.select("node", (F.col("mass") / total).alias("score"))


def _masses(state: DataFrame) -> tuple[float, float]:
    """Total mass and mass on nodes without out-edges: two numbers."""
    row = state.agg(
        F.sum("mass").alias("total"),
        F.coalesce(F.sum(F.when(F.col("out_degree") == 0, F.col("mass"))), F.lit(0.0)).alias("dangling"),
    ).first()
    return row["total"], row["dangling"]


def _step(links: DataFrame, state: DataFrame, sources: Sequence, alpha: float) -> DataFrame:
    """One round. ``mass`` is not normalised; its total is divided out one round later."""
    total, dangling = _masses(state)
    jump = ((1 - alpha) + alpha * dangling / total) / len(sources)
    shares = state.filter("out_degree > 0 AND mass > 0").select(
        F.col("node").alias("src"),
        (F.col("mass") / total / F.col("out_degree")).alias("share"),
        F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"),
    )
    # Merging against the kept order moves the shares only; the edges stay where they are.
    received = links.join(shares.hint("merge"), ["src", "slot"]).groupBy(F.col("dst").alias("node")).agg(
        F.sum("share").alias("received"))
    return state.select("node", "out_degree", "slots").join(received, "node", "left").select(
        "node", "out_degree", "slots",
        (alpha * F.coalesce("received", F.lit(0.0))
         + F.when(F.col("node").isin(list(sources)), jump).otherwise(0.0)).alias("mass"),
    )


def top_nodes(scores: DataFrame, k: int = 10) -> DataFrame:
    return scores.orderBy(F.desc("score"), "node").limit(k)
