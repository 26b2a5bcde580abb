"""Registered graph queries: parts linked in the order they appear on an order's lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlspike.operators import graph as G
from marlspike.operators import series as S
from marlspike.plans.registry import query
from marlspike.sources.tables import table

SOURCES = (1, 8, 10)
SINK_BRAND = "Brand#11"

EDGES = """
    e AS MATERIALIZED (SELECT DISTINCT src, dst FROM (SELECT l_partkey AS src,
      lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS dst
      FROM lineitem) WHERE dst IS NOT NULL)
"""
OPEN_EDGES = f"""{EDGES},
    open_e AS MATERIALIZED (SELECT src, dst FROM e JOIN part ON src = p_partkey WHERE p_brand <> '{SINK_BRAND}')
"""


def _rounds(edges, n):
    """The oracle's rounds, written out as one CTE each."""
    src = ", ".join(map(str, SOURCES))
    parts = [f"""
    nodes AS MATERIALIZED (SELECT n.node, coalesce(d.d, 0) AS d FROM (SELECT src AS node FROM {edges} UNION SELECT dst FROM {edges}) n
      LEFT JOIN (SELECT src AS node, count(*) AS d FROM {edges} GROUP BY src) d ON n.node = d.node),
    r0 AS MATERIALIZED (SELECT node, d, CASE WHEN node IN ({src}) THEN 1.0::DOUBLE / {len(SOURCES)} ELSE 0::DOUBLE END AS r FROM nodes)"""]
    for i in range(n):
        parts.append(f"""
    u{i} AS MATERIALIZED (SELECT nodes.node, nodes.d, 0.85::DOUBLE * coalesce(c, 0) + CASE WHEN nodes.node IN ({src})
        THEN (0.15::DOUBLE + 0.85::DOUBLE * (SELECT coalesce(sum(r), 0) FROM r{i} WHERE d = 0)) / {len(SOURCES)} ELSE 0 END AS u
      FROM nodes LEFT JOIN (SELECT dst, sum(r / d) AS c FROM {edges} JOIN r{i} ON src = node GROUP BY dst) ON dst = nodes.node),
    r{i + 1} AS MATERIALIZED (SELECT node, d, u / (SELECT sum(u) FROM u{i}) AS r FROM u{i})""")
    return ",".join(parts)


def edges(spark, sf):
    """The next part on the same order, by one global ordering.

    Ordering all lines at once, and not order by order, keeps an order with
    very many lines from becoming one task.
    """
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")

    def follow(df, w):
        return df.withColumns({"_order": F.lead("l_orderkey", 1).over(w), "dst": F.lead("l_partkey", 1).over(w)})

    pairs = S.ordered_window(li, ["l_orderkey", "l_linenumber", "l_partkey"], follow, before=0, after=1)
    return pairs.filter(F.col("_order") == F.col("l_orderkey")).select(F.col("l_partkey").alias("src"), "dst")


def open_edges(spark, sf):
    """The same edges without those leaving parts of one brand, which leaves dangling nodes."""
    parts = table(spark, sf, "part").filter(F.col("p_brand") != SINK_BRAND).select(F.col("p_partkey").alias("src"))
    return G.distinct_edges(edges(spark, sf)).join(parts, "src").select("src", "dst")


@query("gr_adjacency", f"""
    WITH {OPEN_EDGES}
    SELECT node, coalesce(d, 0) AS out_degree, segment, neighbours
    FROM (SELECT src AS node FROM open_e UNION SELECT dst FROM open_e)
    LEFT JOIN (SELECT src, dst // 4096 AS segment, string_agg(dst, ' ' ORDER BY dst) AS neighbours FROM open_e GROUP BY ALL) ON src = node
    LEFT JOIN (SELECT src AS k, count(*) AS d FROM open_e GROUP BY src) ON k = node
""")
def gr_adjacency(spark, sf):
    return G.adjacency(open_edges(spark, sf)).withColumn(
        "neighbours", F.array_join(F.col("neighbours").cast("array<string>"), " "))


def _scores(edge_table):
    return G.personalized_pagerank(edge_table, SOURCES).select("node", F.round("score", 9).alias("score"))


@query("gr_ppr", f"WITH {EDGES},{_rounds('e', 10)} SELECT node, round(r, 9) AS score FROM r10")
def gr_ppr(spark, sf):
    return _scores(edges(spark, sf))


@query("gr_ppr_dangling", f"WITH {OPEN_EDGES},{_rounds('open_e', 10)} SELECT node, round(r, 9) AS score FROM r10")
def gr_ppr_dangling(spark, sf):
    return _scores(open_edges(spark, sf))


@query("gr_topk", f"""
    WITH {EDGES},{_rounds('e', 10)}
    SELECT node, round(r, 9) AS score FROM r10 ORDER BY score DESC, node LIMIT 10
""")
def gr_topk(spark, sf):
    return G.top_nodes(_scores(edges(spark, sf)), 10)
