import random

import pytest

from marlspike.operators import graph as G
from marlspike.sources.files import read_edges
from tests.fixtures.tables import EDGES, PAGERANK


def brute(edges, sources, rounds=10, alpha=0.85):
    edges = set(edges)
    nodes = {n for e in edges for n in e}
    out = {n: [d for s, d in edges if s == n] for n in nodes}
    rank = {n: (1 / len(sources) if n in sources else 0.0) for n in nodes}
    for _ in range(rounds):
        dangling = sum(r for n, r in rank.items() if not out[n])
        new = {n: 0.0 for n in nodes}
        for n, r in rank.items():
            for d in out[n]:
                new[d] += alpha * r / len(out[n])
        for n in sources:
            if n in nodes:
                new[n] += ((1 - alpha) + alpha * dangling) / len(sources)
        total = sum(new.values())
        rank = {n: r / total for n, r in new.items()}
    return rank


def test_published_scores(spark, tmp_path):
    (tmp_path / "edges.txt").write_text(EDGES)
    edges = read_edges(spark, str(tmp_path / "edges.txt"))
    assert edges.count() == 24
    numeric = edges.selectExpr("int(src) AS src", "int(dst) AS dst")
    got = {r.node: r.score for r in G.personalized_pagerank(numeric, [1, 8, 10]).collect()}
    assert got == pytest.approx(PAGERANK, abs=1e-9)
    assert [r.node for r in G.top_nodes(G.personalized_pagerank(numeric, [1, 8, 10]), 3).collect()] == [1, 8, 10]


@pytest.mark.parametrize("per_slot", [100_000, 5])
def test_dangling_duplicates_and_a_hot_node(spark, per_slot):
    rng = random.Random(3)
    edges = [(0, i) for i in range(1, 60)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(60)]
    edges += edges[:20]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.score for r in G.personalized_pagerank(df, [0, 5], rounds=4, edges_per_slot=per_slot).collect()}
    assert got == pytest.approx(brute(edges, [0, 5], rounds=4), abs=1e-12)
    assert sum(got.values()) == pytest.approx(1)


def test_adjacency(spark):
    df = spark.createDataFrame([(1, 5), (1, 5000), (1, 5), (2, 1)], "src long, dst long")
    got = {(r.node, r.segment): (r.out_degree, r.neighbours) for r in G.adjacency(df).collect()}
    assert got == {(1, 0): (2, [5]), (1, 1): (2, [5000]), (2, 0): (1, [1]), (5, None): (0, None), (5000, None): (0, None)}
