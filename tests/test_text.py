import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlspike.functions import tokens as T
from marlspike.operators import index as I
from marlspike.operators import near
from marlspike.operators import text as X
from marlspike.session import cut_lineage
from tests.conftest import rows

LINES = [
    "Don't stop, PERFECT storm; perfect storm!", "", "één café naïve", "one", "perfect",
    " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)),
    "to be or not to be", "the perfect storm the perfect calm the end", "123 456", "  spaced   out  ",
] + ["the quick fox and the dog"] * 8 + ["fox dog quick"] * 3


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(0, i, s) for i, s in enumerate(LINES)], "doc_id long, line_no int, line string")


def toks(s):
    return re.findall("[a-z]+", s.lower())


def test_both_tokenisers(lines):
    got = lines.select("line", T.letters(F.col("line")).alias("a"), T.letters_by_match(F.col("line")).alias("b")).collect()
    for r in got:
        assert r.a == r.b == toks(r.line)


def test_alnum_null(spark):
    df = spark.createDataFrame([(None,), ("A1 b-2",)], "s string")
    assert [r[0] for r in df.select(T.alphanumerics(F.col("s"))).collect()] == [[], ["a1", "b", "2"]]


def test_followers(lines):
    want = Counter(b for s in LINES for a, b in zip(toks(s), toks(s)[1:]) if a == "perfect")
    assert rows(X.followers(lines, "perfect")) == sorted((w, n) for w, n in want.items() if n > 1)


def test_relative_frequencies_pairs_equal_stripes(lines):
    counts = X.bigram_counts(lines)
    pairs = rows(X.relative_frequencies(counts))
    assert pairs == rows(X.stripe_relative_frequencies(counts))
    assert pairs == rows(X.stripe_relative_frequencies(counts, segments=1))
    heads = Counter(a for s in LINES for a in toks(s)[:-1])
    assert all(abs(f - n / heads[a]) < 1e-12 for a, _, f, n in pairs)


def test_stripe_segments_are_whole_and_small(spark):
    counts = cut_lineage(spark.range(3000).selectExpr("'hot' AS w1", "concat('t', id) AS w2", "id AS count").union(
        spark.range(5).selectExpr("'cold' AS w1", "concat('t', id) AS w2", "id AS count")))
    striped = X.stripes(counts, "w1", "w2", 30)
    sizes = {(r.w1, r.segment): len(r.stripe) for r in striped.collect()}
    assert sum(sizes.values()) == 3005 and max(sizes.values()) < 160
    # the item alone decides on the segment, however large the key
    place = {}
    for r in striped.collect():
        for item in r.stripe:
            assert place.setdefault(item, r.segment) == r.segment


@pytest.mark.parametrize("most", [0, 2, 1 << 15])
def test_large_stripes_are_dealt_and_others_whole(lines, monkeypatch, most):
    monkeypatch.setattr(X, "MOST_FOLLOWERS", most)
    counts = X.bigram_counts(lines)
    assert rows(X.stripe_relative_frequencies(counts, 3)) == rows(X.relative_frequencies(counts))


def test_stripes_are_shuffled_once(lines):
    """Heads are gathered as plain rows; neither their lists nor a join with their totals is shuffled."""
    plan = X.stripe_relative_frequencies(X.bigram_counts(lines))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def brute_pmi(units, threshold, distance):
    units = [u for u in units if len(set(u)) > 1]
    n = Counter(t for u in units for t in set(u))
    c = Counter()
    for u in units:
        c.update({tuple(sorted((u[i], u[j]))) for i in range(len(u)) for j in range(i + 1, min(len(u), i + distance)) if u[i] != u[j]})
    return {p: (math.log10(k * len(units) / (n[p[0]] * n[p[1]])), k) for p, k in c.items() if k >= threshold}


@pytest.mark.parametrize("distance", [40, 3])
@pytest.mark.parametrize("threshold", [1, 5])
def test_pmi_pairs_and_stripes(lines, distance, threshold):
    want = brute_pmi([toks(s) for s in LINES], threshold, distance)
    got = {(r.x, r.y): (r.pmi, r["count"]) for r in X.pmi_pairs(lines, threshold, distance).collect()}
    assert set(got) == set(want)
    assert all(got[p][1] == want[p][1] and abs(got[p][0] - want[p][0]) < 1e-9 for p in want)
    both = {(r.x, r.y): r.pmi for r in X.pmi_stripes(lines, threshold, distance, segments=3).collect()}
    assert len(both) == 2 * len(want)
    assert all(abs(both[p] - want[p][0]) < 1e-9 and abs(both[p[::-1]] - want[p][0]) < 1e-9 for p in want)


def test_pairs_cross_places_and_chunks(spark):
    """Pairs near place 40 and across the chunks of a long line are counted, once per line; ordered pairs each time."""
    words = ["w" + "abcdefghij"[i % 10] + "abcdefghij"[i // 10 % 10] for i in range(100)] * 2
    df = spark.createDataFrame([(1, 0, " ".join(words))], "doc_id long, line_no int, line string")
    want = brute_pmi([words], 1, 5)
    ordered = Counter((words[i], words[j]) for i in range(200) for j in range(i + 1, min(200, i + 5)))
    assert tuple(sorted((words[39], words[40]))) in want
    for chunk in (7, 4096):
        got = {(r.x, r.y): r["count"] for r in X.cooccurrence(X.baskets(df), 1, distance=5, chunk=chunk).collect()}
        assert got == {p: k for p, (_, k) in want.items()}
        raw = {(r.x, r.y): r["count"] for r in X.positional_pmi(df, 1, distance=5, chunk=chunk).collect()}
        assert raw == ordered


@pytest.mark.parametrize("settings", [{}, {"MAX_WORDS": 3}, {"KEPT": 5, "SLICE_MEETINGS": 50}, {"MAX_WORDS": 7, "KEPT": 5}])
def test_pair_blocks_of_any_size(lines, monkeypatch, settings):
    """Numbered and other words, and blocks that leave a task early, give the same counts."""
    for name, value in settings.items():
        monkeypatch.setattr(near, name, value)
    units = [toks(s) for s in LINES]
    for threshold in (1, 5):
        want = {p: k for p, (_, k) in brute_pmi(units, threshold, 40).items()}
        assert {(r.x, r.y): r["count"] for r in X.cooccurrence(X.baskets(lines), threshold).collect()} == want
        ordered = Counter((u[i], u[j]) for u in units for i in range(len(u)) for j in range(i + 1, min(len(u), i + 40)))
        assert {(r.x, r.y): r["count"] for r in X.positional_pmi(lines, threshold).collect()} == {p: k for p, k in ordered.items() if k >= threshold}


def test_packed_pairs_take_a_few_bytes():
    """Pairs leave a task in blocks of their sorted keys; a row a pair took 24 bytes and more."""
    r = np.random.default_rng(3)
    rare, hot = r.integers(0, 5000, 400_000), (5000 * r.random(400_000) ** 3).astype(np.int64)
    keys, n = np.unique(rare << 14 | hot << 1, return_counts=True)
    data = near._pack((keys, n))
    assert len(data) < 3 * len(keys)
    assert all((a == b).all() for a, b in zip(near._unpack(data, len(keys), 2), (keys, n)))


def test_terms_are_not_shuffled(lines):
    """Only the lines are: later grouping by document and term stays in their partitions."""
    tf = I.term_frequencies(I.line_groups(lines, 3))
    plan = tf._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(doc_id" in plan
    lists = tf.groupBy("doc_id", "grp").agg(F.collect_list("term"))
    assert lists._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_index_of_gathered_blocks(spark, lines, tmp_path, monkeypatch):
    """Lists of several stretches and repeated documents give the same blocks as plain term frequencies."""
    monkeypatch.setattr(I, "DOCS_PER_SEGMENT", 4)
    monkeypatch.setattr(I, "DOCS_PER_STRETCH", 2)
    monkeypatch.setattr(I, "GROUPS_PER_SEGMENT", 2)
    many = lines.crossJoin(spark.range(11).select(F.col("id").alias("d"))).select(F.col("d").alias("doc_id"), "line_no", "line")
    groups = I.line_groups(many.union(many.filter("doc_id = 5")), 3)
    want = Counter()
    for d in [*range(11), 5]:
        for i, s in enumerate(LINES):
            want.update((d, i // 3, t) for t in toks(s))
    for k, tf in enumerate((I.block_term_frequencies(groups), I.term_frequencies(groups))):
        index = I.write_index(tf, str(tmp_path / f"index{k}"), parts=40)
        got = {}
        for r in index.postings().collect():
            assert r.n == len(r.postings) and r.most == max(p.tf for p in r.postings)
            assert [(p.doc_id, p.grp) for p in r.postings] == sorted((p.doc_id, p.grp) for p in r.postings)
            assert {(p.doc_id // 4, p.grp // 2) for p in r.postings} == {(r.doc_block, r.grp_block)}
            got |= {(p.doc_id, p.grp, r.term): p.tf for p in r.postings}
        assert got == want


def test_search(spark, lines, tmp_path):
    index = I.write_index(I.term_frequencies(I.line_groups(lines, 3)), str(tmp_path / "index"))
    queries = {"a": ["fox", "dog", "dog"], "b": ["unknownterm", "fox"], "c": ["perfect"]}
    docs = {}
    for i, s in enumerate(LINES):
        docs.setdefault(i // 3, Counter()).update(toks(s))
    for op, need in (("AND", all), ("OR", any)):
        want = sorted(
            (k, 0, g, sum(c[t] for t in set(ts))) for k, ts in queries.items()
            for g, c in docs.items() if need(c[t] for t in set(ts)))
        assert rows(I.search(index, queries, op)) == want
    report = I.report(index, queries, k=2)
    assert report.groupBy("query_id", "op").count().filter("count > 2").count() == 0
    assert not [r for r in report.collect() if r.query_id == "b" and r.op == "AND"]


def test_index_segments_are_bounded(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(I, "DOCS_PER_SEGMENT", 10)
    tf = spark.range(95).selectExpr("id AS doc_id", "0 AS grp", "'hot' AS term", "1L AS tf")
    segments = I.write_index(tf, str(tmp_path / "index")).lists().collect()
    assert len(segments) == 10 and {r.df for r in segments} == {95}
    assert sorted(p.doc_id for r in segments for p in r.postings) == list(range(95))


@pytest.fixture
def many_blocks(spark, tmp_path, monkeypatch):
    """An index of 60 blocks with skewed and tied frequencies, and its rows."""
    monkeypatch.setattr(I, "DOCS_PER_SEGMENT", 20)
    tf = [(d, g, t, 1 + (d * 7 + g * 3 + len(t)) % 5 + (40 if d % 300 == 7 else 0))
          for d in range(1200) for g in range(2) for t in ("hot", "warm", "cold") if t == "hot" or d % (3 if t == "warm" else 50) == 0]
    return I.write_index(spark.createDataFrame(tf, "doc_id long, grp int, term string, tf long"), str(tmp_path / "index")), tf


def brute_ranks(tf, terms, k, every):
    docs = {}
    for d, g, t, n in tf:
        if t in terms:
            docs.setdefault((d, g), {})[t] = n
    hits = sorted((-sum(c.values()), *key) for key, c in docs.items() if not every or len(c) == len(set(terms)))
    return [(r + 1, d, g, -s) for r, (s, d, g) in enumerate(hits[:k])], len(hits)


QUERIES = {"one": ["hot"], "two": ["hot", "cold"], "three": ["hot", "warm", "cold"], "none": ["absent"], "part": ["absent", "warm"]}


@pytest.mark.parametrize("k", [1, 3, 10, 5000])
def test_top_k_by_blocks_equals_brute_force(many_blocks, k):
    index, tf = many_blocks
    got = I.top_k(index, QUERIES, k).collect()
    for name, terms in QUERIES.items():
        assert sorted(tuple(r)[1:] for r in got if r.query_id == name) == brute_ranks(tf, terms, k, False)[0]


def test_report_equals_brute_force(many_blocks):
    index, tf = many_blocks
    got = I.report(index, QUERIES, 10).collect()
    for name, terms in QUERIES.items():
        for op in ("AND", "OR"):
            ranks, total = brute_ranks(tf, terms, 10, op == "AND")
            mine = sorted((r["rank"], r.doc_id, r.grp, r.score) for r in got if (r.query_id, r.op) == (name, op))
            assert mine == ranks and {r.total_hits for r in got if (r.query_id, r.op) == (name, op)} == ({total} if total else set())


def test_blocks_below_the_top_are_skipped(many_blocks):
    """Four documents hold far more than the others: their blocks alone are read for the top four."""
    index, _ = many_blocks
    left = I.surviving_blocks(index, {"one": ["hot"], "three": ["hot", "warm", "cold"]}, 4)
    assert {(r.query_id, r.doc_block) for r in left.collect()} == {(q, d // 20) for q in ("one", "three") for d in (7, 307, 607, 907)}


TEXTS = [(1, "A b a b"), (1, "a b"), (2, "x"), (3, ""), (4, None), (None, "a b c"), (None, "a"), (5, "a_b a b"), *[(6, "b a")] * 4]


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_hashed_ngrams_of_repeated_and_null_ids(spark, monkeypatch, most):
    monkeypatch.setattr(X, "MOST_TEXTS", most)
    want = Counter()
    for i, s in TEXTS:
        t = re.findall("[a-z0-9]+", (s or "").lower())
        want.update((i, int(hashlib.md5(g.encode()).hexdigest(), 16) % 1024) for g in [*t, *map("_".join, zip(t, t[1:]))])
    got = X.hashed_ngrams(spark.createDataFrame(TEXTS, "d long, s string"), "d", "s", 1024).collect()
    assert len(got) == len(want) and {(r.d, r.idx): r.n for r in got} == want


def test_grams_are_not_shuffled(spark):
    """Only the texts are, and they are cut into words once."""
    plan = X.hashed_ngrams(spark.createDataFrame(TEXTS, "d long, s string"), "d", "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("[^a-z0-9]+") == 1
