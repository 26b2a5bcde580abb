"""N-gram join, suffix sorting and removal, vector links, components: against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from marlspike.llm import induced, ngram_join, suffix_dedup, vector_links
from marlspike.llm.components import components
from marlspike.llm.prefix_tree import linked
from marlspike.session import exists
from tests.llm.helpers import awkward, documents, prose, sentences


def find(up, i):
    while up[i] != i:
        i = up[i]
    return i


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)] + [(500, 500 + k) for k in range(1, 60)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    up = {i: i for e in edges for i in e if i is not None}
    for a, b in edges:
        if a is not None and b is not None:
            x, y = find(up, a), find(up, b)
            up[max(x, y)] = min(x, y)
    assert all(got.get(i, i) == find(up, i) for i in up)
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute_groups(rows, n, percent):
    sets = collections.defaultdict(list)
    for i, t in rows:
        if i is None:
            continue
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i].append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    up = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and any(x and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(up, a), find(up, b)
                if x != y:
                    up[max(x, y)] = min(x, y)
    return {i: find(up, i) for i in up}, {i: [len(s) for s in sets[i]] for i in sets}


@pytest.mark.parametrize("n,percent,unit", [(4, 85, 1 << 21), (5, 80, 1500), (2, 60, 900)])
def test_near_groups_equal_brute_force(spark, n, percent, unit):
    rnd = random.Random(5)
    base = sentences(9, 70).split()
    rows = awkward() + [(100 + k, " ".join(w if rnd.random() > 0.02 else f"x{rnd.randrange(9)}" for w in base)) for k in range(60)]
    rows += [(200 + k, sentences(rnd.randrange(12), rnd.randrange(2, 50), 40)) for k in range(60)]
    rows += [(300, "Hi there"), (301, "hi  THERE"), (302, "there hi")]
    want, sizes = brute_groups(rows, n, percent)
    got = ngram_join.near_groups(documents(spark, rows, clashing=True), n, percent, unit).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["n_shingles"] in sizes[r["doc_id"]], r


def test_units_of_a_large_candidate_component_stay_bounded(spark, monkeypatch):
    rnd = random.Random(8)
    passages = [sentences(50 + k, 12, 900) for k in range(12)]
    rows = [(i, " ".join(rnd.sample(passages, 5))) for i in range(120)]  # frequent passages, few near copies
    unit, n, seen, join = 1500, 4, collections.Counter(), ngram_join._unit_links

    def spied(units, *args):
        for r in units.select("unit", "text").collect():
            seen[r["unit"]] += len({tuple(r["text"].split()[k:k + n]) for k in range(len(r["text"].split()) - n + 1)})
        return join(units, *args)

    monkeypatch.setattr(ngram_join, "_unit_links", spied)
    want, sizes = brute_groups(rows, n, 80)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_groups(documents(spark, rows), n, 80, unit).collect()}
    assert got == want and 1 < len(set(want.values())) < len(rows)
    assert len(seen) > 5 and max(seen.values()) <= 2 * (unit + max(sizes[i][0] for i in sizes))


def test_copies_are_compared_once_and_leave_little_behind(spark, monkeypatch):
    rnd = random.Random(12)
    bases = [sentences(700 + k, 120, 5000) for k in range(4)]
    rows = [(40 * k + i, base if i % 2 else base.replace(" ", f" x{rnd.randrange(10**6)} ", 1)) for k, base in enumerate(bases) for i in range(40)]
    rows += [(500 + k, sentences(800 + k, 60, 5000)) for k in range(10)]
    # documents of two texts connect those that have either, short as they are
    rows += [(603, "one two"), (607, "one two"), (605, "three"), (607, "three")]
    want, _ = brute_groups(rows, 5, 80)
    most, made, write = collections.Counter(), {}, ngram_join.stored

    def spied(df, label):
        out = write(df, label)
        most[label] = max(most[label], out.count())
        made[out.scratch] = label
        return out

    monkeypatch.setattr(ngram_join, "stored", spied)
    monkeypatch.setattr("marlspike.llm.components.stored", spied)
    out = ngram_join.near_groups(documents(spark, rows))
    left = {label for path, label in made.items() if exists(spark, path)}
    assert all(r["component_id"] == want[r["doc_id"]] for r in out.collect()) and len({want[r[0]] for r in rows}) == 15
    assert max(most.values()) <= 6 * len(rows), most  # not a row for each member of each copy
    assert not left & {"order", "sets", "classes", "keys", "pairs", "large", "small"}, left


def test_labels_change_no_group(spark, monkeypatch):
    rnd = random.Random(13)
    base = [sentences(900 + k, 60, 400).split() for k in range(6)]
    rows = [(i, " ".join(w if rnd.random() > 0.012 * (i % 4) else f"y{rnd.randrange(99)}" for w in base[i % 6])) for i in range(120)]
    want, _ = brute_groups(rows, 3, 80)
    assert 6 < len(set(want.values())) < 110
    for few in (2, 16):  # stars, then pairs
        monkeypatch.setattr(ngram_join, "FEW", few)
        got = ngram_join.near_groups(documents(spark, rows), 3, 80).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_keep_one(spark):
    docs = documents(spark, awkward(), clashing=True)
    out = ngram_join.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == sorted([1, 2, 3, 4, 5, 5, 7, 8, 9, 10, None], key=str)
    assert ngram_join.keep_one(docs.limit(0)).count() == 0


def test_prefix_tree_probes_find_every_link():
    rnd = np.random.default_rng(3)
    for _ in range(40):
        base = rnd.integers(0, 2**63, 30, dtype=np.uint64)
        sets = [np.unique(np.concatenate([rnd.choice(base, rnd.integers(1, 30), replace=False), rnd.integers(0, 2**63, rnd.integers(0, 4), dtype=np.uint64)])) for _ in range(20)]
        for probes in (None, rnd.random(20) < 0.4):
            up = {i: i for i in range(20)}
            for i in range(20):
                for j in range(i):
                    o = len(np.intersect1d(sets[i], sets[j]))
                    if (probes is None or probes[i] or probes[j]) and 100 * o >= 70 * (len(sets[i]) + len(sets[j]) - o):
                        x, y = find(up, i), find(up, j)
                        up[max(x, y)] = min(x, y)
            own = {i: i for i in range(20)}
            for i, j in linked(sets, None, 70, probes):
                x, y = find(own, i), find(own, j)
                assert x != y
                own[max(x, y)] = min(x, y)
            assert all(find(own, i) == find(up, i) for i in range(20))


def test_induced_sorting_equals_naive():
    rng = np.random.default_rng(1)
    for trial in range(250):
        n, k = int(rng.integers(0, 120)), int(rng.choice([1, 2, 3, 6, 40]))
        t = rng.integers(1, k + 1, n)
        if trial % 5 == 0 and n:
            t = np.tile(t[: max(1, n // 7)], 9)
        t = np.append(t, 0)
        raw = t.astype(">u4").tobytes()
        order = sorted(range(len(t)), key=lambda i: raw[4 * i:])
        common = [0]
        for x, y in zip(order, order[1:]):
            c = 0
            while c < induced.DEEPEST and max(x, y) + c < len(t) and t[x + c] == t[y + c]:
                c += 1
            common.append(c)
        # memory 0: every pending tuple goes through the disk; base 0: recursion to the end
        steps = list(induced.sorted_suffixes(t, memory=int(rng.choice([0, 100, 1 << 20])), base=int(rng.choice([0, 5, 1 << 20]))))[::-1]
        assert np.concatenate([p for p, _ in steps]).tolist() == order
        assert np.concatenate([c for _, c in steps]).tolist() == common


def brute_repeats(rows, length):
    count = collections.Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raw:
        for k in range(len(b) - length + 1):
            count[b[k:k + length]] += 1
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length,k,shard", [(200, 32, 8 << 20), (60, 16, 900)])
def test_suffix_dedup_equals_brute_force(spark, length, k, shard):
    rnd = random.Random(4)
    passages = [prose(s, rnd.randrange(40, 400)) for s in range(10)]
    rows = [r for r in awkward() if r[0] != 4]
    for i in range(100, 220):
        parts = [rnd.choice([prose(rnd.random(), rnd.randrange(0, 90)), rnd.choice(passages), rnd.choice(passages)[rnd.randrange(40):], "ab" * rnd.randrange(0, 90)]) for _ in range(rnd.randrange(0, 6))]
        rows.append((i, "".join(parts)))
    rows += [(300, "xy" * 3000), (301, prose(77, 700) * 2), (302, "qz" * 150), (303, "k" * (length + 1)), (304, "v" * length), (305, prose(78, 90) * 9)]
    # one passage in many contexts: more than a shard holds
    rows += [(400 + i, prose(1000 + i, 70) + passages[0] * 2 + prose(2000 + i, 50)) for i in range(60)]
    got = suffix_dedup.dedup(documents(spark, rows, clashing=True).drop("source"), length, k, shard)
    assert sorted((str(r["row"]["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.collect()) == brute_repeats(rows, length)


def test_too_long_windows_are_refused(spark):
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(documents(spark, awkward()), length=induced.DEEPEST + 1)


def test_remove_repeats_keeps_rows_and_columns(spark):
    docs = documents(spark, awkward(), clashing=True)
    out = suffix_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(awkward())
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[5] == "" and text[9] == "" and text[10] == sentences(4, 60) and text[1] == ""
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bucket,tile", [(256, 1024), (16, 20)])
def test_vector_links_equal_brute_force(spark, bucket, tile):
    rng = np.random.default_rng(2)
    rows, centres = [], rng.standard_normal((40, 24))
    for i in range(500):
        c = centres[rng.integers(40)] if i % 3 else rng.standard_normal(24)
        rows.append((i, (c + 0.09 * rng.standard_normal(24)).tolist(), int(rng.integers(3))))
    rows += [(600 + k, rows[4][1], rows[4][2]) for k in range(5)] + [(4, rows[4][1], rows[4][2])]
    odd = [(900, None, 1), (901, [0.0] * 24, 1), (902, [1.0] * 24, None), (903, [float("nan")] * 24, 1), (904, [1.0, None], 1), (905, [1.0, 2.0], 1), (906, [2.0, 4.0], 1),
           (907, [1e-200] * 24, 1), (908, [1e200] * 24, 1), (909, [], 1)]
    rows += odd
    vectors, by = {}, collections.defaultdict(list)
    for k, (i, v, label) in enumerate(rows):
        if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.array(v) / np.abs(v).max()
            vectors[k] = x / np.linalg.norm(x)
            by[label, len(v)].append(k)
    links, up = collections.Counter(), {r[0]: r[0] for r in rows}
    for group in by.values():
        x = np.array([vectors[k] for k in group])
        near = x @ x.T >= vector_links.THRESHOLD
        np.fill_diagonal(near, False)
        for a, b in zip(*np.nonzero(near)):
            links[group[a]] += 1
            p, q = find(up, rows[group[a]][0]), find(up, rows[group[b]][0])
            up[max(p, q)] = min(p, q)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vector_links.links(df.selectExpr("*", "1 AS unit", "2 AS copies"), bucket=bucket, tile=tile).collect()
    assert len(got) == len(rows)
    want = sorted((r[0], links[k], find(up, r[0])) for k, r in enumerate(rows))
    have = sorted(tuple(r)[:3] for r in got)
    total = sum(n for _, n, _ in want)
    assert sum(n for _, n, _ in have) >= 0.98 * total
    if bucket == 256:
        assert have == want
    assert vector_links.links(df.limit(0)).count() == 0
