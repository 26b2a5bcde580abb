"""The registered queries over small Parquet tables, all rows against plain Python."""

import collections
import random

import numpy as np
import pytest

import __spark_entry__ as entry
from marlspike.llm import quality_rules as Q
from marlspike.llm.scratch import stored
from marlspike.sources.tables import table
from tests.llm.helpers import awkward, documents, sentences
from tests.llm.test_duplicates import find
from tests.llm.test_text_filters import brute_statistics

QUERIES = entry.queries()


def test_op4_one_row_per_vector(spark, tmp_path):
    """Null ids, ids on several vectors, usable and unusable rows under one id."""
    rng = np.random.default_rng(5)
    a, b, c = (rng.standard_normal(16).tolist() for _ in range(3))
    near = lambda v: (np.array(v) + 0.02 * rng.standard_normal(16)).tolist()
    rows = [(1, a, 1), (2, near(a), 1), (2, None, 1), (2, b, 1), (None, near(b), 1), (None, near(a), 1), (None, None, 1), (None, c, 2), (None, near(c), 2),
            (7, b, None), (7, [0.0] * 16, 1), (8, near(b), 1), (8, near(b), 1), (9, c, 1), (3, a, 1), (3, a, 1), (None, [float("inf")] * 16, 1)]
    spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label long, name int, digest string").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    usable = {k: np.array(v) / np.linalg.norm(v) for k, (_, v, label) in enumerate(rows) if v and label is not None and np.isfinite(v).all() and np.any(v)}
    up, links = {k: k for k in range(len(rows))}, collections.Counter()
    for i in usable:
        for j in usable:
            if i != j and rows[i][2] == rows[j][2] and usable[i] @ usable[j] >= 0.93:
                links[i] += 1
                x, y = find(up, i), find(up, j)
                up[max(x, y)] = min(x, y)
    names = collections.defaultdict(list)
    for k, r in enumerate(rows):
        names[find(up, k)] += [r[0]] if r[0] is not None else []
    want = [(r[0], links[k], min(names[find(up, k)], default=None)) for k, r in enumerate(rows)]
    want = [(*w, w[0] == w[2]) for w in want]
    got = QUERIES["op4_embedding_dedup"](spark, str(tmp_path))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and sum(links.values()) > 20


def test_op1_kept_follows_the_rules(spark, tmp_path):
    """Base limits and learned rules, evaluated row by row in plain Python."""
    rnd = random.Random(9)
    rows = awkward()
    for i in range(200, 520):
        words = sentences(i, rnd.randrange(4, 60)).split()
        kind = i % 4
        rows.append((i, " ".join(w + "##" * (kind == 0 and rnd.random() < 0.6) + "x" * 9 * (kind == 1) for w in words) + (" a b c d e" * 8 if i % 9 == 0 else "")))
    labels = [(i, 0 if i % 4 < 2 else 1) for i, _ in rows if i is not None and i >= 200] + [(4, None), (None, 0), (99999, 0), (201, 0)]
    documents(spark, rows, clashing=True).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["op1_quality_rules"](spark, str(tmp_path)).collect()
    flat = stored(Q.statistics(documents(spark, rows)), "statistics").selectExpr("row.doc_id", "* except(row)")
    known = spark.createDataFrame(labels, "of long, quality int")
    rules = Q.learn(flat.join(known, flat["doc_id"] == known["of"]).filter(~Q.base_failed()), known["quality"] == 0)
    assert rules

    def judged(text):
        n, chars, symbols, dup_lines, repeats = brute_statistics(text)
        lines = sum(1 for x in (text or "").split("\n") if x.strip(" \t\x0b\f\r"))
        by = {"symbol_ratio": symbols / max(chars, 1), "dup_line_ratio": dup_lines / max(lines, 1), "repeat_ratio": repeats / max(n, 1),
              "mean_word_chars": chars / max(n, 1), "n_words": float(n)}
        failed = n < 10 or 100 * repeats > 20 * n
        hit = any(all((by[c.feature] > c.limit) == c.above for c in rule) for rule in rules)
        return n, chars, symbols, dup_lines, repeats, failed, not failed and not hit

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert sorted([(r["doc_id"], *(r[c] for c in names)) for r in got], key=repr) == sorted([(i, *judged(t)) for i, t in rows], key=repr)
    assert {r["doc_id"] for r in got if r["kept"] and r["doc_id"] and r["doc_id"] >= 200 and r["doc_id"] % 9} <= {i for i, _ in rows if i and i % 4 >= 2}


def test_op1_learns_on_given_documents(spark):
    """The list is not empty, and rules reject mostly bad rows, as those labelled and not used for growing show."""
    sf = "/root/testdata/sf0.01"
    stats = stored(Q.statistics(table(spark, sf, "documents").select("doc_id", "text")), "statistics").selectExpr("row.doc_id", "* except(row)")
    known = table(spark, sf, "labels").withColumnRenamed("doc_id", "of")
    labelled = stats.join(known, stats["doc_id"] == known["of"]).filter(~Q.base_failed())
    rules = Q.learn(labelled, known["quality"] == 0)
    assert rules
    rejected = labelled.filter(~Q.verdict(rules))
    n, bad = rejected.selectExpr("count(*)", "count_if(quality = 0)").first()
    assert n and bad >= 0.95 * n


@pytest.mark.parametrize("name", ["op1_quality_rules", "op2_best_fit_packing", "op4_embedding_dedup", "op5_language_id", "op6_suffix_dedup",
                                  "op7_ngram_jaccard_join", "op8_warc", "op9_license_scan", "op10_byte_bpe"])
def test_queries_take_empty_tables(spark, tmp_path, name):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0
