"""Quality rules and language identification."""

import random
import re

from pyspark.sql import functions as F

from marlspike.llm import langid, quality_rules as Q
from tests.llm.helpers import CLASHING, awkward, documents, sentences


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else set()
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def corpus():
    rnd = random.Random(2)
    rows = awkward()
    for i in range(100, 160):
        rows.append((i, "\n".join(sentences(rnd.randrange(9), rnd.randrange(0, 14), 12) + rnd.choice(["", " a#b $%", " <x>"]) for _ in range(rnd.randrange(1, 9)))))
    return rows


def test_statistics_equal_brute_force(spark):
    rows = corpus()
    got = Q.statistics(documents(spark, rows, clashing=True)).select(
        "row.doc_id", "row.text", "row.words", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[3:] == brute_statistics(r["text"]) and r["words"] == "words"


def test_rules_reject_what_labels_call_bad(spark):
    rnd = random.Random(5)
    rows, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        words = sentences(i, rnd.randrange(30, 80)).split()
        rows.append((i, " ".join(w + "##" * (bad and rnd.random() < 0.6) for w in words)))
        labels.append((i, 0 if bad else 1))
    labels += [(4, None), (None, 0), (9999, 0), (5, 1)]
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    kept = {r["doc_id"] for r in Q.keep_good(documents(spark, rows), known).select("doc_id").collect()}
    assert kept == {i for i in range(300) if i % 3}


def test_no_labels_or_rows(spark):
    known = spark.createDataFrame([], "doc_id long, quality int")
    docs = documents(spark, [(1, sentences(1, 20)), (2, "short"), (3, None)], clashing=True)
    out = Q.keep_good(docs, known)
    assert out.columns == docs.columns and [r["doc_id"] for r in out.collect()] == [1]
    assert Q.keep_good(docs.limit(0), known).count() == 0


def test_quality_main_path_has_no_python(spark):
    plan = Q.statistics(documents(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def language_rows(n):
    rnd = random.Random(7)
    stems = {"en": ["the", "and", "tion", "ing", "ther"], "de": ["sch", "ung", "heit", "ein", "über"], "fr": ["eau", "tion", "é", "les", "que"]}
    return [(i, " ".join("".join(rnd.choices(stems[lang], k=3)) for _ in range(30)), lang) for i, lang in enumerate(rnd.choices(list(stems), k=n))]


def test_language_is_learned_and_predicted(spark):
    rows = language_rows(240)
    docs = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 34 !!", "de"), (902, "the ther", None)], "doc_id long, text string, lang string")
    model = langid.fit(docs, where=F.col("doc_id") < 160)
    assert model[0] == ["de", "en", "fr"]
    got = {r["row"]["doc_id"]: r for r in langid.predict(docs, model).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows if i >= 160)
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und" and got[900]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_counts_equal_brute_force(spark):
    import numpy as np

    from marlspike.llm import bytetext as B

    text = "Übung, the ÉTÉ\n42 ab"
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    bucket, owner, letters = langid.gram_buckets(raw, np.array([0, len(raw)]))
    flat = "".join(c.lower() if c.isalpha() else " " for c in text)
    grams = [flat[i:i + n] for n in (2, 3) for i in range(len(flat) - n + 1) if flat[i:i + n].strip()]
    assert len(bucket) == len(grams) and set(owner) == {0} and letters[0] == sum(c.isalpha() for c in text)
    assert len(set(zip(grams, bucket.tolist()))) == len(set(grams))
    assert B.hash_word("a") != B.hash_word("b")


def test_language_takes_awkward_rows(spark):
    docs = documents(spark, awkward(), clashing=True)
    out = langid.keep_identified(docs)
    assert out.columns == docs.columns and out.select(CLASHING[0]).distinct().count() == 1
    ids = sorted((r["doc_id"] for r in out.collect()), key=str)
    assert 1 not in ids and 2 not in ids and 3 not in ids and ids.count(5) == 2 and None in ids
    assert langid.keep_identified(docs.limit(0)).count() == 0
    assert langid.keep_identified(docs.withColumn("lang", F.lit(None).cast("string"))).count() == 0
