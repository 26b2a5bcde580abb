"""Every stage of the corpus pipeline over a small corpus, against plain Python, and the run as a whole."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from marlspike.llm import quality_rules as Q
from marlspike.llm.scratch import stored
from marlspike.sources.tables import table
from tests.llm.helpers import awkward, documents, sentences
from tests.llm.test_duplicates import brute_groups, brute_repeats
from tests.llm.test_text_filters import brute_statistics


def corpus():
    """Clean texts, near copies, shared passages, texts without letters, too short and repetitive ones, and texts full of marks."""
    rnd = random.Random(11)
    rows = [r for r in awkward() if r[0] != 4] + [(20, "12 34 !!"), (21, "# $ % 1 2 3 4 5 6 7 8 9 0")]
    base = sentences(50, 90).split()
    rows += [(100 + k, " ".join(w if rnd.random() > 0.01 else "q" for w in base)) for k in range(12)]
    passage = sentences(60, 60, 900)
    rows += [(200 + k, f"{sentences(300 + k, 70, 5000)} {passage if k % 3 == 0 else ''} {sentences(400 + k, 40, 5000)}") for k in range(40)]
    rows += [(500 + k, " ".join(w + "##" * (rnd.random() < 0.7) for w in sentences(500 + k, 50, 4000).split())) for k in range(40)]
    rows += [(600 + k, sentences(700 + k, 60, 4000)) for k in range(60)]
    return rows, [(i, 0 if i < 600 else 1) for i, _ in rows if i is not None and i >= 500]


def by_id(rows):
    return sorted(rows, key=repr)


def test_stages_equal_plain_python(spark, tmp_path):
    rows, labels = corpus()
    documents(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    sf = str(tmp_path)
    docs, columns = table(spark, sf, "documents"), table(spark, sf, "documents").columns
    after = {}
    for name, stage in P.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), name)
        assert docs.columns == columns
        after[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]

    # without a letter there is no language; everything here is labelled with one
    lettered = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    assert by_id(after["language_id"]) == by_id(lettered)

    flat = stored(Q.statistics(documents(spark, lettered)), "statistics").selectExpr("row.doc_id", "* except(row)")
    known = spark.createDataFrame(labels, "of long, quality int")
    rules = Q.learn(flat.join(known, flat["doc_id"] == known["of"]).filter(~Q.base_failed()), known["quality"] == 0)

    def good(text):
        n, chars, symbols, dup_lines, repeats = brute_statistics(text)
        lines = sum(1 for x in text.split("\n") if x.strip(" \t\x0b\f\r"))
        by = {"symbol_ratio": symbols / max(chars, 1), "dup_line_ratio": dup_lines / max(lines, 1), "repeat_ratio": repeats / max(n, 1),
              "mean_word_chars": chars / max(n, 1), "n_words": float(n)}
        return n >= 10 and 100 * repeats <= 20 * n and not any(all((by[c.feature] > c.limit) == c.above for c in rule) for rule in rules)

    kept = [r for r in lettered if good(r[1])]
    assert rules and by_id(after["quality_rules"]) == by_id(kept)
    ids = {i for i, _ in kept}
    assert not ids & set(range(500, 540)) and set(range(600, 660)) <= ids  # marks go, clean documents stay

    groups, _ = brute_groups(kept, 5, 80)
    unique = [r for r in kept if r[0] is None or groups[r[0]] == r[0]]
    assert by_id(after["ngram_jaccard_join"]) == by_id(unique) and len([i for i, _ in unique if i is not None and 100 <= i < 112]) == 1

    want = sorted((i, sha) for i, _, _, _, sha in brute_repeats(unique, 200))
    assert sorted((str(i), hashlib.sha256(t.encode()).hexdigest()) for i, t in after["suffix_array_dedup"]) == want
    assert sum(len(t) for _, t in after["suffix_array_dedup"]) < sum(len(t) for _, t in unique)

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = []
    for i, t in after["suffix_array_dedup"]:
        full = [*whole.encode(t, add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(full), 4096)):
            part = np.array(full[at:at + 4096], dtype="<u4").tobytes()
            pieces.append((i, k, at, len(part) // 4, zlib.crc32(part)))
    out = P.run(spark, sf).collect()
    assert by_id((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == by_id(pieces)
    room = {}
    for r in sorted(out, key=lambda r: r["offset"]):
        assert room.get(r["sequence_id"], 0) == r["offset"]
        room[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(room.values()) <= 4096 and len(room) <= 1 + -(-sum(p[3] for p in pieces) // 4096)


def test_an_empty_corpus(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
