"""Sharding by sampled splitters against a sort of all rows."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlspike.llm import queries, sharding
from tests.llm.helpers import awkward, documents, sentences


def brute(rows, n=8):
    """(doc_id, size, crc, law, shard, slot, None) by one sort and running sums."""
    text = lambda x: (x or "").encode()
    units = sorted(((hashlib.md5(text(x)).digest(), i is not None, i or 0, len(text(x)) + 1, zlib.crc32(text(x))) for i, x in rows))
    total, largest, groups = sum(u[3] for u in units), max(u[3] for u in units), collections.Counter()
    for u in units:
        groups[u[0]] += u[3]
    out, at, begins, slots = [], 0, {}, collections.Counter()
    for digest, known, i, size, crc in units:
        middle = 2 * at + size if groups[digest] > largest else 2 * begins.setdefault(digest, at) + groups[digest]
        shard = min(n - 1, middle * n // (2 * total))
        out.append((i if known else None, size, crc, "bytes", shard, slots[shard], None))
        slots[shard] += 1
        at += size
    return sorted(out, key=repr)


def corpus(kind: str) -> list[tuple]:
    rnd = random.Random(2)
    plain = [(100 + k, sentences(k, rnd.randrange(1, 90))) for k in range(400)]
    hot = sentences(77, 50)
    return {
        "awkward": awkward(),
        "plain": plain,
        "hot group": plain + [(1000 + k, hot) for k in range(300)] + [(1300 + k, sentences(78 + k % 3, 30)) for k in range(9)],
        "one row repeated": plain[:100] + [(5, hot)] * 200,
        "only nulls": [(k, None) for k in range(50)] + [(None, None)] * 3,
        "one giant": plain[:60] + [(7, sentences(1, 60000))],
        "one row": [(1, "x")],
    }[kind]


@pytest.mark.parametrize("kind", ["awkward", "plain", "hot group", "one row repeated", "only nulls", "one giant", "one row"])
def test_query_equals_one_sort(spark, tmp_path, kind):
    rows = corpus(kind)
    documents(spark, rows, clashing=True).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_sharding(spark, str(tmp_path))
    assert dict(got.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == brute(rows)
    sizes, largest = collections.Counter(), max(g[1] for g in got)
    for g in got:
        sizes[g[4]] += g[1]
    share = sum(sizes.values()) / 8
    assert all(abs(sizes[k] - share) <= largest for k in range(8))


def test_no_range_stays_overfull(spark):
    """Ranges hold at most twice their share, save single records and small groups."""
    df = documents(spark, corpus("hot group"))
    keys = sharding.keyed(df, F.col("text"), F.col("doc_id"), F.octet_length("text") + 1).select("key", "size")
    total, largest = keys.agg(F.sum("size"), F.max("size")).first()
    cuts, sizes, counts = sharding.splitters(spark, keys, total, largest, 8)
    share = total / (8 * sharding.RANGES)
    assert sizes.sum() == total and counts.sum() == df.count() and len(sizes) == len(cuts) + 1
    assert all(s <= max(2 * share, largest) or n == 1 for s, n in zip(sizes, counts))
    hot = hashlib.md5(sentences(77, 50).encode()).digest()
    inside = [c for c in cuts.tolist() if c.ljust(32, b"\0")[:16] == hot]
    assert len(inside) > 8  # the hot group alone is dealt over many ranges


def test_shards_as_files(spark, tmp_path):
    df = documents(spark, corpus("plain"), clashing=True)
    done = sharding.sharded(df, 5, F.col("text"), F.col("doc_id"), F.octet_length("text"))
    sharding.write_shards(done, f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(r["row"]["text"] for r in back.collect()) == sorted(x for _, x in corpus("plain"))
    slots = collections.defaultdict(list)
    for r in back.select("shard", "slot").collect():
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(5)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_numbers_sort_as_bytes(spark):
    numbers = [None, -(1 << 63), -5, -1, 0, 1, 300, (1 << 63) - 1]
    df = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", sharding._eight_bytes(F.col("n")).alias("b"))
    got = {r["n"]: bytes(r["b"]) for r in df.collect()}
    assert [got[n] for n in numbers[1:]] == sorted(got[n] for n in numbers[1:]) and got[None] == got[-(1 << 63)]


def test_empty(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op12_sharding(spark, str(tmp_path)).count() == 0
    assert len(np.unique(np.array([], "S32"))) == 0
