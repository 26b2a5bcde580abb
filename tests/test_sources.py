import random
import struct

import pytest
from pyspark.sql import functions as F

from marlspike.functions.hashing import md5_bucket
from marlspike.functions.timefix import epoch_seconds
from marlspike.sources import blocks, files, prices, sinks
from tests.conftest import rows

GENESIS = (
    "01000000" + "00" * 32 + "3ba3edfd7a7b12b27ac72c3e67768f617fc81bc3888a51323a9fb8aa4b1e5e4a"
    "29ab5f49" "ffff001d" "1dac2b7c"
)


def test_text_and_line_numbers(spark, tmp_path):
    want = []
    for name in ("b.txt", "a.txt", "c.txt"):
        (tmp_path / name).write_text("".join(f"{name} {i}\n" for i in range(400)))
    for name in ("a.txt", "b.txt", "c.txt"):
        want += [f"{name} {i}" for i in range(400)]
    assert files.read_text(spark, str(tmp_path)).columns == ["line"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    try:
        got = {r.line_no: r.line for r in files.numbered_text(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == dict(enumerate(want))


def test_messages_keep_quotes(spark, tmp_path):
    (tmp_path / "m.tsv").write_text('ham\the said "no\nspam\t"win" now\nham\t\nham\n')
    got = rows(files.read_messages(spark, str(tmp_path / "m.tsv")))
    assert got == [(0.0, "ham", 'he said "no'), (1.0, "spam", '"win" now')]


def test_csv_inferred(spark, tmp_path):
    (tmp_path / "x1.csv").write_text("a,b\n1,2.5\n")
    (tmp_path / "x2.csv").write_text("a,b\n2,3.5\n")
    df = files.read_csv_inferred(spark, str(tmp_path / "x*.csv"))
    assert df.dtypes == [("a", "int"), ("b", "double")] and rows(df) == [(1, 2.5), (2, 3.5)]


def test_csv_types_equal_two_pass_inference(spark, tmp_path):
    """Same columns, types and rows as Spark's own inference, which reads the files twice."""
    values = {
        "i": ["1", "-7", "+3", ""], "l": ["1", "3000000000", "", "5"], "d": ["1", "2.5", "1e3", "-.5"], "day": ["2021-01-01", "", "2020-02-29", "1999-12-31"],
        "t": ["2021-01-01 10:00:00", "2021-01-01", "2021-01-01T10:00:00.5", ""], "b": ["true", "FALSE", "", "false"], "s": ["1", "x", "true", ""],
        "none": ["", "", "", ""], "mixed": ["true", "1", "", ""], "bad day": ["2021-13-45", "2021-01-01", "", ""]}
    text = ",".join(values) + "\n" + "".join(",".join(v[k] for v in values.values()) + "\n" for k in range(4))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_text(text)
    got = files.read_csv_inferred(spark, str(tmp_path / "in"))
    want = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "in"))
    assert got.dtypes == want.dtypes and rows(got) == rows(want)
    assert "FileScan csv" not in got._jdf.queryExecution().executedPlan().toString()


def test_epochs(spark):
    raw = ["1609459200", " 1609459200000 ", "2021-01-01 00:00:00", "2021-01-01 00:00:00.000000", "junk", None]
    df = spark.createDataFrame([(r,) for r in raw], "r string")
    assert [r[0] for r in df.select(epoch_seconds(F.col("r"))).collect()] == [1609459200] * 4 + [None, None]


def test_prices(spark):
    df = spark.createDataFrame(
        [("2021-01-01 00:00:00", "1.5", 2.0, 1.0, 1.7), ("bad", "1.5", 2.0, 1.0, 1.7), ("1609462800000", "x", 2.0, 1.0, 1.7)],
        "`Open time` string, Open string, High double, Low double, Close double")
    got = prices.harmonise(df).collect()
    assert [tuple(r)[:6] for r in got] == [(1609459200, 1.5, 2.0, 1.0, 1.7, 0.0)]
    with pytest.raises(ValueError):
        prices.harmonise(spark.createDataFrame([(1.0,)], "Open double"))
    two = spark.createDataFrame([(1, 2.0, 3.0)], "`Date` int, `Volume_(Currency)` double, `Volume_(BTC)` double")
    assert prices.rename_synonyms(two).select("volume").first()[0] == 3.0


def test_duplicate_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "a"])
    assert prices.drop_duplicate_columns(df).collect() == [(1, 2)] and prices.drop_duplicate_columns(df).columns == ["a", "b"]


def record(header, count, body, magic=blocks.MAGIC):
    payload = header + count + body
    return magic + struct.pack("<I", len(payload)) + payload


def test_blocks(spark, tmp_path):
    header = bytes.fromhex(GENESIS)
    wide = [(b"\x01", 1), (b"\xfd\x2c\x01", 300), (b"\xfe" + struct.pack("<I", 70000), 70000),
            (b"\xff" + struct.pack("<Q", 1 << 33), 1 << 33), (b"\xfd\x01", 0)]
    data = record(header, b"\x01", b"x" * 204) + b"\x00\x11\x22"  # unaligned bytes follow
    data += b"".join(record(header, c, b"y" * (20 if n else 0)) for c, n in wide)
    data += record(header, b"\x01", b"z" * 50)[:-10]  # cut-off last record
    (tmp_path / "blk00000.dat").write_bytes(data)
    (tmp_path / "blk00001.dat").write_bytes(record(header, b"\x02", b"") + blocks.MAGIC)
    got = blocks.read_blocks(spark, str(tmp_path)).orderBy("path", "offset").collect()
    first = got[0]
    assert first.block_hash == "000000000019d6689c085ae165831e934ff763ae46a2a6c172b3f1b60a8ce26f"
    assert (first.version, first.timestamp, first.nonce, first.tx_count, first["size"]) == (1, 1231006505, 2083236893, 1, 285)
    assert first.merkle_root == "4a5e1e4baab89f3a32518a88c31bc87f618f76673e2cc77ab2127b7afdeda33b"
    assert first.prev_block == "0" * 64 and first.bits == 0x1D00FFFF
    assert [r.tx_count for r in got] == [1, *[n for _, n in wide], 2]


def spans(content):
    """(offset, length) of each complete record by a walk over the whole file."""
    out, at = [], content.find(blocks.MAGIC)
    while at >= 0:
        start = at + 8
        length = int.from_bytes(content[at + 4:start], "little")
        if start > len(content) or start + length > len(content):
            at = content.find(blocks.MAGIC, at + 1)
            continue
        out.append((start, length, content[start:start + min(length, blocks.KEEP)]))
        at = content.find(blocks.MAGIC, start + length)
    return out


@pytest.mark.parametrize("cut", [300, 1 << 20])
def test_byte_ranges_find_the_same_records(spark, tmp_path, cut):
    """Markers inside payloads and heads, at their ends, in junk and in frames that claim too much; ranges of a few hundred bytes."""
    rnd = random.Random(7)
    want = {}
    for f in range(4):
        data = bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 0, 50])))
        for _ in range(60):
            body = bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 3, 90, 200, 700])))
            for _ in range(rnd.choice([0, 0, 1, 2])):
                k = rnd.randrange(len(body) + 1)
                body = body[:k] + rnd.choice([blocks.MAGIC, blocks.MAGIC + struct.pack("<I", rnd.choice([2, 90, 5000])), blocks.MAGIC[:2]]) + body[k:]
            claim = len(body) if rnd.random() < 0.9 else rnd.choice([0, 1 << 31, len(body) + 40])
            data += blocks.MAGIC + struct.pack("<I", claim) + body + rnd.choice([b"", b"", b"\0\n\r", blocks.MAGIC[2:]])
        data += rnd.choice([b"", blocks.MAGIC, blocks.MAGIC + b"\1"])
        (tmp_path / f"blk{f}.dat").write_bytes(data)
        want |= {(f"blk{f}.dat", o): (n, head) for o, n, head in spans(data)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", cut)
    try:
        found = blocks.pieces(spark, str(tmp_path))
        got = {(r.path.rsplit("/", 1)[1], r.offset): (r.payload_bytes, bytes(r["head"])) for r in blocks.frames(found).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == want


def test_md5_bucket(spark):
    import hashlib

    words = ["a", "free_money", "x" * 50]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(md5_bucket(F.col("w"))).collect()]
    assert got == [int(hashlib.md5(w.encode()).hexdigest(), 16) % (1 << 18) for w in words]
    with pytest.raises(ValueError):
        md5_bucket(F.col("w"), 1000)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for n in (1, 3):
        sinks.write_csv(df.repartition(n), str(tmp_path / "csv"))
        assert rows(spark.read.schema("k int, v string").option("header", True).csv(str(tmp_path / "csv"))) == [(1, "a"), (2, "b")]
    sinks.write_tsv(df, str(tmp_path / "tsv"))
    assert rows(spark.read.schema("k int, v string").option("sep", "\t").csv(str(tmp_path / "tsv"))) == [(1, "a"), (2, "b")]
    sinks.write_parquet(df, str(tmp_path / "pq"), ("k",))
    assert rows(spark.read.parquet(str(tmp_path / "pq")).select("k", "v")) == [(1, "a"), (2, "b")]
    metrics = spark.createDataFrame([("r", "test", "auc", 0.5)], "run_id string, stage string, metric string, value double")
    for _ in range(2):
        sinks.append_metrics(metrics, str(tmp_path / "log"))
    assert spark.read.option("header", True).csv(str(tmp_path / "log")).count() == 2
