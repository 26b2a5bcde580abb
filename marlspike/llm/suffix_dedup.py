"""Exact removal of long repeated byte strings across all documents.

A string of ``LENGTH`` bytes is a window. Each window belongs to the least hash of the
``K``-byte strings inside it, so equal windows have equal owners; consecutive windows
owned by one place are a run, whose windows all differ. Runs are dealt by owner:

1. An owner met once has no repeats. Runs whose bytes are met twice repeat wholly.
2. Where an owner has different runs, one of each goes to a shard. The shard's bytes are
   suffix-sorted by external induced sorting (``induced``), which carries common
   prefixes along; neighbours that share ``LENGTH`` bytes mark repeated windows.
3. An owner with more bytes than a shard holds (a passage in very many contexts) is dealt
   again by the least of longer strings (``STEPS``), which fewer of its runs share; at
   last by the windows themselves, where equal owners are equal windows.

Matches never cross documents; bytes are those of the UTF-8 text. A null text is empty.
Texts under ``LENGTH`` bytes have no windows. Repeated rows repeat each other. Bytes
covered by a repeated window are removed wherever they stand, the first place included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from marlspike.llm import bytetext as B
from marlspike.llm.induced import DEEPEST, sorted_suffixes
from marlspike.llm.scratch import stored, thinned

LENGTH, K = 200, 32
#: Lengths of the strings by which owners with too many bytes are dealt again, before whole windows.
STEPS = (96, 160, 192)
#: Bytes of texts whose runs are found at a time.
SLICE_BYTES = 1 << 18
#: Bytes that one shard sorts.
SHARD_BYTES = 1 << 20
_A, _B = B.U(0x9E3779B97F4A7C15), B.U(0xC2B2AE3D27D4EB4F)


def _inverse(m: int) -> int:
    return pow(m, -1, 1 << 64)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, mult: np.uint64) -> np.ndarray:
    """64-bit hash of each span of ``data``; spans may overlap."""
    n = len(data)
    have = _powers.get(int(mult))
    if have is None or len(have[0]) < n:
        m = max(n, 2 * SLICE_BYTES)
        up = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(m, mult, np.uint64))])
        down = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(m, _inverse(int(mult)), np.uint64))])
        have = _powers[int(mult)] = (up, down)
        if n > 2 * SLICE_BYTES:
            del _powers[int(mult)]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(B._BYTE[data] * have[0][:n], dtype=np.uint64)])
    return B.mix((total[ends] - total[starts]) * have[1][starts] + (ends - starts).astype(np.uint64) * _B)


def window_owners(data: np.ndarray, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Owner of the window at each place (the last ``length - 1`` places have none), and whether its last string owns it."""
    h, span = B._BYTE[data], 1
    while span < k:
        step = min(span, k - span)
        h = h[:-step] * (_A + B.U(2 * span)) + h[step:]
        span += step
        h ^= h >> B.U(31)
    strings = B.mix(h)
    low, span = strings, 1
    width = length - k + 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[: len(low) - (width - span)], low[width - span:])
    return low, low == strings[width - 1:]


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, k: int = K):
    """(text, start in it, windows, owner, content hash) of every run."""
    sizes = np.diff(offsets) - length + 1
    if not (sizes > 0).any():
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    owners, last = window_owners(data, length, k)
    text = np.flatnonzero(sizes > 0)
    n_each = sizes[text]
    total = int(n_each.sum())
    heads = np.cumsum(n_each) - n_each
    place = np.arange(total) - np.repeat(heads, n_each) + np.repeat(offsets[text], n_each)
    own = owners[place]
    # a new owner, or the same one at a new place
    fresh = last[place]
    fresh[heads] = True
    fresh[1:] |= own[1:] != own[:-1]
    at = np.flatnonzero(fresh)
    count = np.diff(np.append(at, total))
    starts = place[at]
    of = np.repeat(text, n_each)[at]
    content = _span_hashes(data, starts, starts + count + length - 1, _A)
    return of, starts - offsets[of], count, own[at], content


def _runs(pieces: DataFrame, length: int, k: int) -> DataFrame:
    """``uid, start, n, owner, content`` of every run of ``pieces`` (uid, at: place in the text, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = batch.column(1).to_numpy()
            for first, _, data, offsets in B.slices(batch.column(2), SLICE_BYTES):
                of, start, n, owner, content = runs_of(data, offsets, length, k)
                of = of + first
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of)), pa.array(start + base[of], pa.int32()), pa.array(n, pa.int32()),
                     pa.array(owner.view(np.int64)), pa.array(content.view(np.int64))], ["uid", "start", "n", "owner", "content"])

    return pieces.select("uid", "at", "bytes").mapInArrow(run, "uid long, start int, n int, owner long, content long")


def repeated_windows(pieces: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each piece: which of its first ``counts[i]`` windows stand elsewhere in the pieces too."""
    gaps = np.cumsum([0] + [len(p) + 1 for p in pieces])
    text = np.ones(int(gaps[-1]) + 1, dtype=np.int16)  # 1 ends a piece, 0 the text
    for p, at in zip(pieces, gaps):
        text[at:at + len(p)] = np.frombuffer(p, dtype=np.uint8).astype(np.int16) + 2
    text[-1] = 0
    inside = np.zeros(len(text), dtype=bool)
    for at, n in zip(gaps, counts):
        inside[at:at + n] = True
    hit = np.zeros(len(text), dtype=bool)
    for place, common in sorted_suffixes(text):
        # a window holds no end mark, so neighbours that share it are windows as well
        deep = (common >= length) & inside[place]
        hit[place[deep]] = True
        hit[place[np.flatnonzero(deep) - 1]] = True
    return [hit[at:at + n] for at, n in zip(gaps, counts)]


def _intervals(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _shards(pieces: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """``uid, start, n``: repeated windows of sorted shards (``shard, uid, start, n, bytes``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sorted_out(rows):
            flags = repeated_windows([r[4] for r in rows], np.array([r[3] for r in rows]), length)
            uid, start, n = [], [], []
            for r, f in zip(rows, flags):
                a, b = _intervals(f)
                uid += [r[1]] * len(a)
                start += (r[2] + a).tolist()
                n += (b - a).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), pa.array(start, pa.int32()), pa.array(n, pa.int32())], ["uid", "start", "n"])

        rows, held = [], 0
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if held >= shard_bytes and r[0] != rows[-1][0]:
                    yield from sorted_out(rows)
                    rows, held = [], 0
                rows.append(r)
                held += len(r[4])
        if rows:
            yield from sorted_out(rows)

    dealt = pieces.select("shard", "uid", "start", "n", "bytes").repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "uid long, start int, n int")


def _cut(docs: DataFrame, contents: DataFrame, length: int) -> DataFrame:
    """``shard, uid, start, n, bytes`` of the runs that stand for ``contents``; their owner is the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                out = []
                for uid, text, runs in zip(*(c.to_pylist() for c in batch.slice(first, 64).columns)):
                    raw = text.encode()
                    out += [(r["owner"], uid, r["start"], r["n"], raw[r["start"]:r["start"] + r["n"] + length - 1]) for r in runs]
                columns = list(zip(*out)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "uid", "start", "n", "bytes"])

    wanted = contents.select(F.col("one.uid").alias("uid"), F.struct("owner", "one.start", "one.n").alias("run"))
    wanted = stored(wanted.groupBy("uid").agg(F.collect_list("run").alias("runs")), "wanted")
    # a row that stands twice is cut twice: its windows repeat anyway
    return thinned(docs, "uid", wanted).join(wanted, "uid").select("uid", "text", "runs").mapInArrow(
        run, "shard long, uid long, start int, n int, bytes binary")


def repeats(docs: DataFrame, length: int = LENGTH, k: int = K, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``uid, spans``: for texts of ``docs`` (uid, text) with repeated windows, their (start, n) in bytes.

    ``length`` may be up to ``DEEPEST``, the longest common prefix that is counted.
    """
    if length > DEEPEST:
        raise ValueError(f"length {length}: common prefixes are counted up to {DEEPEST}")
    pieces = docs.select("uid", F.lit(0).alias("at"), F.col("text").alias("bytes"))
    steps = [k, *(x for x in STEPS if k < x < length), length]
    spans = []
    for k in steps:
        runs = stored(_runs(pieces, length, k), "runs")
        owners = runs.groupBy("owner").agg(F.count("*").alias("met"), F.min("content").alias("least"), F.max("content").alias("most"))
        owners = stored(owners.filter("met > 1").select("owner", (F.col("least") != F.col("most")).alias("mixed")), "owners")
        again = stored(runs.join(owners, "owner"), "again")
        contents = stored(again.filter("mixed").groupBy("owner", "content").agg(
            F.count("*").alias("met"), F.min_by(F.struct("uid", "start", "n"), F.struct("uid", "start")).alias("one")), "contents")
        spans += [again.filter(~F.col("mixed")).select("uid", "start", "n"),
                  again.filter("mixed").join(contents.filter("met > 1").select("owner", "content"), ["owner", "content"]).select("uid", "start", "n")]

        large = contents.groupBy("owner").agg(F.sum(F.col("one.n") + length - 1).alias("bytes")).filter(F.col("bytes") > shard_bytes)
        large = stored(large.select("owner"), "large_owners")
        split = k < length and large.take(1)
        dealt = contents.join(large, "owner", "left_anti") if split else contents
        spans.append(stored(_shards(_cut(docs, dealt, length), length, shard_bytes), "found"))
        if not split:
            break
        pieces = _cut(docs, contents.join(large, "owner"), length).select("uid", F.col("start").alias("at"), "bytes")
    # as many spans as the text has runs and windows at most
    return reduce(DataFrame.unionByName, spans).distinct().groupBy("uid").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def merged(starts: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs (start, end) of bytes."""
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], np.maximum.accumulate(starts[order] + counts[order] + length - 1)
    fresh = np.concatenate([[True], a[1:] > b[:-1]]) if len(a) else np.zeros(0, bool)
    at = np.flatnonzero(fresh)
    return a[at], b[np.append(at[1:], len(a)) - 1] if len(a) else a


def _clean(rows: DataFrame, length: int) -> DataFrame:
    """``row, n_bytes, n_removed, n_spans, kept_sha256, kept`` of rows with ``row, text, spans``."""
    fields = rows.schema["row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                out = []
                for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    raw = text.encode()
                    a, b = merged(np.array([s["start"] for s in spans], dtype=np.int64), np.array([s["n"] for s in spans], dtype=np.int64), length)
                    keep = b"".join([raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)])])
                    out.append((len(raw), int((b - a).sum()), len(a), hashlib.sha256(keep).hexdigest(), keep.decode("utf-8", "ignore")))
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                                 ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return rows.select("row", "text", "spans").mapInArrow(run, T.StructType([
        fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.StringType())]))


def dedup(docs: DataFrame, length: int = LENGTH, k: int = K, shard_bytes: int = SHARD_BYTES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` as struct ``row`` (without the text), with ``n_bytes, n_removed, n_spans, kept_sha256, kept``.

    ``kept`` is the remaining text; parts of a character whose other bytes went are dropped from it.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if c != text]).alias("row"), F.coalesce(docs[text], F.lit("")).alias("text"))
    rows = rows.withColumn("uid", F.xxhash64("row", "text"))
    spans = stored(repeats(rows.select("uid", "text"), length, k, shard_bytes), "spans")
    # rows that certainly have no spans stay where they are
    slot = F.pmod(F.xxhash64("uid"), F.lit(1 << 20))
    slots = F.broadcast(spans.select(slot.alias("slot")).distinct())
    rows = rows.withColumn("slot", slot)
    maybe = rows.join(slots, "slot", "left_semi").join(spans, "uid", "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)))
    sure = rows.join(slots, "slot", "left_anti").select(
        "row", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), F.col("text").alias("kept"))
    return sure.unionByName(_clean(maybe, length))


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut from the text; a null text becomes empty; ``n_chars``, if there, is set anew."""
    out = dedup(docs, length, text=text)
    new = {text: F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])
