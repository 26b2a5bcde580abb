"""Best-fit packing of tokenised documents into fixed-length sequences.

``token_pieces`` tokenises whole texts; only documents longer than a sequence are cut.
``pack`` deals the pieces over parts of ``PART_PIECES``, packs each part by best-fit
decreasing, and certifies its number of sequences by lower bounds from dual-feasible
functions. Parts whose count exceeds their bound exchange the pieces of their unfilled
sequences and are packed anew; so are sequences with much room left while the total
exceeds the bound over all pieces. Only the histogram of lengths (``CAPACITY`` rows)
reaches the driver.

A null or empty text is the end mark alone. Repeated rows are packed as often as they
stand. Ties go to the sequence opened first. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marlspike.llm import bytetext as B
from marlspike.llm.scratch import stored
from marlspike.llm.tokens import WordTokens, packed

CAPACITY = 4096
END_ID = 1
#: Pieces that one task packs at a time.
PART_PIECES = 1 << 15
MAX_ROUNDS = 4
_encoders: dict[str, WordTokens] = {}


def encoder(path: str) -> WordTokens:
    """One encoder per worker process."""
    if path not in _encoders:
        _encoders[path] = WordTokens(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = encoder(vocabulary), packed([END_ID])
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for first, _, data, offsets in B.slices(batch.column(1)):
                raw = data.tobytes()
                for i in range(len(offsets) - 1):
                    ids = words.ids(raw[offsets[i]:offsets[i + 1]]) + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        row.append(first + i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], docs[text]).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each length, and the room left in each bin."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, room = 0, []  # bit r of mask: some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = mask >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = free[r].pop()
            if not free[r]:
                mask &= ~(1 << r)
        else:
            b, r = len(room), capacity
            room.append(capacity)
        bins[i], offsets[i] = b, capacity - r
        room[b] = left = r - size
        if left:
            free[left].append(b)
            mask |= 1 << left
    return bins, offsets, np.array(room, dtype=np.int64)


def lower_bound(histogram: np.ndarray, capacity: int) -> int:
    """No packing of ``histogram[s]`` pieces of each length s has fewer bins: the best of the dual-feasible functions."""
    sizes = np.arange(capacity + 1, dtype=np.int64)
    count = np.zeros(capacity + 1, dtype=np.int64)
    count[: len(histogram)] = histogram
    best = -(-int((count * sizes).sum()) // capacity)
    # lengths over capacity - e count whole, those below e nothing
    many, total = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * sizes)])
    e = np.arange(1, capacity // 2 + 1)
    whole = many[-1] - many[capacity - e + 1]
    rest = total[capacity - e + 1] - total[e]
    if len(e):
        best = max(best, int((whole + -(-rest // capacity)).max()))
    # stepped rounding with k steps
    for k in range(1, 33):
        scaled = (k + 1) * sizes
        even = scaled % capacity == 0
        steps, kept = int((count * (scaled // capacity))[~even].sum()), int((count * sizes)[even].sum())
        best = max(best, -(-(capacity * steps + k * kept) // (k * capacity)))
    return best


def _pack_part(capacity: int):
    def run(part: pa.Table) -> pa.Table:
        lengths = part["length"].to_numpy()
        bins, offsets, room = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        n = len(lengths)
        keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.table([*(part[c] for c in keep), part["part"], pa.array(bins), pa.array(offsets), pa.array(room[bins]),
                         pa.array(np.full(n, len(room))), pa.array(np.full(n, bound))],
                        [*keep, "part", "bin", "offset", "room", "part_sequences", "part_bound"])
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES) -> DataFrame:
    """Pieces with ``sequence_id, offset`` and their part's ``part_sequences`` and certified ``part_bound``."""
    pieces = stored(pieces, "pieces")
    kind = pieces.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part long, bin long, offset long, "
              "room long, part_sequences long, part_bound long")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for r in pieces.groupBy("length").count().collect():
        histogram[r["length"]] = r["count"]
    least = lower_bound(histogram, capacity)

    def rerun(rows: DataFrame, n: int, round_no: int) -> DataFrame:
        # rows are dealt in turn, so parts are even and repeated keys spread
        dealt = rows.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(-(-n // part_pieces))))
        packed_rows = dealt.groupBy("part").applyInArrow(_pack_part(capacity), schema)
        return stored(packed_rows.withColumn("round", F.lit(round_no)), f"packed{round_no}")

    def used(rows: DataFrame) -> int:
        return rows.select("round", "part", "part_sequences").distinct().agg(F.sum("part_sequences")).first()[0] or 0

    n = int(histogram.sum())
    if not n:
        return _sequences(pieces.withColumns({c: F.lit(0).cast("long") for c in ("part", "bin", "offset", "room", "part_sequences", "part_bound", "round")}))
    done, current = [], rerun(pieces, n, 0)
    total = used(current)
    for round_no in range(1, MAX_ROUNDS + 1):
        gap = F.col("part_sequences") > F.col("part_bound")
        reopen = (F.col("room") > 0) & (gap | (4 * F.col("room") >= capacity))
        if total <= least:
            break
        parts = [x.filter(reopen) for x in (*done, current)]
        loose = parts[0]
        for x in parts[1:]:
            loose = loose.unionByName(x)
        size = loose.agg(F.count("*").alias("n"), F.sum(F.col("length")).alias("s")).first()
        before = loose.select("round", "part", "bin").distinct().count()
        if before <= 1 or before <= -(-(size["s"] or 0) // capacity):
            break
        again = rerun(loose.select(*pieces.columns), size["n"], round_no)
        after = used(again)
        if after >= before:
            break
        done = [stored(x.filter(~reopen), "closed") for x in (*done, current)]
        total, current = total - before + after, again
    out = current
    for x in done:
        out = out.unionByName(x)
    return _sequences(out)


def _sequences(rows: DataFrame) -> DataFrame:
    sequence = F.shiftleft(F.col("round").cast("long"), 56) + F.shiftleft(F.col("part"), 28) + F.col("bin")
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset", "part_sequences", "part_bound")
