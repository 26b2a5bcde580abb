"""Counting of word pairs that stand near each other, inside the rows that hold them.

Tokens never leave their row: a task turns the word hashes of its lines into pairs with
numpy and counts them per run of ``STEP`` tokens. The counts of several runs are added up
in bounded memory and leave the task as packed blocks, a block a slice of the pairs.

Words are numbered by their frequency. A pair's key is the number of its rarer word, then
that of the other one, so sorted keys lie close together and a pair takes one or two bytes
of a block. The rarer word also decides on the slice: a word has at most as many partners
as there are more frequent words, so no word makes a slice large. Pairs with a word beyond
the ``MAX_WORDS`` most frequent ones travel by their hashes instead. All counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = 1 << 18
#: Words with a number (12 bytes each are broadcast), and pairs that a task keeps before it packs them.
MAX_WORDS, KEPT = 1 << 22, 1 << 23
#: Meetings of two words that a slice is made for, on average.
SLICE_MEETINGS = 1 << 25
BLOCK = "slice int, numbered boolean, size int, data binary"
MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hash(token: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), token)


def distinct_seed(words: DataFrame) -> int:
    """A seed under which no two of the different words (column ``token``) have the same hash."""
    seed = 0
    while not words.groupBy(word_hash(F.col("token"), seed).alias("h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        seed += 1
    return seed


def _meetings(line: np.ndarray, place: np.ndarray, first: int, last: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i in first:last, of tokens of one line that are fewer than ``distance`` places apart."""
    for d in range(1, distance):
        i = np.arange(first, min(last, len(line) - d))
        i = i[(line[i + d] == line[i]) & (place[i + d] - place[i] < distance)]
        if not len(i):
            return  # nearer tokens are met first, so nobody is left
        yield i, i + d


def _runs(line: np.ndarray, step: int) -> Iterator[tuple[int, int]]:
    """Token ranges of whole lines, up to ``step`` tokens each or a single longer line."""
    ends = np.flatnonzero(np.diff(line, append=-1)) + 1
    first = 0
    while first < len(line):
        k = np.searchsorted(ends, first + step, side="right") - 1
        last = int(ends[k]) if k >= 0 and ends[k] > first else int(ends[k + 1])
        yield first, last
        first = last


Counts = tuple[np.ndarray, ...]


def _added(parts: list[Counts]) -> Counts:
    """Sorted different keys, in one or more columns, and the sums of their counts, which are the last column."""
    *keys, n = parts[0] if len(parts) == 1 else [np.concatenate(c) for c in zip(*parts)]
    order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    return *(k[at] for k in keys), np.add.reduceat(n[order], at) if len(at) else n


def _different(keys: np.ndarray) -> Counts:
    """The same for keys that count one each; sorts them in place."""
    keys.sort()
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    at = np.flatnonzero(new)
    return keys[at], np.diff(at, append=len(keys))


class _Sums:
    """Counts added up as they come; ``all`` gives what was found so far."""

    def __init__(self) -> None:
        self.parts: list[Counts] = []
        self.size = 0

    def add(self, part: Counts) -> None:
        self.parts.append(part)
        self.size += len(part[-1])

    def all(self) -> Counts | None:
        if len(self.parts) > 1:
            self.parts = [_added(self.parts)]
            self.size = len(self.parts[0][-1])
        return self.parts[0] if self.parts else None


def _counted(ids: np.ndarray, line: np.ndarray, place: np.ndarray, distance: int, ordered: bool, number, rest: bool,
             step: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(words, their numbers or -1, x, y, n): pair counts of each run, x and y places in words. Unordered pairs have x < y and count once a line.

    Without ``rest``, words that have no number are left out.
    """
    for first, last in _runs(line, step):
        words, local = np.unique(ids[first:last], return_inverse=True)
        near, own = line[first:last] - line[first], place[first:last]
        numbers = number(words)
        if not rest:
            known = (numbers >= 0)[local]
            local, near, own = local[known], near[known], own[known]
        bits = max(1, int(len(words) - 1).bit_length())
        lines = 0 if ordered or not len(near) else max(1, int(near[-1]).bit_length())
        sums, seen = _Sums(), np.zeros(0, np.int64)
        for a in range(0, len(local), step):  # a single line may be longer than a step
            keys = []
            for i, j in _meetings(near, own, a, min(a + step, len(local)), distance):
                x, y = local[i], local[j]
                if not ordered:
                    other = x != y
                    i, x, y = i[other], np.minimum(x[other], y[other]), np.maximum(x[other], y[other])
                keys.append(((x << bits | y) << lines) | (0 if ordered else near[i]))
            if not keys:
                continue
            if ordered:
                sums.add(_different(np.concatenate(keys)))
            else:
                seen = _different(np.concatenate([seen, *keys]))[0]
        if len(seen):
            sums.add(_different(seen >> lines))
        if found := sums.all():
            yield words, numbers, found[0] >> bits, found[0] & ((1 << bits) - 1), found[1]


def _pack(counts: Counts) -> bytes:
    """Differences of the first key and the other numbers as planes of bytes, most of which are all zero."""
    first, *others = counts
    planes = [np.ascontiguousarray(v.astype(np.int64).view(np.uint8).reshape(-1, 8).T) for v in (np.diff(first, prepend=0), *others)]
    return pa.compress(np.concatenate(planes).tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, size: int, columns: int) -> Counts:
    raw = np.frombuffer(pa.decompress(data, size * 8 * columns, codec="zstd", asbytes=True), np.uint8).reshape(columns, 8, size)
    first, *others = (np.ascontiguousarray(v.T).view(np.int64).reshape(-1) for v in raw)
    return np.cumsum(first), *others


def _blocks(sums: _Sums, starts: np.ndarray | None, slices: int) -> Iterator[pa.RecordBatch]:
    """A block for each slice; ``starts`` are the slices' first keys, None for pairs of hashes."""
    counts = sums.all()
    if counts is None:
        return
    if starts is None:
        own = (((counts[0] ^ counts[1]).view(np.uint64) * MIX) >> np.uint64(33)).astype(np.int64) % slices
        order = np.argsort(own, kind="stable")
        counts, ends = tuple(c[order] for c in counts), np.cumsum(np.bincount(own, minlength=slices))
    else:
        ends = np.append(np.searchsorted(counts[0], starts[1:]), len(counts[0]))
    at = 0
    for k, end in enumerate(ends.tolist()):
        if end > at:
            data = _pack(tuple(c[at:end] for c in counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([starts is not None]), pa.array([end - at], pa.int32()), pa.array([data], pa.binary())],
                ["slice", "numbered", "size", "data"])
        at = end


def pair_counts(lines: DataFrame, words: DataFrame, threshold: int, distance: int, ordered: bool, step: int = STEP) -> DataFrame:
    """``a, b, count`` of the pairs with a count of at least ``threshold``; ``a`` and ``b`` are the words, as ``token, n``.

    ``lines``: ``ids``, the word hashes of a line in order. ``words``: ``id, token, n``, for each
    word the number of lines (unordered) or places (ordered) that hold it, or more. Unordered
    pairs are of different words and count once a line, ordered ones (earlier, later) as
    often as they stand. Null and empty lines have no pairs.
    """
    spark = lines.sparkSession
    sc = spark.sparkContext
    lines = lines.select("ids").filter(F.col("ids").isNotNull())
    # a word's place begins up to distance - 1 ordered pairs, but its line counts once for an unordered one
    least = -(-threshold // (distance - 1)) if ordered else threshold
    frequent = words.filter(F.col("n") >= least).select("id", "token", "n")
    total = frequent.agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).first()
    rest = total["words"] > MAX_WORDS
    table = (frequent.orderBy(F.desc("n"), "id").limit(MAX_WORDS) if rest else frequent).toArrow()
    ids, n = np.asarray(table["id"]), np.asarray(table["n"])
    ranked = np.lexsort((ids, -n))
    by_number = ids[ranked]
    order = np.argsort(by_number)
    slices = max(sc.defaultParallelism, -(-(total["n"] or 0) * (distance - 1) // SLICE_MEETINGS))
    width, bits = -(-len(ids) // slices), max(1, len(ids).bit_length())
    # the pairs of a slice have the numbers slice, slice + slices, ... of their rarer words; a key has three parts
    starts = (np.arange(slices) * width) << (bits + 1)
    shared = sc.broadcast((by_number[order], order.astype(np.int32)))
    # with all words at hand, pairs are named where they are counted
    named = pa.StructArray.from_arrays([table["token"].combine_chunks(), table["n"].combine_chunks()], ["token", "n"]).take(pa.array(ranked))
    decode = sc.broadcast(by_number if rest else named)

    def number(words: np.ndarray) -> np.ndarray:
        known, numbers = shared.value
        if not len(known):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        return np.where(known[at] == words, numbers[at], -1).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed, wide = _Sums(), _Sums()
        for batch in batches:
            ids, sizes = np.asarray(batch.column(0).flatten()), np.diff(np.asarray(batch.column(0).offsets))
            line = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            for words, numbers, x, y, n in _counted(ids, line, place, distance, ordered, number, rest, step):
                a, b = numbers[x], numbers[y]
                if rest:
                    other = (a < 0) | (b < 0)
                    wide.add(_added([(words[x[other]], words[y[other]], n[other])]))
                    a, b, n = a[~other], b[~other], n[~other]
                rare, hot = np.maximum(a, b), np.minimum(a, b)
                key = ((rare % slices * width + rare // slices) << bits | hot) << 1 | ((a > b) if ordered else 0)
                keyed.add(_added([(key, n)]))
                for sums, first in ((keyed, starts), (wide, None)):
                    if sums.size > KEPT:
                        sums.all()
                    if sums.size > KEPT // 2:
                        yield from _blocks(sums, first, slices)
                        sums.__init__()
        yield from _blocks(keyed, starts, slices)
        yield from _blocks(wide, None, slices)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed, wide, most = _Sums(), _Sums(), KEPT
        for batch in batches:
            for numbered, size, data in zip(*(batch.column(c).to_pylist() for c in ("numbered", "size", "data"))):
                (keyed if numbered else wide).add(_unpack(data, size, 2 if numbered else 3))
                if keyed.size + wide.size > most:
                    keyed.all(), wide.all()
                    most = max(KEPT, 2 * (keyed.size + wide.size))
        found = []
        if counts := keyed.all():
            key, n = (c[counts[1] >= threshold] for c in counts)
            rare, hot = key >> (bits + 1), key >> 1 & ((1 << bits) - 1)
            rare = rare % width * slices + rare // width
            # unordered pairs are named in any order
            later = key & 1 == 1
            found.append((np.where(later, rare, hot), np.where(later, hot, rare), n, decode.value))
        if counts := wide.all():
            found.append((*(c[counts[2] >= threshold] for c in counts), None))
        for x, y, n, names in found:
            for at in range(0, len(n), 1 << 16):
                pair = [v[at:at + (1 << 16)] for v in (x, y)]
                if names is not None:
                    pair = [names.take(pa.array(v)) if names_are_words else names[v] for v in pair]
                yield pa.RecordBatch.from_arrays([*map(pa.array, pair), pa.array(n[at:at + (1 << 16)], pa.int64())], ["a", "b", "count"])

    word, names_are_words = ("long", False) if rest else ("struct<token: string, n: bigint>", True)
    blocks = lines.mapInArrow(count, BLOCK).repartitionById(slices, F.col("slice"))
    pairs = blocks.mapInArrow(add, f"a {word}, b {word}, count long")
    if not rest:
        return pairs
    first = frequent.select(F.col("id").alias("a"), F.struct("token", "n").alias("_a"))
    second = frequent.select(F.col("id").alias("b"), F.struct("token", "n").alias("_b"))
    return pairs.join(first, "a").join(second, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"), "count")
