"""Numpy helpers on the UTF-8 bytes of Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at a time; bounds the numpy arrays of a task. A longer text is handled alone.
SLICE_BYTES = 1 << 20

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
_MULT = U(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)


def separators(*spans: tuple[int, int]) -> np.ndarray:
    """Table of the bytes that belong to words: all but the given inclusive spans."""
    table = np.ones(256, dtype=bool)
    for lo, hi in spans:
        table[lo:hi + 1] = False
    return table


#: Words are runs of anything but ASCII white space.
NON_SPACE = separators((0x20, 0x20), (0x09, 0x0D))
#: Words are runs of ASCII letters, digits and non-ASCII characters, after lower-casing.
WORD_CHARS = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, their bytes, offsets of each text in them); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(2 * n, _MULT, dtype=np.uint64))])
    return _powers[:n]


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Starts and ends of the words and the text each is in; words never cross texts."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = table[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (edge[:-1] | ~before))
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each span of bytes, A-Z folded on request."""
    out = np.empty(len(starts), dtype=np.uint64)
    lens = ends - starts
    total = np.cumsum(lens)
    i = 0
    while i < len(starts):
        base = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, base + SLICE_BYTES, side="right")))
        part = lens[i:j]
        heads = np.cumsum(part) - part
        within = np.arange(int(part.sum())) - np.repeat(heads, part)
        chars = data[within + np.repeat(starts[i:j], part)]
        if lower:
            chars = LOWER[chars]
        terms = _BYTE[chars] * _power(int(part.max()))[within]
        out[i:j] = mix(np.add.reduceat(terms, heads) + part.astype(np.uint64) * U(0xD6E8FEB86659FD93))
        i = j
    return out


def hash_word(word: str) -> int:
    """The hash that ``word_hashes`` gives to one word."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(word_hashes(raw, np.array([0]), np.array([len(raw)]))[0])


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (texts are not told apart here)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = words[:m].copy()
    for j in range(1, n):
        acc *= U(0xBF58476D1CE4E5B9)
        acc ^= acc >> U(29)
        acc += words[j:j + m]
    return mix(acc)


def strings_at(column: pa.Array, first: int, last: int) -> list:
    return column.slice(first, last - first).to_pylist()
