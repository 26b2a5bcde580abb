"""Suffix sorting of one shard by induction, with common prefixes, in bounded memory.

Suffixes are of type S if smaller than the next one, else L; leftmost S suffixes (LMS)
are sorted by recursion on the string of their names, all others are induced from them:
L suffixes bucket by bucket upwards, then S suffixes downwards. The queue of pending
suffixes is ordered by first character and then by arrival, which is the order of their
remainders; tuples (place, common prefix with the one before) wait in it and move to
disk when they outgrow ``memory``. Common prefixes come along by induction: one more
than the least common prefix between the two suffixes that induced a pair.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Common prefixes are cut off here, so that they fit a byte.
DEEPEST = 254
#: Reduced strings of at most so many names are sorted in memory.
BASE = 1 << 22
#: Bytes of pending tuples held in memory.
MEMORY = 64 << 20


class BucketQueue:
    """Priority queue of arrays by bucket, first in first out within one; backed by a temporary file."""

    def __init__(self, memory: int):
        self.memory, self.held, self.file = memory, 0, None
        self.parts: dict[int, list] = {}

    def push(self, bucket: int, place: np.ndarray, common: np.ndarray) -> None:
        self.parts.setdefault(bucket, []).append((place, common))
        self.held += place.nbytes + common.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts.values():
            for k, part in enumerate(parts):
                if len(part) == 2:
                    at = self.file.tell()
                    self.file.write(part[0].tobytes())
                    self.file.write(part[1].tobytes())
                    parts[k] = (at, len(part[0]), part[0].dtype)
        self.held = 0

    def pop(self, bucket: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for part in self.parts.pop(bucket, ()):
            if len(part) == 2:
                self.held -= part[0].nbytes + part[1].nbytes
                yield part
            else:
                at, n, kind = part
                self.file.seek(at)
                place = np.frombuffer(self.file.read(n * kind.itemsize), dtype=kind)
                yield place, np.frombuffer(self.file.read(n), dtype=np.uint8)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _run_info(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is S, end of the run of equal characters) of every place; the last character is the only smallest."""
    n = len(text)
    last = np.flatnonzero(text[1:] != text[:-1])  # last places of runs, but for the final run
    grows = text[last + 1] > text[last]
    lengths = np.diff(np.concatenate([[-1], last, [n - 1]]))
    return np.repeat(np.concatenate([grows, [True]]), lengths), np.repeat(np.concatenate([last, [n - 1]]) + 1, lengths)


def _least_between(common: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least of ``common[left + 1 .. right]`` for each pair."""
    out = np.empty(len(left), dtype=np.uint8)
    level = np.frexp((right - left).astype(np.float64))[1] - 1
    table, step = common, 0
    for now in range(int(level.max()) + 1 if len(level) else 0):
        if now:
            half = 1 << step
            table, step = np.minimum(table[:-half], table[half:]), now
        of = np.flatnonzero(level == now)
        if len(of):
            out[of] = np.minimum(table[left[of] + 1], table[right[of] - (1 << now) + 1])
    return out


def _deal(text: np.ndarray, place: np.ndarray, common: np.ndarray, wanted: np.ndarray, queue: BucketQueue, carry: bool) -> None:
    """Push the predecessors of ``place[wanted]``, by their character and in order."""
    at = np.flatnonzero(wanted)
    if not len(at):
        return
    chars = text[place[at] - 1]
    order = np.argsort(chars, kind="stable")
    at, chars = at[order], chars[order]
    heads = np.concatenate([[0], np.flatnonzero(chars[1:] != chars[:-1]) + 1, [len(at)]])
    more = np.ones(len(at), dtype=np.uint8)
    if carry and len(at) > 1:
        inner = np.flatnonzero(chars[1:] == chars[:-1]) + 1
        if len(inner):
            more[inner] = np.minimum(_least_between(common, at[inner - 1], at[inner]), DEEPEST - 1) + 1
    before = place[at] - 1
    for a, b in zip(heads.tolist(), heads[1:].tolist()):
        queue.push(int(chars[a]), before[a:b], more[a:b])


def _pass(text, small, run_end, chars, up: bool, seeds, queue: BucketQueue, carry: bool):
    """Induce all L suffixes upwards (``up``) or all S suffixes downwards.

    ``seeds(c)`` gives what stands behind the induced ones of bucket ``c`` in the order of
    the pass. Yields (bucket, places, common prefixes), in the order of the pass.
    """
    n = len(text)
    for c in chars if up else chars[::-1]:
        places, commons = [], []
        for place, common in queue.pop(int(c)):
            places.append(place)
            commons.append(common)
        if not up and c == text[n - 1]:
            places, commons = [np.array([n - 1], dtype=np.int64)], [np.zeros(1, dtype=np.uint8)]
        if places:
            place, common = np.concatenate(places), np.concatenate(commons)
            done, depth = [(place, common)], 1
            while True:  # runs of c: each round puts one more c in front
                again = np.flatnonzero((place > 0) & (text[place - 1] == c))
                if not len(again):
                    break
                more = np.empty(len(again), dtype=np.uint8)
                more[0] = min(depth, DEEPEST)
                if carry and len(again) > 1:
                    more[1:] = np.minimum(_least_between(common, again[:-1], again[1:]), DEEPEST - 1) + 1
                place, common, depth = place[again] - 1, more, depth + 1
                done.append((place, common))
            place, common = np.concatenate([p for p, _ in done]), np.concatenate([m for _, m in done])
            common[0] = 0
            yield int(c), place, common
        else:
            place, common = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8)
        behind, shared = seeds(int(c))
        if len(behind):
            if len(place) and carry:
                shared = shared.copy()
                shared[0] = min(int(run_end[place[-1]] - place[-1]), int(run_end[behind[0]] - behind[0]), DEEPEST)
            place, common = np.concatenate([place, behind]), np.concatenate([common, shared])
        if len(place):
            front = text[place - 1]
            _deal(text, place, common, (place > 0) & ((front > c) if up else (front < c)), queue, carry)


def _induce(text, small, run_end, lms, common, memory: int, carry: bool):
    """(bucket, places, common prefixes) of all suffixes from sorted LMS suffixes, buckets downwards, places ascending."""
    chars = np.unique(text)
    cuts = np.searchsorted(text[lms], chars, side="left"), np.searchsorted(text[lms], chars, side="right")
    of = {int(c): (int(a), int(b)) for c, a, b in zip(chars, *cuts)}
    queue, large = BucketQueue(memory), BucketQueue(memory)

    def lms_of(c):
        a, b = of[c]
        return lms[a:b], common[a:b]

    for c, place, more in _pass(text, small, run_end, chars, True, lms_of, queue, carry):
        large.push(c, place, more)
    queue.close()
    queue, kept = BucketQueue(memory), {}

    def large_of(c):
        place, more = next(iter(large.pop(c)), (np.zeros(0, np.int64), np.zeros(0, np.uint8)))
        kept[c] = place, more
        return place[::-1], np.concatenate([[0], more[:0:-1]]).astype(np.uint8)

    pending = {}
    for c, place, more in _pass(text, small, run_end, chars, False, large_of, queue, carry):
        pending[c] = place[::-1], np.concatenate([[0], more[:0:-1]]).astype(np.uint8)
        for d in [x for x in kept if x > c]:  # buckets above are complete
            yield d, *_bucket(kept.pop(d), pending.pop(d, None), run_end)
    for d in sorted(kept, reverse=True):
        yield d, *_bucket(kept.pop(d), pending.pop(d, None), run_end)
    queue.close()
    large.close()


def _bucket(low, high, run_end):
    """A bucket's L suffixes and then its S suffixes."""
    if high is None:
        return low
    place, more = high
    if not len(low[0]):
        return high
    more = more.copy()
    more[0] = min(int(run_end[low[0][-1]] - low[0][-1]), int(run_end[place[0]] - place[0]), DEEPEST)
    return np.concatenate([low[0], place]), np.concatenate([low[1], more])


def _double(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string in memory, by doubling; its last character is the only smallest."""
    n, step = len(names), 1
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * np.int64(n + 1)
        key[:-step or n] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        step *= 2


def _agree(text, p, q, start):
    """Common prefix of the suffixes p and q, from ``start`` places on that are known to agree."""
    out = np.minimum(start, DEEPEST).astype(np.int64)
    live = np.flatnonzero(out < DEEPEST)
    n = len(text)
    while len(live):
        a, b = p[live] + out[live], q[live] + out[live]
        live = live[(a < n) & (b < n) & (text[np.minimum(a, n - 1)] == text[np.minimum(b, n - 1)])]
        out[live] += 1
        live = live[out[live] < DEEPEST]
    return out


def sorted_suffixes(text: np.ndarray, memory: int = MEMORY, base: int = BASE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, common prefix with the suffix before) by first character, largest first, ascending within one.

    The last character of ``text`` must be its only smallest. Common prefixes stop at
    ``DEEPEST``; they are 0 at the start of each first character.
    """
    for _, place, common in _levels(text, memory, base):
        yield place, common


def _levels(text, memory, base):
    small, run_end = _run_info(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(lms):  # nothing but the end mark, or descending characters
        lms = np.array([len(text) - 1])
    if len(lms) > 1:
        # 1. sort LMS substrings by induction, 2. name them, 3. sort the string of names
        order = lms[np.argsort(text[lms], kind="stable")]
        is_lms = np.zeros(len(text), dtype=bool)
        is_lms[lms] = True
        parts = [place[is_lms[place]] for _, place, _ in _induce(text, small, run_end, order, np.zeros(len(order), np.uint8), memory, False)]
        by_substring = np.concatenate(parts[::-1])
        index = np.empty(len(text), dtype=np.int64)
        index[lms] = np.arange(len(lms))
        length = np.append(np.diff(lms) + 1, 1)
        names = np.empty(len(lms), dtype=np.int64)
        names[index[by_substring]] = np.concatenate([[0], np.cumsum(_differ(text, by_substring, length[index[by_substring]]))])
        if names.max() == len(lms) - 1:
            ranked = np.argsort(names, kind="stable")
            agreed = np.zeros(len(lms), dtype=np.int64)
        elif len(lms) <= base:
            ranked = _double(names)
            agreed = np.zeros(len(lms), dtype=np.int64)
            agreed[1:] = _agree(names, ranked[:-1], ranked[1:], np.zeros(len(lms) - 1, np.int64))
        else:
            steps = list(_levels(names, memory, base))[::-1]
            ranked = np.concatenate([place for _, place, _ in steps])
            agreed = np.concatenate([common for _, _, common in steps]).astype(np.int64)
        # names that agree, in characters; the next substrings differ
        lms_sorted = lms[ranked]
        known = np.zeros(len(lms), dtype=np.int64)
        known[1:] = lms[np.minimum(ranked[1:] + agreed[1:], len(lms) - 1)] - lms_sorted[1:]
        common = np.zeros(len(lms), dtype=np.uint8)
        common[1:] = _agree(text, lms_sorted[:-1], lms_sorted[1:], known[1:])
        first = np.flatnonzero(text[lms_sorted[1:]] != text[lms_sorted[:-1]]) + 1
        common[first] = 0
    else:
        lms_sorted, common = lms, np.zeros(1, dtype=np.uint8)
    yield from _induce(text, small, run_end, lms_sorted, common, memory, True)


def _differ(text, places, length) -> np.ndarray:
    """Whether each LMS substring differs from the one before it."""
    p, q, m = places[:-1], places[1:], length[1:]
    out = length[:-1] != m
    live = np.flatnonzero(~out)
    step = 0
    while len(live):
        unlike = text[p[live] + step] != text[q[live] + step]
        out[live[unlike]] = True
        step += 1
        live = live[~unlike & (m[live] > step)]
    return out
