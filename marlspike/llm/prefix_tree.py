"""Jaccard links among ordered sets, by traversals of a prefix tree."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class Union:
    """Disjoint sets of 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.parts = n

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        self.parts -= 1
        return True


class Node:
    """An edge of the tree: places ``start`` to ``end`` of the sets ``lo`` to ``hi`` (in sorted order), which agree up to ``end``."""

    __slots__ = ("tokens", "lo", "hi", "ends", "children", "least", "most", "rest", "label")

    def __init__(self, tokens, lo, hi, ends, least, most, rest):
        self.tokens, self.lo, self.hi, self.ends = tokens, lo, hi, ends  # sets lo to ends - 1 end here
        self.least, self.most, self.rest = least, most, rest
        self.children: list[Node] = []
        self.label = -1


class PrefixTree:
    """Tree of sets whose members are numbers in one global order.

    ``sets``: ascending members that stand in two sets or more; ``sizes``: sizes of the
    full sets (members found nowhere else count there, but cannot overlap).
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        raw = [s.astype(">u4").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=raw.__getitem__)
        self.sets = [sets[i] for i in self.order]
        self.sizes = np.asarray(sizes)[self.order]
        lens = np.array([len(s) for s in self.sets], dtype=np.int64)
        shared = np.zeros(len(sets), dtype=np.int64)  # leading members that agree with the set before
        for i in range(1, len(sets)):
            a, b = self.sets[i - 1], self.sets[i]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            shared[i] = differ[0] if len(differ) else m
        self.nodes: list[Node] = []
        todo: list[tuple[int, int, int, Node | None]] = [(0, len(sets), 0, None)]
        while todo:
            lo, hi, start, parent = todo.pop()
            end = int(lens[lo]) if hi - lo == 1 else int(shared[lo + 1:hi].min())
            ends = lo + int(np.searchsorted(lens[lo:hi] > end, True))  # sets that end here sort first
            own = self.sizes[lo:hi]
            node = Node(self.sets[lo][start:end], lo, hi, ends, int(own.min()), int(own.max()), int(lens[lo:hi].max()) - end)
            self.nodes.append(node)
            if parent is not None:
                parent.children.append(node)
            if ends < hi:
                cuts = [ends, *(ends + 1 + np.flatnonzero(shared[ends + 1:hi] <= end)).tolist(), hi]
                todo += [(a, b, end, node) for a, b in zip(cuts, cuts[1:])]
        self.root = self.nodes[0]

    def relabel(self, union: Union) -> None:
        """Mark subtrees whose sets are all in one component."""
        label = np.array([union.find(i) for i in self.order])
        change = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        for node in self.nodes:
            node.label = int(label[node.lo]) if change[node.hi - 1] == change[node.lo] else -1

    def links(self, percent: int, n_tokens: int, probes: np.ndarray | None = None, across: bool = False) -> list[tuple[int, int]]:
        """Pairs that connect what is linked, without those that would close a circle.

        Sets link when 100 * overlap >= percent * union. With ``probes`` (flags), only
        pairs with at least one of them are sought; ``across``: with exactly one.
        """
        union, out, fresh = Union(len(self.sets)), [], 0
        flags = np.zeros(n_tokens, dtype=bool)
        held = np.concatenate([[0], np.cumsum(~probes[self.order])]) if across else None
        for rank in range(len(self.sets)):
            x = self.order[rank]
            if probes is not None and not probes[x]:
                continue
            if union.parts == 1:
                break
            own, size = self.sets[rank], int(self.sizes[rank])
            shortest = -(-percent * size // 100)
            longest = 100 * size // percent
            flags[own] = True
            todo = [(self.root, 0)]
            while todo:
                node, overlap = todo.pop()
                # pairs of two probes were met from the one that sorts first
                if node.most < shortest or node.least > longest or (probes is None and node.hi <= rank + 1):
                    continue
                if across and held[node.lo] == held[node.hi]:
                    continue
                if node.label >= 0 and union.find(node.label) == union.find(x):
                    continue
                left = len(own)
                if len(node.tokens):
                    overlap += int(np.count_nonzero(flags[node.tokens]))
                    left -= int(np.searchsorted(own, node.tokens[-1], side="right"))
                # overlap needed with the smallest set below, against the most that may still come
                need = -(-percent * (size + max(node.least, shortest)) // (100 + percent))
                if overlap + min(node.rest, left) < need:
                    continue
                for k in range(node.lo, node.ends):
                    y = self.order[k]
                    if across and probes[y]:
                        continue
                    if k != rank and 100 * overlap >= percent * (size + int(self.sizes[k]) - overlap) and union.join(x, y):
                        out.append((x, y))
                        fresh += 1
                todo += [(child, overlap) for child in node.children]
            flags[own] = False
            if 4 * fresh > len(self.sets):
                self.relabel(union)
                fresh = 0
        return out


def linked(sets: list[np.ndarray], rank_of: Callable[[np.ndarray], np.ndarray] | None, percent: int, probes: np.ndarray | None = None,
           across: bool = False) -> list[tuple[int, int]]:
    """Connecting pairs among sets of 64-bit hashes; ``rank_of`` ranks hashes, rare ones first."""
    if len(sets) < 2:
        return []
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count > 1
    kept = np.flatnonzero(common)
    if rank_of is not None:
        kept = kept[np.lexsort((values[kept], rank_of(values[kept])))]
    place = np.zeros(len(values), dtype=np.int64)
    place[kept] = np.arange(len(kept))
    own, at = [], 0
    for n in sizes:
        part = inverse[at:at + n]
        own.append(np.sort(place[part[common[part]]]))
        at += n
    return PrefixTree(own, sizes).links(percent, max(1, len(kept)), probes, across)
