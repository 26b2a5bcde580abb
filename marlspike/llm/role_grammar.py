"""Generalised LR repair of a row of role initials, with a graph-structured stack.

The grammar says what a conversation may be: nothing, or an optional ``s`` followed by
``ua`` pairs. Its LR(0) automaton is built from the rules. A stack is a node of a graph:
a state on top of another node; equal stacks are one node, so stacks share what is below.
Reductions without alternative happen at once. The list ``P`` is left-recursive, so only a
handful of stacks exist, however long the row is.

Each token of the row is kept, reroled or deleted, and tokens may be inserted anywhere.
The frontier holds, per stack, the least (cost, audit); the audit has one letter an edit.
Where two ways lead to an equal stack, the lesser stays.
"""

from __future__ import annotations

import os.path
from collections.abc import Iterable

RULES = (("Z", "C"), ("C", ""), ("C", "P"), ("P", "p"), ("P", "sp"), ("P", "Pp"), ("p", "ua"))
TERMINALS, REROLES = "sua", "ua"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
#: Faults of a row; the first two must be deleted.
BLANK, DUPLICATE, TRUNCATED, SOUND = "b", "d", "t", ""
#: From any stack, what another could still do costs at most so much more: two insertions
#: to complete a pair (10) and the deletion of a leading ``s`` (2). Dearer stacks cannot win.
SLACK = 2 * COSTS[INSERT] + COSTS[DELETE]
FLUSH = 128

Value = tuple[int, str]
Items = frozenset[tuple[int, int]]


def _closure(items: Iterable[tuple[int, int]]) -> Items:
    done, todo = set(), list(items)
    while todo:
        item = todo.pop()
        if item not in done:
            done.add(item)
            todo += [(i, 0) for i, (left, _) in enumerate(RULES) if RULES[item[0]][1][item[1]:item[1] + 1] == left]
    return frozenset(done)


def _goto(items: Items, symbol: str) -> Items:
    return _closure((r, dot + 1) for r, dot in items if RULES[r][1][dot:dot + 1] == symbol)


class Stacks:
    """The graph of all stacks; node 0 is the empty one. ``shift`` and ``accepts`` are tables."""

    def __init__(self) -> None:
        self.nodes: list[tuple[Items, int]] = [(_closure([(0, 0)]), -1)]
        self._known = {self.nodes[0]: 0}
        self.shift: list[dict[str, int]] = []
        while len(self.shift) < len(self.nodes):  # nodes appear as shifts reach them
            node = len(self.shift)
            self.shift.append({t: self._push(node, t) for t in TERMINALS if _goto(self.nodes[node][0], t)})
        self.accepts = [self._accepts(node) for node in range(len(self.nodes))]

    def _push(self, node: int, symbol: str) -> int:
        top = (_goto(self.nodes[node][0], symbol), node)
        (rule, dot), *others = top[0]
        left, right = RULES[rule]
        if not others and dot == len(right):
            for _ in right[1:]:
                node = self.nodes[node][1]
            return self._push(node, left)
        if top not in self._known:
            self._known[top] = len(self.nodes)
            self.nodes.append(top)
        return self._known[top]

    def _accepts(self, node: int) -> bool:
        """Whether the reductions at the end of the row lead to the start symbol."""
        items = self.nodes[node][0]
        while True:
            complete = [RULES[r] for r, dot in items if dot == len(RULES[r][1])]
            if not complete:
                return False
            left, right = complete[0]
            if left == "Z":
                return True
            for _ in right:
                node = self.nodes[node][1]
            items = _goto(self.nodes[node][0], left)


STACKS = Stacks()


class Run:
    """The frontier of one run: feed it rows, then ask for the ends."""

    def __init__(self, start: int = 0) -> None:
        self.frontier: dict[int, Value] = {start: (0, "")}
        self.done: list[str] = []  # what all audits begin with
        self.fed = 0
        self._insert()

    def _insert(self) -> None:
        front, least = self.frontier, min(self.frontier.values())[0]
        todo = list(front)
        while todo:
            node = todo.pop()
            cost, audit = front[node]
            value = (cost + COSTS[INSERT], audit + INSERT)
            if value[0] <= least + SLACK:
                for t in REROLES:
                    to = STACKS.shift[node].get(t)
                    if to is not None and (to not in front or value < front[to]):
                        front[to] = value
                        todo.append(to)
        self.frontier = {n: v for n, v in front.items() if v[0] <= least + SLACK}

    def feed(self, initial: str, fault: str) -> None:
        """One row: its role's first character and its fault."""
        out: dict[int, Value] = {}

        def offer(node: int | None, value: Value) -> None:
            if node is not None and (node not in out or value < out[node]):
                out[node] = value

        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for node, (cost, audit) in self.frontier.items():
            offer(node, (cost + COSTS[DELETE], audit + DELETE))
            if fault not in (BLANK, DUPLICATE):
                offer(STACKS.shift[node].get(initial), (cost + COSTS[KEEP] + extra, audit + KEEP))
                for t in REROLES:
                    offer(STACKS.shift[node].get(t), (cost + COSTS[REROLE] + extra, audit + REROLE))
        self.frontier = out
        self._insert()
        self.fed += 1
        if self.fed % FLUSH == 0:
            same = os.path.commonprefix([a for _, a in self.frontier.values()])
            self.done.append(same)
            self.frontier = {n: (c, a[len(same):]) for n, (c, a) in self.frontier.items()}

    def ends(self) -> dict[int, Value]:
        """Least (cost, audit) per stack."""
        before = "".join(self.done)
        return {n: (c, before + a) for n, (c, a) in self.frontier.items()}


def joined(parts: list[dict[int, dict[int, Value]]]) -> dict[int, Value]:
    """Ends of a row cut into parts, from each part's ends by the stack it starts from."""
    front, done = {0: (0, "")}, []
    for part in parts:
        out: dict[int, Value] = {}
        for node, (cost, audit) in front.items():
            for to, (more, then) in part[node].items():
                value = (cost + more, audit + then)
                if to not in out or value < out[to]:
                    out[to] = value
        same = os.path.commonprefix([a for _, a in out.values()])
        done.append(same)
        front = {n: (c, a[len(same):]) for n, (c, a) in out.items()}
    before = "".join(done)
    return {n: (c, before + a) for n, (c, a) in front.items()}


def best(ends: dict[int, Value]) -> Value:
    """The least accepted (cost, audit)."""
    return min(v for n, v in ends.items() if STACKS.accepts[n])
