"""Conversation structure repair by generalised LR parsing (``role_grammar``).

``numbered`` sorts all turns over range partitions, so that a conversation of any length
spans as many as it needs, and finds each row's first fault. ``report`` parses every
range: a conversation inside one range is parsed there; the piece of one that began in an
earlier range is parsed from every stack it may start from, and the few pieces at range
borders are joined in order. ``repaired`` carries out the audits.

A null role or text counts as one space. Turns sort by number, nulls first; rows of equal
turn by role, then by the digest of their text. A role counts by its first character, an
empty role as one that must be changed. Rows with a null ``conv_id`` form one
conversation. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marlspike.llm import role_grammar as G
from marlspike.llm.scratch import ordered, stored

SPACE = "\\x20\\x09-\\x0D"
ROLES = {"u": "user", "a": "assistant"}
LEGAL_NEIGHBOURS = ("su", "ua", "au")
BATCH = 8192
COUNTS = ("blank", "duplicate", "truncated", "illegal")


def plain(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` without null roles and texts."""
    space = lambda c: F.coalesce(conversations[c].cast("string"), F.lit(" ")).alias(c)
    return conversations.select(conversations["conv_id"], conversations["turn"], space("role"), space("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20: 0 drops one, 1 empties its text, 2 removes its
    ``[.!?]``, 3 repeats it, 4 sets its role to user."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    rows = plain(conversations).withColumn("__kind", kind).filter("__kind != 0").withColumns({
        "text": F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("__kind") == 4, "user").otherwise(F.col("role"))})
    copies = F.when(F.col("__kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("__copy", F.explode_outer(copies)).select("conv_id", "turn", "role", "text")


def _last_sign(text: Column) -> Column:
    """The last character that is not white space; empty if there is none."""
    return F.regexp_extract(text, f"([^{SPACE}])[{SPACE}]*\\z", 1)


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` in order, with ``rn`` and ``fault`` (a letter of ``role_grammar``)."""
    digest = F.unhex(F.md5(F.concat_ws("\0", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), "role", "text").cast("binary")))
    rows = ordered(plain(conversations).withColumn("digest", digest), ["conv_id", "turn", "role", "digest"], "turns")
    again = rows.groupBy("digest").agg(F.min("rn").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    last = _last_sign(F.col("text"))
    fault = (F.when(last == "", G.BLANK).when(F.col("rn") > F.col("first"), G.DUPLICATE)
             .when(~last.isin(".", "!", "?"), G.TRUNCATED).otherwise(G.SOUND))
    return rows.join(again, "digest", "left").select("conv_id", "turn", "role", "text", "rn", fault.alias("fault"))


class _Piece:
    """The rows of one conversation in one range, parsed as they come."""

    def __init__(self, conv_id: int | None, rn: int, anywhere: bool) -> None:
        self.conv_id, self.rn, self.n = conv_id, rn, 0
        self.runs = {s: G.Run(s) for s in (range(len(G.STACKS.nodes)) if anywhere else (0,))}
        self.counts, self.first, self.last = dict.fromkeys(COUNTS, 0), "", ""

    def add(self, initial: str, fault: str) -> None:
        for run in self.runs.values():
            run.feed(initial, fault)
        if self.n == 0:
            self.first = initial
        elif self.last + initial not in LEGAL_NEIGHBOURS:
            self.counts["illegal"] += 1
        if fault:
            self.counts[{G.BLANK: "blank", G.DUPLICATE: "duplicate", G.TRUNCATED: "truncated"}[fault]] += 1
        self.last, self.n = initial, self.n + 1

    def row(self, edge: bool) -> dict:
        ends = [{"start": s, "end": e, "cost": c, "audit": a} for s, run in self.runs.items() for e, (c, a) in run.ends().items()]
        return {"conv_id": self.conv_id, "rn": self.rn, "n": self.n, "edge": edge, "first": self.first, "last": self.last, "ends": ends, **self.counts}


def _matrix(ends: list[dict]) -> dict[int, dict[int, G.Value]]:
    out: dict[int, dict[int, G.Value]] = {}
    for e in ends:
        out.setdefault(e["start"], {})[e["end"]] = (e["cost"], e["audit"])
    return out


def _whole(pieces: list[dict]) -> dict:
    """One conversation's report from its pieces, in order."""
    cost, audit = G.best(G.joined([_matrix(p["ends"]) for p in pieces]))
    counts = {c: sum(p[c] for p in pieces) for c in COUNTS}
    counts["illegal"] += sum(a["last"] + b["first"] not in LEGAL_NEIGHBOURS for a, b in zip(pieces, pieces[1:]))
    return {"conv_id": pieces[0]["conv_id"], "rn": pieces[0]["rn"], "n": sum(p["n"] for p in pieces), "cost": cost, "audit": audit, **counts}


def report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``numbered`` rows: ``conv_id, rn`` (of its first row), ``n, cost, audit`` and counts of faults."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    counts = "".join(f", {c} long" for c in COUNTS)
    ends = "array<struct<start:int,end:int,cost:bigint,audit:string>>"
    arrow_id = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    arrow_counts = [(c, pa.int64()) for c in COUNTS]
    piece = pa.schema([("conv_id", arrow_id), ("rn", pa.int64()), ("n", pa.int64()), ("edge", pa.bool_()), ("first", pa.string()), ("last", pa.string()),
                       ("ends", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))), *arrow_counts])
    whole = pa.schema([("conv_id", arrow_id), ("rn", pa.int64()), ("n", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), *arrow_counts])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces in order; the first and the last of a range may go on elsewhere."""
        now, out, first = None, [], True
        for batch in batches:
            for conv_id, rn, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        out.append(now.row(edge=first))
                        first = False
                    now = _Piece(conv_id, rn, anywhere=now is None)
                    if len(out) >= BATCH:
                        yield pa.RecordBatch.from_pylist(out, piece)
                        out = []
                now.add(initial, fault)
        if now is not None:
            yield pa.RecordBatch.from_pylist([*out, now.row(edge=True)], piece)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([_whole([p]) for p in batch.to_pylist()], whole)

    def stitch(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([_whole(sorted(table.to_pylist(), key=lambda p: p["rn"]))], whole)

    symbols = rows.select("conv_id", "rn", F.substring("role", 1, 1).alias("initial"), "fault")
    pieces = stored(symbols.repartitionByRange("rn").sortWithinPartitions("rn").mapInArrow(
        parse, f"conv_id {kind}, rn long, n long, edge boolean, first string, last string, ends {ends}{counts}"), "pieces")
    form = f"conv_id {kind}, rn long, n long, cost long, audit string{counts}"
    inner = pieces.filter(~F.col("edge")).mapInArrow(finish, form)
    return inner.unionByName(pieces.filter("edge").groupBy("conv_id").applyInArrow(stitch, form))


def edits(reports: DataFrame) -> DataFrame:
    """``conv_id, position, rn, edit, new_role``: the turns of every repaired conversation; ``rn`` is null for inserted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "position", "rn", "edit", "new_role"]
        for batch in batches:
            for k in range(batch.num_rows):
                conv_id, rn, audit = (batch.column(i)[k] for i in range(3))
                rn, audit, out, position = rn.as_py(), audit.as_py(), [], 0
                lead = (len(audit) - audit.count(G.DELETE)) % 2  # an odd number of turns begins with a system turn
                for edit in audit:
                    if edit != G.DELETE:
                        role = None if edit == G.KEEP else ROLES["ua"[(position - lead) % 2]]
                        out.append((position, None if edit == G.INSERT else rn, edit, role))
                        position += 1
                    rn += edit != G.INSERT
                    if len(out) == BATCH:
                        yield _batch(conv_id, out, names)
                        out = []
                if out:
                    yield _batch(conv_id, out, names)

    kind = reports.schema["conv_id"].dataType.simpleString()
    return reports.select("conv_id", "rn", "audit").mapInArrow(run, f"conv_id {kind}, position long, rn long, edit string, new_role string")


def _batch(conv_id: pa.Scalar, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays([pa.array([conv_id.as_py()] * len(rows), conv_id.type), *columns], names)


def repaired(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The repaired conversations, a row a turn: ``conv_id, position, role, text, edit``."""
    todo = edits(reports)
    old = todo.filter("rn IS NOT NULL").join(rows.select("rn", "role", "text"), "rn").select(
        "conv_id", "position", F.coalesce("new_role", "role").alias("role"), "text", "edit")
    new = todo.filter("rn IS NULL").select("conv_id", "position", F.col("new_role").alias("role"), F.lit("").alias("text"), "edit")
    return old.unionByName(new)


def gaps(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps``: turn numbers missing between the least and the largest."""
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return rows.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
