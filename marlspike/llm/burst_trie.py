"""Prefix trie of conversations, built as a burst trie over shards.

1. Equal turn sequences collapse to one with its number of copies, its smallest
   conversation and the digest of all its conversations.
2. All sequences start in one container under the root head. A container with more than
   ``CONTAINER_TURNS`` turns bursts: its head moves down the turns that all of it share,
   and each next turn id becomes the head of a container of its own. A round bursts all
   oversized containers at once, so rounds follow the branching, not the length.
3. The other containers are sorted; each is swept once in sequence order, which opens a
   node wherever a sequence leaves its predecessor, and totals go up in reverse order.
4. Totals of containers are added to their heads, last round first.

A container in a task holds at most ``CONTAINER_TURNS`` turns, or one sequence if that is
longer. A sequence is a row of turn ids, 24 bytes a turn; texts are never shuffled. Turns
sort by number, nulls first, those of equal number by turn id (the digest of role and
text). A null role or text counts as empty. Rows without ``conv_id`` are left out. An
empty table gives no node, not even the root.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marlspike.llm.scratch import stored
from marlspike.llm.streamed import joined_sha256

CONTAINER_TURNS = 1 << 13
GROUP, MOST_SHARED = 100, 5
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: per conversation, the id and the code points of each turn, in order."""
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = conversations.filter(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"), F.struct(conversations["turn"], digest.alias("id"), F.length(text).alias("len")).alias("t"))
    in_order = F.sort_array(F.collect_list("t"))
    return turns.groupBy("conv_id").agg(in_order.alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["len"].cast("long").alias("len"))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns`` after the first h turns of each conversation c gave way to those of c - c % 100; h = crc32(c) % 6."""
    own = stored(sequences(conversations), "sequences")
    heads = own.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, MOST_SHARED).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    joined = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % GROUP, "h": h}).join(heads, "base", "left")
    begin = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(begin, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))).alias("turns"))


def _distinct(sequences: DataFrame) -> DataFrame:
    """``ids, lens, n, first, ends``: one row per different sequence."""
    ids = F.transform("turns", lambda t: t["id"])
    key = F.unhex(F.md5(F.array_join(F.transform(ids, F.hex), "").cast("binary")))
    rows = stored(sequences.select("conv_id", key.alias("key"), ids.alias("ids"), F.transform("turns", lambda t: t["len"]).alias("lens")), "rebuilt")
    copies = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("first"))
    members = rows.select("key", "conv_id", F.col("conv_id").cast("string").alias("name"))
    ends = copies.join(joined_sha256(members, "key", "conv_id", "name", ",").withColumnRenamed("sha256", "ends"), "key")
    return rows.join(ends.drop("key"), F.col("conv_id") == F.col("first")).select("ids", "lens", "n", "first", "ends")


def _shared(low: Column, high: Column) -> Column:
    """Length of the common beginning of two different arrays."""
    return F.array_position(F.zip_with(low, high, lambda a, b: a.eqNullSafe(b)), False).cast("int") - 1


def burst(sequences: DataFrame, limit: int = CONTAINER_TURNS) -> tuple[DataFrame, list[DataFrame]]:
    """The containers that are left, a row a sequence, and per round the heads that burst.

    A container's rows have ``head`` (its key), ``up`` (the head above), ``depth`` and the whole sequence.
    """
    root = F.lit(b"")
    now = stored(sequences.select(root.alias("head"), F.lit(None).cast("binary").alias("up"), F.lit(0).alias("depth"), "*"), "container")
    ready, heads = [], []
    while True:
        low, high = F.min(F.struct("ids", "lens", "ends")), F.max("ids")
        sizes = now.groupBy("head", "up", "depth").agg(
            F.count("*").alias("rows"), F.sum(F.size("ids") - F.col("depth") + 1).alias("turns"), low.alias("low"), high.alias("high"),
            F.sum("n").alias("n"), F.min("first").alias("first")).filter((F.col("turns") > limit) & (F.col("rows") > 1))
        over = stored(sizes.select("head", "up", "depth", "n", "first", "low", _shared(F.col("low.ids"), F.col("high")).alias("to")), "heads")
        if over.isEmpty():
            ready.append(now)
            return functools.reduce(DataFrame.unionByName, ready), heads
        heads.append(over)
        ready.append(now.join(over.select("head"), "head", "left_anti"))
        inside = now.join(over.select("head", "to"), "head").filter(F.size("ids") > F.col("to"))
        child = F.unhex(F.md5(F.concat("head", F.element_at("ids", F.col("to") + 1))))
        # depths are part of the key: a head of another depth never has the same turns above it
        now = stored(inside.select(child.alias("head"), F.col("head").alias("up"), (F.col("to") + 1).alias("depth"), "ids", "lens", "n", "first", "ends"), "container")


def swept(rows: list[tuple]) -> list[list]:
    """Nodes of a container from its (suffix, lens, n, first, ends), sorted by suffix; ``lens`` begins with the head's own.

    A node is [depth below the head, parent node, code points, members, first, children, leaves, saved, ends]; the head comes first.
    """
    nodes = [[0, -1, rows[0][1][0], 0, None, 0, 0, 0, None]]
    path, before = [0], []
    for suffix, lens, n, first, ends in rows:
        same = 0
        for a, b in zip(before, suffix):
            if a != b:
                break
            same += 1
        del path[same + 1:]
        for d in range(same, len(suffix)):
            nodes[path[-1]][5] += 1
            nodes.append([d + 1, path[-1], lens[d + 1], 0, None, 0, 0, 0, None])
            path.append(len(nodes) - 1)
        end = nodes[path[-1]]
        end[3], end[4], end[8] = n, first, ends
        before = suffix
    for node in reversed(nodes):  # children stand after their parents
        node[6] = node[6] or 1
        node[7] += (node[3] - 1) * node[2]
        if node[1] >= 0:
            up = nodes[node[1]]
            up[3] += node[3]
            up[4] = node[4] if up[4] is None else min(up[4], node[4])
            up[6] += node[6]
            up[7] += node[7]
    return nodes


def _sweep(containers: DataFrame) -> DataFrame:
    """Nodes of all containers; the parent of a container's own head is told by ``up``."""
    form = pa.schema([("up", pa.binary()), ("top", pa.bool_()), *((c, pa.string() if c == "ends" else pa.int64()) for c in COLUMNS)])

    def finish(up: bytes | None, depth: int, rows: list[tuple]) -> pa.RecordBatch:
        nodes = swept(rows)
        first = [x[4] for x in nodes]
        columns = [[up] * len(nodes), [x[1] < 0 for x in nodes], first, [depth + x[0] for x in nodes], [first[x[1]] if x[1] >= 0 else None for x in nodes],
                   *([x[k] for x in nodes] for k in (3, 5, 6, 7, 8))]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, form)], schema=form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for head, up, depth, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if now is not None and now[0] != head:
                    yield finish(*now[1:], held)
                    held = []
                now = (head, up, depth)
                held.append(row)
        if held:
            yield finish(*now[1:], held)

    rows = containers.repartition("head").sortWithinPartitions("head", "ids")
    depth, rest = F.col("depth"), F.size("ids") - F.col("depth")
    lens = F.when(depth == 0, F.concat(F.array(F.lit(0).cast("long")), "lens")).otherwise(F.slice("lens", F.greatest(depth, F.lit(1)), rest + 1))
    return rows.select("head", "up", "depth", F.slice("ids", depth + 1, rest), lens, "n", "first", "ends").mapInArrow(
        run, "up binary, top boolean, " + ", ".join(f"{c} {'string' if c == 'ends' else 'long'}" for c in COLUMNS))


def _totals(nodes: DataFrame) -> DataFrame:
    """Totals of the containers under each head, from their top nodes."""
    return nodes.filter("top AND up IS NOT NULL").groupBy(F.col("up").alias("head")).agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))


def _chain(heads: DataFrame, totals: DataFrame) -> DataFrame:
    """Nodes from a burst head's first depth down to the turn at which it branched."""
    d = F.col("d")
    text = F.aggregate(F.slice("low.lens", F.greatest(d, F.lit(1)), F.col("to") - F.greatest(d, F.lit(1)) + 1), F.lit(0).cast("long"), lambda a, x: a + x)
    last = d == F.col("to")
    ended = last & (F.size("low.ids") == F.col("to"))
    return heads.join(totals, "head").withColumn("d", F.explode_outer(F.sequence("depth", "to"))).select(
        "up", (d == F.col("depth")).alias("top"), F.col("first").alias("conv_id"), d.cast("long").alias("depth"),
        F.when(d > F.col("depth"), F.col("first")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves",
        (F.col("below") + (F.col("n") - 1) * text).alias("saved_tokens"), F.when(ended, F.col("low.ends")).alias("ends"))


def nodes(sequences: DataFrame, limit: int = CONTAINER_TURNS) -> DataFrame:
    """Every node of the trie: its smallest member, depth, parent's smallest member, members, children, leaves, saved code points, ends.

    ``sequences``: ``conv_id`` (unique) and ``turns``, an array of structs with id (binary) and len.
    """
    containers, heads = burst(_distinct(sequences), limit)
    levels = [stored(_sweep(containers), "nodes")]
    for over in reversed(heads):
        under = functools.reduce(DataFrame.unionByName, [_totals(level) for level in levels])  # a head's containers are of one round or swept
        summed = under.groupBy("head").agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "below")])
        levels.append(stored(_chain(over, summed), "nodes"))
    found = functools.reduce(DataFrame.unionByName, levels)
    if heads:
        above = functools.reduce(DataFrame.unionByName, [h.select(F.col("head").alias("up"), F.col("first").alias("above")) for h in heads])
        tops = found.filter("top").join(above, "up", "left").withColumn("parent_conv_id", F.col("above"))
        found = found.filter("NOT top").unionByName(tops.drop("above"))
    return found.select(*COLUMNS[:-1], F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
