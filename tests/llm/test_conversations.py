"""Prefix trie and structure repair of conversations: queries and operators against brute force."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from marlspike.llm import burst_trie, queries, repair
from marlspike.llm import role_grammar as G
from tests.llm.helpers import prose

SCHEMA = "conv_id long, turn long, role string, text string, head string, rn long"


def conversations(seed: int = 3, n: int = 260) -> list[tuple]:
    """Shared beginnings, copies, nulls, ties, repeated rows, gaps, one long conversation."""
    rnd, out = random.Random(seed), []
    lines = [prose(k, 12) + rnd.choice(".!?,") for k in range(6)] + ["", " \t", None, "é∂ü. \n"]
    for c in range(n):
        for t in range(rnd.randrange(1, 9)):
            if rnd.random() < 0.95:
                role = rnd.choice(["system", "user", "user", "assistant", "assistant", "tool", None]) if rnd.random() < 0.3 else ("user", "assistant")[t % 2]
                out.append((c, rnd.choice([t, t, t, t, None]) if rnd.random() < 0.1 else t, role, lines[0] if t < 2 and c % 3 else rnd.choice(lines)))
    out += [(1000 + c, t, ("user", "assistant")[t % 2], f"copy {t}.") for c in range(40) for t in range(30)]
    out += [(1100, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(700)]
    out += out[:5] + [(None, 0, "user", "no id."), (None, 1, "assistant", "no id."), (250, 3, "user", "tie."), (250, 3, "user", "tie!")]
    return [(*r, "clash", 7) for r in out]


def written(spark, tmp_path, rows, parts=5) -> str:
    spark.createDataFrame(rows, SCHEMA).repartition(parts).write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def by_conversation(rows):
    out = collections.defaultdict(list)
    for c, t, role, text, *_ in rows:
        out[c].append((t, role, text))
    return out


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- prefix trie --------------------------------------------------------------

def brute_trie(rows):
    own = {}
    for c, turns in by_conversation(rows).items():
        if c is not None:
            named = [(t is not None, t or 0, hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode()).digest(), (r or "", x or "")) for t, r, x in turns]
            own[c] = [x[3] for x in sorted(named)]
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
    return brute_nodes(whole)


def brute_nodes(whole):
    members = collections.defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted([(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    sha(",".join(str(c) for c in sorted(m) if whole[c] == p))) for p, m in members.items()], key=repr)


def test_trie_query_equals_brute_force(spark, tmp_path):
    rows = conversations()
    got = queries.op11_conversation_trie(spark, written(spark, tmp_path, rows))
    assert got.columns == [*burst_trie.COLUMNS[:-1], "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(rows)


def test_bursts_give_the_same_trie(spark):
    """Containers that burst several times, under shared runs of turns that one burst passes at once."""
    rows, limit = conversations(4, 150), 60
    whole = burst_trie.rebuilt(spark.createDataFrame(rows, SCHEMA))
    _, heads = burst_trie.burst(burst_trie._distinct(whole), limit)
    assert len(heads) >= 2
    assert sorted(map(tuple, burst_trie.nodes(whole, limit).collect()), key=repr) == brute_trie(rows)


def test_a_sequence_that_ends_where_a_head_branches(spark):
    whole = {1: ("a", "b"), 2: ("a", "b", "c"), 3: ("a", "b", "d"), 4: (), 5: ("a", "b", "d")}
    rows = [(c, [(x.encode(), len(x)) for x in t]) for c, t in whole.items()]
    df = spark.createDataFrame(rows, "conv_id long, turns array<struct<id:binary,len:bigint>>")
    want = brute_nodes({c: tuple(("", x) for x in t) for c, t in whole.items()})
    for limit in (1, 100):
        assert sorted(map(tuple, burst_trie.nodes(df, limit).collect()), key=repr) == want


def test_containers_are_bounded(spark):
    whole = burst_trie.rebuilt(spark.createDataFrame(conversations(), SCHEMA))
    ready, _ = burst_trie.burst(burst_trie._distinct(whole), 300)
    sizes = ready.groupBy("head").agg(F.sum(F.size("ids") - F.col("depth") + 1).alias("turns"), F.count("*").alias("rows")).collect()
    assert all(s["turns"] <= 300 or s["rows"] == 1 for s in sizes)


# --- structure repair ---------------------------------------------------------

def cheapest(rows):
    """(cost, audit) by search over all edits, cheapest and ASCII-least first."""
    heap, legal, begun = [(0, "", 0, "")], re.compile(r"(s?(ua)+)?\Z"), re.compile(r"s?(ua)*u?\Z")
    while True:
        cost, audit, i, out = heapq.heappop(heap)
        if i == len(rows) and legal.match(out):
            return cost, audit
        ways = [(5, "I", i, out + r) for r in "ua"] if audit.count("I") <= len(rows) + 2 else []
        if i < len(rows):
            initial, fault = rows[i]
            ways.append((2, "D", i + 1, out))
            if fault not in ("b", "d"):
                more = 5 if fault == "t" else 0
                ways += [(more, "K", i + 1, out + (initial or "?")), *((1 + more, "R", i + 1, out + r) for r in "ua")]
        for c, edit, j, then in ways:
            if begun.match(then):
                heapq.heappush(heap, (cost + c, audit + edit, j, then))


def test_parser_equals_search():
    rnd = random.Random(8)
    for _ in range(250):
        rows = [(rnd.choice(["s", "u", "u", "a", "a", "x", ""]), rnd.choice(["", "", "", "b", "d", "t"])) for _ in range(rnd.randrange(6))]
        run = G.Run()
        for row in rows:
            run.feed(*row)
        assert G.best(run.ends()) == cheapest(rows), rows
        cut, parts = rnd.randrange(len(rows) + 1), []
        for piece in (rows[:cut], rows[cut:]):
            runs = {s: G.Run(s) for s in range(len(G.STACKS.nodes))}
            for row in piece:
                for r in runs.values():
                    r.feed(*row)
            parts.append({s: r.ends() for s, r in runs.items()})
        assert G.best(G.joined(parts)) == cheapest(rows), rows


def test_few_stacks_and_a_small_frontier():
    assert len(G.STACKS.nodes) == 6
    run, rnd = G.Run(), random.Random(1)
    for _ in range(20000):
        run.feed(rnd.choice("suax"), rnd.choice(["", "", "t", "d"]))
        assert all(len(a) < 4 * G.FLUSH for _, a in run.frontier.values())


def brute_repair(rows):
    given = by_conversation(rows)
    out = []
    for c, turns in given.items():
        damaged = []
        for t, r, x in turns:
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            r, x = " " if r is None else r, " " if x is None else x
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            damaged += [(t, "user" if kind == 4 else r, x)] * (kind != 0 and 1 + (kind == 3))
        name = "-" if c is None else str(c)
        damaged.sort(key=lambda d: (d[0] is not None, d[0] or 0, d[1], hashlib.md5(f"{name}\0{d[1]}\0{d[2]}".encode()).digest()))
        run, seen, counts = G.Run(), set(), collections.Counter()
        for _, r, x in damaged:
            signs = re.findall(r"[^\x20\x09-\x0D]", x)
            fault = "b" if not signs else "d" if (r, x) in seen else "t" if signs[-1] not in ".!?" else ""
            seen.add((r, x))
            counts[fault] += 1
            run.feed(r[:1], fault)
        counts["i"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(damaged, damaged[1:]))
        cost, audit = G.best(run.ends())
        known = [t for t, _, _ in damaged if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        lines, at, lead = [], 0, (len(audit) - audit.count("D")) % 2
        for edit in audit:
            if edit != "D":
                role = damaged[at][1] if edit == "K" else ("user", "assistant")[(len(lines) - lead) % 2]
                lines.append(f"{role}:" + ("" if edit == "I" else damaged[at][2]))
            at += edit != "I"
        assert re.fullmatch(r"(s?(ua)+)?", "".join(line[0] for line in lines))
        out.append((c, gaps, counts["b"], counts["d"], counts["t"], counts["i"], cost, audit, sha("\n".join(lines))))
    return sorted(out, key=repr)


def test_repair_query_equals_brute_force(spark, tmp_path):
    rows = conversations() + [(3000 + k, 0, "user", "alone.", "", 0) for k in range(60)]  # some lose their only row
    got = queries.op13_structure_repair(spark, written(spark, tmp_path, rows))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == brute_repair(rows)
    assert (3000 + next(k for k in range(60) if zlib.crc32(f"{3000 + k}:0".encode()) % 20 == 0), *[0] * 6, "", sha("")) in got


def test_a_conversation_over_many_ranges(spark):
    """Every range starts in the middle of one conversation, and pieces are joined from any stack."""
    rnd = random.Random(5)
    rows = [(1, t, rnd.choice(["system", "user", "assistant"]), rnd.choice(["a.", "b", f"c{t}.", f"d{t}", " "])) for t in range(900)]
    rows += [(c, 0, "user", "x.") for c in (0, 2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = repair.numbered(df)
        got = {r["conv_id"]: r for r in repair.report(numbered).collect()}
        turns = repair.repaired(numbered, repair.report(numbered)).filter("conv_id = 1").orderBy("position").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    run, seen, illegal = G.Run(), set(), 0
    for _, _, r, x in rows[:900]:
        run.feed(r[0], "b" if x == " " else "d" if (r, x) in seen else "" if x[-1] == "." else "t")
        seen.add((r, x))
    illegal = sum(a[2][0] + b[2][0] not in ("su", "ua", "au") for a, b in zip(rows[:900], rows[1:900]))
    assert (got[1]["cost"], got[1]["audit"], got[1]["illegal"], got[1]["n"]) == (*G.best(run.ends()), illegal, 900)
    assert "".join(t["edit"] for t in turns) == got[1]["audit"].replace("D", "") and [t["position"] for t in turns] == list(range(len(turns)))


def test_empty_conversations(spark, tmp_path):
    path = written(spark, tmp_path, [], 1)
    assert queries.op11_conversation_trie(spark, path).count() == 0 == queries.op13_structure_repair(spark, path).count()
