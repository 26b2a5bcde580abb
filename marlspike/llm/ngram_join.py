"""N-gram Jaccard join: groups of documents with nearly equal sets of word n-grams.

1. Every whole text becomes its set of n-gram hashes. Equal sets collapse to a class, of
   which only one set is looked at from there on.
2. All n-grams are counted in up to ``2**ORDER_BITS`` hash buckets; (level of the bucket's count,
   hash) is the global order, rare n-grams first. Two different sets that link share
   ``l = shared_least()`` of their first ``size - ceil(t * size) + l`` members. Sets that
   agree in a band of minima of their hashes get one label before members are compared, so
   that a cluster of near copies counts once (any labelling gives the same groups). A
   member under at most ``FEW`` labels counts for each pair of them, and pairs that share l
   such members and whose sizes allow a link are candidates; a more frequent one makes all
   its labels of like size candidates, by stars. Components of that relation are joined apart.
3. Each candidate component is put in a prefix tree (``prefix_tree``), in which partial
   overlaps are shared and subtrees pruned by the remaining lengths. Only pairs that
   connect components come out, never all pairs of a group.
4. A candidate component over ``UNIT_GRAMS`` n-grams is joined in blocks. Pairs across
   blocks need a search only where a document isn't yet in the largest component
   found: those documents are dealt to groups, and each group is searched in every block,
   which makes the result exact. A task holds one block and one group at a time.

Words are runs of non-white-space with A-Z folded. A text with fewer words than n is one
n-gram, its whole sequence; a text without words, or null, has none and links with
nothing. Rows with the same doc_id count as one document with links of all its texts;
a null doc_id gets component null and doesn't connect others.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marlspike.llm import bytetext as B
from marlspike.llm.components import components
from marlspike.llm.prefix_tree import linked
from marlspike.llm.scratch import dropped, stored, thinned

#: A leading n-gram under at most so many labels counts pair by pair.
FEW = 16
#: Buckets of the global order, at least and at most: broadcast as levels of a byte, 32 MB at most.
LEAST_BITS, ORDER_BITS = 16, 25
_RANGES = 64
#: Minima of a set's hashes, one for each of 32 ranges of them; a band has so many.
BAND = 5
_BANDS = 32 // BAND
#: Pairs that a task adds up before it sends them.
_PAIRS = 1 << 20
#: N-grams of a block and of a group of probes, besides their last set; a task joins one of each at a time.
UNIT_GRAMS = 1 << 21

_EMPTY = np.uint64(2**64 - 1)


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The distinct n-gram hashes of each text, ascending."""
    starts, ends, text = B.word_spans(data, offsets, B.NON_SPACE)
    words = B.word_hashes(data, starts, ends, lower=True)
    heads = np.searchsorted(text, np.arange(len(offsets)))
    grams = B.gram_hashes(words, n)
    out = []
    for a, b in zip(heads.tolist(), heads[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:  # fewer words than n: one n-gram, told apart by its length
            out.append(B.gram_hashes(np.concatenate([words[a:b], [B.U(b - a)]]), b - a + 1))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def shared_least(percent: int) -> int:
    """Leading members that two different linked sets share at least: an overlap of o needs o / (o + 1) >= t."""
    return max(1, min(3, percent // max(1, 100 - percent)))


def bucket_of(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Place of each hash among ``buckets``, a power of 2."""
    return (grams >> B.U(65 - buckets.bit_length())).astype(np.int64)


def order_bits(docs: DataFrame) -> int:
    """A bucket for every 32 bytes of the input, as Spark estimates them."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return min(ORDER_BITS, max(LEAST_BITS, (size // 32).bit_length()))


def gram_order(docs: DataFrame, n: int) -> np.ndarray:
    """Level of each bucket: how often its hashes stand in sets of ``docs`` (doc_id, text), in a byte.

    A task sends its counts, 255 at most, as packed ranges of buckets; Spark adds up each
    range. A core runs two tasks at most, so that what they send doesn't grow with the input.
    Any order gives the same groups, a finer one fewer candidates.
    """
    buckets = 1 << order_bits(docs)
    width = buckets // _RANGES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.uint16)
        for batch in batches:
            for _, _, data, offsets in B.slices(batch.column(0)):
                np.add.at(total, bucket_of(np.concatenate(gram_sets(data, offsets, n)), buckets), 1)
            np.minimum(total, 255, out=total)
        for i in range(_RANGES):
            packed = zlib.compress(total[i * width:(i + 1) * width].astype(np.uint8).tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed], pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                total = sums.setdefault(part, np.zeros(width, dtype=np.uint32))
                total += np.frombuffer(zlib.decompress(counts.as_py()), dtype=np.uint8)
        for part, total in sums.items():
            packed = zlib.compress(_levels(total).tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    some = docs.select("text").coalesce(2 * docs.sparkSession.sparkContext.defaultParallelism)
    sums = stored(some.mapInArrow(run, schema).repartition("part").mapInArrow(add, schema), "order")
    out = np.zeros(buckets, dtype=np.uint8)
    for r in sums.collect():  # _RANGES rows
        out[r["part"] * width:(r["part"] + 1) * width] = np.frombuffer(zlib.decompress(r["counts"]), dtype=np.uint8)
    dropped(sums)
    return out


def _levels(counts: np.ndarray) -> np.ndarray:
    """Counts up to 32 as they are, larger ones by 16 levels a doubling."""
    return np.where(counts <= 32, counts, np.minimum(255, 16 * np.log2(np.maximum(counts, 32) / 32) + 32)).astype(np.uint8)


def _band_keys(minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, how many of each set) of the bands without an empty range; a row of ``minima`` is a set."""
    bands = minima[:, :_BANDS * BAND].reshape(len(minima), _BANDS, BAND)
    key = np.broadcast_to(np.arange(_BANDS, dtype=np.uint64), bands.shape[:2]).copy()
    for j in range(BAND):
        key = B.mix(key * B.U(0x9E3779B97F4A7C15) + bands[:, :, j])
    whole = (bands != _EMPTY).all(axis=2)
    return key[whole].view(np.int64), whole.sum(axis=1)


def described(docs: DataFrame, n: int, percent: int, order) -> DataFrame:
    """``doc_id, n_shingles, sig_a, sig_b, prefix, keys``: size, 128-bit signature, leading members and bands of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, least = order.value, shared_least(percent)
        for batch in batches:
            for first, last, data, offsets in B.slices(batch.column(1)):
                size, sig, prefixes = [], [], []
                minima = np.full((last - first, 32), _EMPTY)
                for s in gram_sets(data, offsets, n):
                    size.append(len(s))
                    mixed = B.mix(s + B.U(0x632BE59BD9B4E019))
                    sig.append((int(s.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mixed)) if len(s) else 0))
                    np.minimum.at(minima[len(size) - 1], (mixed >> B.U(59)).astype(np.int64), mixed)
                    take = len(s) - -(-percent * len(s) // 100) + least
                    prefixes.append(s[np.lexsort((s, rank[bucket_of(s, len(rank))]))[:take]])
                sig = np.array(sig, dtype=np.uint64).view(np.int64)
                ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(prefixes).view(np.int64)))
                keys, own = _band_keys(minima)
                keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(own)]), pa.int32()), pa.array(keys))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(size, pa.int64()), pa.array(sig[:, 0]), pa.array(sig[:, 1]), lists, keys],
                    ["doc_id", "n_shingles", "sig_a", "sig_b", "prefix", "keys"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, sig_a long, sig_b long, prefix array<bigint>, keys array<bigint>")


def _unit_links(units: DataFrame, n: int, percent: int, order) -> DataFrame:
    """``a, b, unit``: connecting links inside each unit of ``unit, probe, doc_id, text`` (probe null: all pairs, else those of a probe and another)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = order.value

        def joined(unit, ids, sets, probes):
            flags = None if not probes or probes[0] is None else np.array(probes, dtype=bool)
            pairs = linked(sets, lambda h: rank[bucket_of(h, len(rank))], percent, flags, flags is not None)
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i, _ in pairs], pa.int64()), pa.array([ids[j] for _, j in pairs], pa.int64()),
                 pa.array([unit] * len(pairs), pa.string())], ["a", "b", "unit"])

        unit, ids, sets, probes = None, [], [], []
        for batch in batches:
            units_, flags_, ids_ = (batch.column(k).to_pylist() for k in range(3))
            for first, _, data, offsets in B.slices(batch.column(3)):
                for k, s in enumerate(gram_sets(data, offsets, n), first):
                    if units_[k] != unit:
                        if len(ids) > 1:
                            yield joined(unit, ids, sets, probes)
                        unit, ids, sets, probes = units_[k], [], [], []
                    ids.append(ids_[k])
                    sets.append(s)
                    probes.append(flags_[k])
        if len(ids) > 1:
            yield joined(unit, ids, sets, probes)

    rows = units.select("unit", "probe", "doc_id", "text").repartition("unit").sortWithinPartitions("unit")
    return rows.mapInArrow(run, "a long, b long, unit string")


def _labelled(sets: DataFrame, classes: DataFrame, sig: list[str]) -> DataFrame:
    """``classes`` with ``label``: the smallest representative that shares a band with the class's own, or that itself."""
    keys = stored(sets.join(classes, sig).filter("doc_id = rep").select("rep", F.explode("keys").alias("key")).distinct(), "keys")
    firsts = keys.groupBy("key").agg(F.min("rep").alias("label"), F.max("rep").alias("last")).filter("label < last").select("key", "label")
    firsts = stored(firsts, "firsts")  # so that the join can be split at a hot key
    labels = keys.join(firsts, "key").groupBy("rep").agg(F.min("label").alias("label"))
    out = stored(classes.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "labelled")
    dropped(keys, firsts)
    return out


def _pairs_of(grams: np.ndarray, labels: np.ndarray, sizes: np.ndarray, least: int, percent: int) -> list[np.ndarray]:
    """Rows (a, b, n) for whole n-grams of ``grams, labels, sizes``, sorted by gram and label: the pairs of a rare one, the stars of a frequent one."""
    fresh = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]) | (labels[1:] != labels[:-1])]))
    low, high = np.minimum.reduceat(sizes, fresh), np.maximum.reduceat(sizes, fresh)
    gram, label = grams[fresh], labels[fresh]
    heads = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    met = np.diff(np.concatenate([heads, [len(gram)]]))
    out = []
    for k in range(2, FEW + 1):
        at = heads[met == k]
        for i in range(k if len(at) else 0):
            for j in range(i + 1, k):
                x, y = at + i, at + j
                fit = (100 * high[x] >= percent * low[y]) & (100 * high[y] >= percent * low[x])
                out.append(np.stack([label[x[fit]], label[y[fit]], np.ones(int(fit.sum()), np.int64)]))
    often = np.repeat(met > FEW, np.diff(np.concatenate([fresh[heads], [len(grams)]])))
    if often.any():
        g, x, size = grams[often], labels[often], sizes[often]
        # sets that link lie in the same or in neighbouring bands of size
        band = np.floor(np.log(size) / math.log(100 / percent)).astype(np.int64) if percent < 100 else size
        g, x, band = np.concatenate([g, g]), np.concatenate([x, x]), np.concatenate([band, band + 1])
        order = np.lexsort((x, band, g))
        g, x, band = g[order], x[order], band[order]
        first = np.concatenate([[True], (g[1:] != g[:-1]) | (band[1:] != band[:-1])])
        hub = x[np.maximum.accumulate(np.where(first, np.arange(len(x)), 0))]
        out.append(np.stack([hub, x, np.full(len(x), least)])[:, hub != x])
    return out


def _added(parts: list[np.ndarray], least: int) -> np.ndarray:
    """Rows (a, b, n) of ``parts`` with equal pairs added up; no n needs to be over ``least``."""
    a, b, n = np.concatenate([np.zeros((3, 0), np.int64), *parts], axis=1)
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    fresh = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[:len(a)])
    return np.stack([a[fresh], b[fresh], np.minimum(np.add.reduceat(n, fresh), least) if len(a) else n])


def _candidate_pairs(sets: DataFrame, least: int, percent: int) -> DataFrame:
    """``a, b``: edges between labels whose components hold every pair of ``sets`` (label, n_shingles, prefix) that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of the last n-gram so far
        sums, n = [], 0

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _added(sums, least)], ["a", "b", "n"])

        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)])
            if not rows.shape[1]:
                continue
            cut = int(np.searchsorted(rows[0], rows[0, -1]))
            if cut or held and held[-1][0, -1] != rows[0, 0]:
                new = _pairs_of(*np.concatenate([*held, rows[:, :cut]], axis=1), least, percent)
                held = []
                sums += new
                n += sum(x.shape[1] for x in new)
            held.append(rows[:, cut:])
            if n > _PAIRS:
                one = _added(sums, least)
                if 2 * one.shape[1] > _PAIRS:
                    yield sent()
                    one = one[:, :0]
                sums, n = [one], one.shape[1]
        if held:
            sums += _pairs_of(*np.concatenate(held, axis=1), least, percent)
        if sums:
            yield sent()

    members = sets.select(F.explode("prefix").alias("gram"), "label", "n_shingles")
    members = members.repartition("gram").sortWithinPartitions("gram", "label")
    pairs = members.mapInArrow(run, "a long, b long, n long")
    return pairs.groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("a", "b")


def near_groups(docs: DataFrame, n: int = 5, percent: int = 80, unit_grams: int = UNIT_GRAMS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    order = docs.sparkSession.sparkContext.broadcast(gram_order(docs, n))
    sets = stored(described(docs, n, percent, order), "sets")
    some = sets.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    sig = ["n_shingles", "sig_a", "sig_b"]
    classes = stored(some.groupBy(*sig).agg(F.min("doc_id").alias("rep")), "classes")
    rows = stored(sets.join(classes, sig, "left").select("doc_id", "n_shingles", "rep"), "rows")
    labelled = _labelled(some, classes, sig)

    # one set of each class
    own = some.select("doc_id", *sig, "prefix").join(labelled, sig).filter("doc_id = rep")
    pairs = stored(_candidate_pairs(own, shared_least(percent), percent), "pairs")
    dropped(sets, classes)
    joined = components(pairs, "a", "b").toDF("label", "component")
    candidates = stored(labelled.join(joined, "label", "left").select(F.coalesce("component", "label").alias("component"), F.col("rep").alias("doc_id"), "n_shingles"), "candidates")
    dropped(pairs, labelled)

    candidates = candidates.groupBy("component", "doc_id").agg(F.sum("n_shingles").alias("n_shingles"))
    # a component of one document needs no search
    several = stored(candidates.groupBy("component").count().filter("count > 1").select("component"), "several")
    placed = stored(_dealt(candidates.join(several, "component"), "block", unit_grams), "placed")
    unit = F.concat_ws(":", "component", "block")
    rep_texts = thinned(docs, "doc_id", placed).join(placed, "doc_id")
    links = stored(_unit_links(rep_texts.select(unit.alias("unit"), F.lit(None).cast("boolean").alias("probe"), "doc_id", "text"), n, percent, order), "links")

    split = stored(placed.filter("n_parts > 1").drop("n_parts"), "split")
    if split.take(1):
        links = links.unionByName(_across_blocks(docs, split, links, n, percent, order, unit_grams))
    # the texts of one document
    known = rows.filter(F.col("doc_id").isNotNull() & F.col("rep").isNotNull())
    own = known.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b").select("doc_id", "a")
    same = known.join(own, "doc_id").select("a", F.col("rep").alias("b"))
    found = stored(components(links.select("a", "b").unionByName(same), "a", "b"), "found")

    out = rows.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    # rows that share an id share their component
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))


def _dealt(rows: DataFrame, name: str, unit_grams: int) -> DataFrame:
    """``rows`` (component, doc_id, n_shingles) with ``n_parts`` and the part of its component, ``name``.

    Documents are dealt by hash; a part that got more than ``unit_grams`` n-grams is cut in
    the order of ids, so that none holds ``unit_grams`` before its last document.
    """
    parts = stored(rows.groupBy("component").agg(F.ceil(F.sum("n_shingles") / unit_grams).alias("n_parts")), "parts")
    rows = stored(rows.join(parts, "component").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("n_parts"))), "dealt")
    before = F.sum("n_shingles").over(Window.partitionBy("component", "part").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_shingles")
    cut = rows.filter("n_parts > 1").withColumn(name, F.concat_ws(".", "part", F.floor(before / unit_grams)))
    return rows.filter("n_parts = 1").withColumn(name, F.lit("0")).unionByName(cut).drop("part")


def _across_blocks(docs: DataFrame, split: DataFrame, links: DataFrame, n: int, percent: int, order, unit_grams: int) -> DataFrame:
    """Links between blocks of one candidate component."""

    def labelled(edges: DataFrame, label: str) -> DataFrame:
        found = components(edges, "a", "b").withColumnRenamed("node", "doc_id").withColumnRenamed("component", "root")
        return stored(split.join(found, "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id")), label)

    def largest(rows: DataFrame, *by: str) -> DataFrame:
        return rows.groupBy(*by, "root").count().groupBy(*by).agg(F.max_by("root", F.struct("count", -F.col("root"))).alias("root"))

    # one document of the largest component of each block
    hubs = largest(labelled(links, "local"), "component", "block").select("component", F.col("root").alias("doc_id"))
    hubs = _dealt(hubs.join(split.select("doc_id", "n_shingles"), "doc_id"), "group", unit_grams).select(
        F.concat_ws(":", F.lit("hub"), "component", "group").alias("unit"), F.lit(None).cast("boolean").alias("probe"), "doc_id")
    hubs = stored(hubs, "hubs")
    between = stored(_unit_links(hubs.join(thinned(docs, "doc_id", hubs), "doc_id"), n, percent, order), "hub_links")
    rows = labelled(links.unionByName(between), "joined")
    main = stored(largest(rows, "component").withColumnRenamed("root", "main"), "main")
    apart = rows.join(main, "component").filter("root != main").select("component", "doc_id", "n_shingles", F.col("block").alias("home"))
    apart = stored(_dealt(apart, "group", unit_grams), "apart")
    # every group meets every block; inside its own block a document has been searched
    unit = F.concat_ws(":", "component", "block", "group")
    blocks = stored(rows.select("component", "block").distinct(), "blocks")
    groups = stored(apart.select("component", "group").distinct(), "groups")
    sought = apart.join(blocks, "component").filter("block != home").select(unit.alias("unit"), F.lit(True).alias("probe"), "doc_id")
    held = rows.join(groups, "component").select(unit.alias("unit"), F.lit(False).alias("probe"), "doc_id")
    units = sought.unionByName(held).join(thinned(docs, "doc_id", rows), "doc_id")
    return stored(between.unionByName(_unit_links(units, n, percent, order)), "across")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Rows without an id stay; rows that share one stay together."""
    groups = near_groups(docs, n, percent)
    gone = groups.filter(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
