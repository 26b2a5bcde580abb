"""Embedding near-dedup by collision counting on one-dimensional projections.

1. Equal vectors of one label collapse to one row with its number of copies.
2. ``TABLES`` hash tables per label: each sorts the vectors by ``bits`` random
   projections cut at their sign. The number of bits grows with the label's count, so
   that a bucket holds some ``BUCKET`` vectors; the number of tables follows from it and
   ``RECALL``. A bucket over ``TILE`` vectors is compared in pairs of tiles.
3. In a bucket every vector is a query: on each of ``PROJECTIONS`` further projections
   the vectors are sorted, and those in the window centred on the query's value collide
   with it. Pairs with at least ``least_collisions()`` collisions, a count that a pair at
   the threshold reaches with probability ``COUNT_RECALL``, are verified by their cosine
   in double precision. A pair counts in the first table that holds both.
4. Buckets give counts per vector and only the links that connect components.

Vectors that are null, zero, or hold null or non-finite components, and vectors without
label, link with nothing. Vectors of different lengths don't link. Every row gives one
row. Rows that repeat a ``vec_id`` are other vectors to each other: each counts. A row
without ``vec_id`` links like any other, but cannot name its component; a component
without any id has a null name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marlspike.llm.components import components
from marlspike.llm.prefix_tree import Union
from marlspike.llm.scratch import stored

THRESHOLD = 0.93
#: Chance that a pair at the threshold shares a bucket, and that it reaches the collision count.
RECALL, COUNT_RECALL = 0.995, 0.999
PROJECTIONS = 48
BUCKET, TILE = 256, 1024
MOST_BITS = 40
SEED = 7


def table_count(bits: int, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Tables of ``bits`` signs in which a pair at the threshold meets with chance ``recall``."""
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet))) if meet < 1 else 1


def window(threshold: float = THRESHOLD) -> float:
    """Half the window's width: a pair at the threshold collides on a projection with chance 0.95."""
    return 1.96 * math.sqrt(2 - 2 * threshold)


def least_collisions(projections: int = PROJECTIONS, recall: float = COUNT_RECALL) -> int:
    """Largest count that a pair at the threshold reaches with chance ``recall`` (binomial, 0.95 each)."""
    below = 0.0
    for c in range(projections + 1):
        below += math.comb(projections, c) * 0.95**c * 0.05 ** (projections - c)
        if below > 1 - recall:
            return c
    return projections


def directions(seed: int, dims: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, seed, dims])).standard_normal((dims, n))


def keys_of(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(vector, table) -> bucket number."""
    if bits == 0:
        return np.zeros((len(unit), tables), dtype=np.int64)
    signs = (unit @ directions(1, unit.shape[1], bits * tables) > 0).reshape(len(unit), tables, bits)
    return (signs.astype(np.int64) << np.arange(bits)).sum(axis=2)


def collisions(left: np.ndarray, right: np.ndarray, half: float) -> np.ndarray:
    """Number of projections (columns) on which each right value lies in the window of each left value."""
    count = np.zeros((len(left), len(right) + 1), dtype=np.int16)
    for j in range(left.shape[1]):
        order = np.argsort(right[:, j], kind="stable")
        values = right[order, j]
        lo, hi = np.searchsorted(values, left[:, j] - half, "left"), np.searchsorted(values, left[:, j] + half, "right")
        inside = np.zeros((len(left), len(right) + 1), dtype=np.int8)  # +1 where a window opens, -1 where it ends
        rows = np.arange(len(left))
        np.add.at(inside, (rows, lo), 1)
        np.add.at(inside, (rows, hi), -1)
        count[:, order] += np.cumsum(inside[:, :-1], axis=1, dtype=np.int8)
    return count[:, :-1]


def _unit(vector: list | None, label: object) -> list[float] | None:
    """The vector at length 1; null if it cannot link."""
    if vector is None or label is None or not vector or any(x is None for x in vector):
        return None
    x = np.array(vector, dtype=np.float64)
    top = np.abs(x).max()
    if not np.isfinite(x).all() or top == 0:
        return None
    x = x / top  # so that squares neither vanish nor overflow
    return (x / np.sqrt(x @ x)).tolist()


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row, with its unit vector."""
    for batch in batches:
        vectors, labels = (batch.column(k).to_pylist() for k in (1, 2))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([None if x is None else str(x) for x in labels], pa.string()),
             pa.array([_unit(v, x) for v, x in zip(vectors, labels)], pa.list_(pa.float64()))], ["vec_id", "label", "unit"])


def _table_rows(classes: DataFrame) -> DataFrame:
    """One row per class and table: ``bucket, tile`` columns with the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.asarray(batch.column(4))
            dims = np.array([len(u) for u in batch.column(2)])
            for b, d in sorted(set(zip(bits.tolist(), dims.tolist()))):
                rows = np.flatnonzero((bits == b) & (dims == d))
                for first in range(0, len(rows), 2048):
                    at = rows[first:first + 2048]
                    part = batch.take(pa.array(at))
                    unit = np.array(part.column(2).to_pylist()).reshape(len(at), d)
                    tables = table_count(b)
                    keys = keys_of(unit, b, tables)
                    for t in range(tables):
                        yield pa.RecordBatch.from_arrays(
                            [*part.columns, pa.array(np.full(len(at), d)), pa.array(np.full(len(at), t)), pa.array(keys[:, t])],
                            ["cls", "label", "unit", "copies", "bits", "dims", "tab", "bucket"])

    return classes.select("cls", "label", "unit", "copies", "bits").mapInArrow(
        run, "cls long, label string, unit array<double>, copies long, bits long, dims long, tab long, bucket long")


def _compare(rows: DataFrame, threshold: float) -> DataFrame:
    """Links inside each unit: ``a, b, n``. A row (a, null, n) adds n links to a; (a, b, null) connects."""
    half, least = window(threshold), least_collisions()

    def run(table: pa.Table) -> pa.Table:
        bits, tab, dims = (table[c][0].as_py() for c in ("bits", "tab", "dims"))
        cls, copies = table["cls"].to_numpy(), table["copies"].to_numpy()
        side = table["side"].to_numpy()
        unit = np.array(table["unit"].to_pylist()).reshape(len(cls), dims)
        keys = keys_of(unit, bits, table_count(bits))
        shadow = unit @ directions(2, dims, PROJECTIONS)
        left, right = np.flatnonzero(side <= 1), np.flatnonzero(side != 1)  # side 0: one tile against itself
        links, union, joins = np.zeros(len(cls), dtype=np.int64), Union(len(cls)), []
        for first in range(0, len(left), 256):
            some = left[first:first + 256]
            i, j = np.nonzero(collisions(shadow[some], shadow[right], half) >= least)
            i, j = some[i], right[j]
            if (side == 0).all():
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            near = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            i, j = i[near], j[near]
            fresh = ~(keys[i, :tab] == keys[j, :tab]).any(axis=1)  # else an earlier table has counted it
            np.add.at(links, i[fresh], copies[j[fresh]])
            np.add.at(links, j[fresh], copies[i[fresh]])
            for x, y in zip(i[fresh].tolist(), j[fresh].tolist()):
                if union.parts == 1:
                    break
                if union.join(x, y):
                    joins.append((cls[x], cls[y]))
        hit = np.flatnonzero(links)
        n = len(hit)
        return pa.table({
            "a": pa.array([*cls[hit].tolist(), *(int(x) for x, _ in joins)], pa.int64()),
            "b": pa.array([None] * n + [int(y) for _, y in joins], pa.int64()),
            "n": pa.array([*links[hit].tolist(), *[None] * len(joins)], pa.int64())})

    return rows.groupBy("label", "dims", "tab", "bucket", "first", "second").applyInArrow(run, "a long, b long, n long")


def links(vectors: DataFrame, threshold: float = THRESHOLD, bucket: int = BUCKET, tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (vec_id, embedding, label)."""
    vectors = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("embedding"), vectors["label"].alias("label"))
    digest = F.when(F.col("unit").isNotNull(), F.struct(F.xxhash64("unit").alias("a"), F.xxhash64(F.lit(SEED), "unit").alias("b")))
    every = stored(vectors.mapInArrow(_units, "vec_id long, label string, unit array<double>").withColumn("digest", digest), "vectors")
    usable = every.filter("unit IS NOT NULL")
    # ids may be null or stand on several vectors, so classes are numbered
    classes = usable.groupBy("label", "digest").agg(F.min("vec_id").alias("name"), F.count("*").alias("copies"), F.first("unit").alias("unit")).withColumn(
        "cls", F.monotonically_increasing_id())
    sizes = usable.groupBy("label").agg(F.count("*").alias("rows"))
    bits = F.least(F.greatest(F.floor(F.log2(F.col("rows") / bucket)) + 1, F.lit(0)), F.lit(MOST_BITS)).cast("long")
    classes = stored(stored(classes, "numbered").join(stored(sizes, "sizes"), "label").withColumn("bits", bits), "classes")

    rows = stored(_table_rows(classes), "tables")
    cell = ["label", "dims", "tab", "bucket"]
    tiles = stored(rows.groupBy(*cell).agg(F.ceil(F.count("*") / tile).alias("tiles")), "tiles")
    rows = rows.join(tiles, cell).withColumn("tile", F.pmod(F.xxhash64("cls"), F.col("tiles")))
    # a tile meets itself once (side 0) and every other tile once (side 1 before side 2)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    rows = rows.withColumn("first", F.least("tile", "other")).withColumn("second", F.greatest("tile", "other")).withColumn(
        "side", F.when(F.col("tile") == F.col("other"), 0).when(F.col("tile") < F.col("other"), 1).otherwise(2))
    found = stored(_compare(rows, threshold), "found")

    counts = found.filter(F.col("b").isNull()).groupBy("a").agg(F.sum("n").alias("n"))
    groups = components(found.filter(F.col("b").isNotNull()), "a", "b")
    about = stored(classes.join(counts, classes["cls"] == counts["a"], "left").join(groups, classes["cls"] == groups["node"], "left").select(
        "label", "digest", "name", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "cls").alias("component")), "about")
    names = stored(about.groupBy("component").agg(F.min("name").alias("component_id")), "names")
    about = about.join(names, "component").select("label", "digest", "n_links", "component_id")
    linked = every.select("vec_id", "label", "digest").join(about, ["label", "digest"], "left")
    return linked.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
