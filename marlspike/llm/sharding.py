"""Sharding by sampled splitters: ranges of a key with nearly equal bytes.

1. Records are stored once with a key: the digest of their group, their order in it, and
   a unique number, so that no two keys are equal and any range can be cut.
2. A sample of keys is drawn, each record in proportion to its size; quantiles of the
   sample are the splitters of some ``RANGES`` ranges a shard. Splitters stand at group
   borders. The bytes of every range are then counted.
3. A range of over twice its share is overfull. It gets splitters of its own, from a denser
   sample of its records, until none is overfull; a range that one group fills alone is
   cut inside the group.
4. Records are range-partitioned and numbered within their range. The exact counts of the
   ranges give every record its place in bytes and in rows over the whole table.

Law ``bytes``: a unit (a record, or a whole group that is no larger than the largest
record) goes to the shard in which its middle byte lies, shards being equal shares of all
bytes. So a shard departs from its share by at most the size of the largest record, small
groups stay together, and a group of any size is dealt over as many shards as it fills.

Only splitters and one count a range reach the driver; their number is total bytes over
``RANGE_BYTES``, or ``RANGES`` a shard. Null groups and orders come first. Repeated rows
each get a place. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marlspike.llm.scratch import stored

LAW = "bytes"
RANGES = 64
RANGE_BYTES = 1 << 28
#: Sampled keys a range.
SAMPLES = 16
GROUP_BYTES, KEY_BYTES = 16, 32
SALT = 11


def _eight_bytes(number: Column) -> Column:
    """Eight bytes that sort like the signed number; nulls first."""
    flipped = F.coalesce(number.cast("long"), F.lit(-(1 << 63))).bitwiseXOR(F.lit(-(1 << 63)))
    return F.unhex(F.lpad(F.hex(flipped), 16, "0"))


def keyed(records: DataFrame, group: Column, order: Column, size: Column) -> DataFrame:
    """``row`` (all columns), ``key``, ``size``; stored. ``group`` is any string or binary, ``order`` a number.

    A size below 1 or null counts as 1.
    """
    digest = F.unhex(F.md5(F.coalesce(group.cast("binary"), F.lit(b""))))
    key = F.concat(digest, _eight_bytes(order), _eight_bytes(F.monotonically_increasing_id()))
    return stored(records.select(F.struct(*[records[c] for c in records.columns]).alias("row"), key.alias("key"),
        F.greatest(size.cast("long"), F.lit(1).cast("long")).alias("size")), "records")


def _array(keys: pd.Series, n: int = KEY_BYTES) -> np.ndarray:
    return np.array([bytes(k) for k in keys], f"S{n}")


def _ranges_of(spark: SparkSession, splitters: np.ndarray) -> Column:
    """The number of the range that a key lies in."""
    shared = spark.sparkContext.broadcast(splitters)

    @F.pandas_udf("int")
    def at(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, _array(keys), side="right").astype(np.int32))

    return at("key")


def _sample(keys: DataFrame, per_byte: Column, salt: int) -> np.ndarray:
    """Keys, each as often as its size times ``per_byte`` on average."""
    uniform = F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(1 << 40)) / float(1 << 40)
    drawn = keys.withColumn("n", F.floor(F.col("size") * per_byte + uniform)).filter("n > 0").select("key", "n").toPandas()
    out = np.repeat(_array(drawn["key"]), drawn["n"].to_numpy(np.int64))
    out.sort()
    return out


def _group_starts(keys: np.ndarray) -> np.ndarray:
    """The least key of each key's group."""
    return keys.astype(f"S{GROUP_BYTES}").astype(f"S{KEY_BYTES}")


def _counted(spark: SparkSession, keys: DataFrame, splitters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and rows of each range, and whether one group fills it alone."""
    group = F.substring("key", 1, GROUP_BYTES)
    found = keys.groupBy(_ranges_of(spark, splitters).alias("range")).agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"), (F.min(group) == F.max(group)).alias("alone")).toPandas()
    n, at = len(splitters) + 1, found["range"].to_numpy(np.int64)
    size, rows, alone = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
    size[at], rows[at], alone[at] = found["bytes"], found["rows"], found["alone"]
    return size, rows, alone


def _flagged(spark: SparkSession, cuts: np.ndarray, flags: np.ndarray) -> Column:
    """Whether a key lies in a range with a flag."""
    shared = spark.sparkContext.broadcast((cuts, flags))

    @F.pandas_udf("boolean")
    def at(keys: pd.Series) -> pd.Series:
        return pd.Series(shared.value[1][np.searchsorted(shared.value[0], _array(keys), side="right")])

    return at("key")


def splitters(spark: SparkSession, keys: DataFrame, total: int, largest: int, n_shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Splitters without overfull ranges, and bytes and rows of the ranges between them."""
    share = max(total / max(RANGES * n_shards, total // RANGE_BYTES), 1.0)
    density, salt = SAMPLES / share, SALT
    cuts = np.unique(_group_starts(_sample(keys, F.lit(density), salt)[SAMPLES::SAMPLES]))
    while True:
        size, rows, alone = _counted(spark, keys, cuts)
        overfull = (size > 2 * share) & (rows > 1) & ~(alone & (size <= largest))
        if not overfull.any() or density > 2 * SAMPLES:  # every record has been drawn often
            return cuts, size, rows
        density, salt = 2 * density, salt + 1
        held = keys.filter(_flagged(spark, cuts, overfull))
        group = F.substring("key", 1, GROUP_BYTES)
        big = held.groupBy(group.alias("key")).agg(F.sum("size").alias("size")).filter(F.col("size") > max(largest, share)).toPandas()
        big = np.concatenate([_array(big["key"], GROUP_BYTES), _split_groups(cuts)])
        dense = _sample(held, F.lit(density), salt)
        starts = _group_starts(dense)
        inside = np.isin(dense.astype(f"S{GROUP_BYTES}"), big) & (np.arange(len(dense)) % SAMPLES == 0)
        changes = np.flatnonzero(starts[1:] != starts[:-1]) + 1
        wanted = np.unique(np.concatenate([starts[changes[np.diff(changes // SAMPLES, prepend=-1) > 0]], starts[::SAMPLES], dense[inside]]))
        cuts = np.unique(np.concatenate([cuts, wanted]))


def _split_groups(cuts: np.ndarray) -> np.ndarray:
    """Groups that a splitter cuts."""
    return np.unique(cuts[cuts != _group_starts(cuts)].astype(f"S{GROUP_BYTES}"))


def _placed(rows: DataFrame, spark: SparkSession, cuts: np.ndarray, sizes: np.ndarray, total: int, largest: int, n_shards: int) -> DataFrame:
    """Adds ``range``, ``nth`` (place in the range) and ``shard``; every range has to be there whole or not at all."""
    shared = spark.sparkContext.broadcast((np.cumsum(sizes) - sizes, _split_groups(cuts)))

    @F.pandas_udf("long")
    def first_byte(ranges: pd.Series) -> pd.Series:
        return pd.Series(shared.value[0][ranges.to_numpy()])

    @F.pandas_udf("boolean")
    def is_cut(groups: pd.Series) -> pd.Series:
        return pd.Series(np.isin(_array(groups, GROUP_BYTES), shared.value[1]))

    ranged = rows.withColumns({"range": _ranges_of(spark, cuts), "group": F.substring("key", 1, GROUP_BYTES)})
    along = Window.partitionBy("range").orderBy("group", "key")
    whole = Window.partitionBy("range", "group").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    done = ranged.withColumns({"nth": F.row_number().over(along).cast("long") - 1, "end": F.sum("size").over(along)})
    done = done.withColumns({"group_size": F.sum("size").over(whole), "group_end": F.max("end").over(whole)})
    by_record = (F.col("group_size") > largest) | is_cut("group")
    middle = F.when(by_record, 2 * F.col("end") - F.col("size")).otherwise(2 * F.col("group_end") - F.col("group_size"))
    done = done.withColumn("middle", middle + 2 * first_byte("range"))
    return done.withColumn("shard", F.expr(f"cast(least({n_shards - 1}, middle * {n_shards} div {2 * total}) as int)")).select(
        *rows.columns, "range", "nth", "shard")


def sharded(records: DataFrame, n_shards: int, group: Column, order: Column, size: Column) -> DataFrame:
    """``row, size, shard, slot``: every record with its shard and its place there, gapless from 0."""
    spark = records.sparkSession
    rows = keyed(records, group, order, size)
    keys = rows.select("key", "size")
    total, largest = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    if total == 0:
        return rows.select("row", "size", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    cuts, sizes, counts = splitters(spark, keys, total, largest, n_shards)
    place = lambda of: _placed(of, spark, cuts, sizes, total, largest, n_shards)
    ends, first_row = np.cumsum(sizes), np.cumsum(counts) - counts
    # a shard's first record lies within one record's size of the shard's equal share
    near = np.zeros(len(sizes), bool)
    for share in (total * k / n_shards for k in range(1, n_shards)):
        near |= (ends - sizes <= share + largest) & (ends >= share - largest)
    found = place(keys.filter(_flagged(spark, cuts, near))).groupBy("shard", "range").agg(F.min("nth").alias("nth")).toPandas()
    start = np.zeros(n_shards, np.int64)
    for k in range(1, n_shards):
        mine = found[found["shard"] == k]
        start[k] = (first_row[mine["range"].to_numpy()] + mine["nth"].to_numpy()).min(initial=int(counts.sum()))
    shared = spark.sparkContext.broadcast((first_row, start))

    @F.pandas_udf("long")
    def offset(ranges: pd.Series, shards: pd.Series) -> pd.Series:
        return pd.Series(shared.value[0][ranges.to_numpy()] - shared.value[1][shards.to_numpy()])

    return place(rows).select("row", "size", "shard", (F.col("nth") + offset("range", "shard")).alias("slot"))


def write_shards(done: DataFrame, path: str) -> None:
    """A folder a shard, records in order of their slots within each file."""
    done.repartition("shard", F.floor(F.col("slot") / (1 << 20))).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
