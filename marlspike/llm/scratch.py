"""Intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marlspike.session import delete, scratch_path


#: Shuffle files of a write go when it has ended, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path, conf = scratch_path(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` returned; nothing that is still to run may read them."""
    for x in tables:
        delete(x.sparkSession, x.scratch)


#: Slots of the filter that thins out a table before a join.
SLOTS = 1 << 20


def thinned(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose key may be among ``keys`` (a column of the same name), without shuffling the others.

    Keys are hashed to ``SLOTS`` slots; only slots are broadcast, which bounds what is sent.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS))
    return rows.withColumn("__slot", slot).join(
        F.broadcast(keys.select(slot.alias("__slot")).distinct()), "__slot", "left_semi").drop("__slot")


def ordered(df: DataFrame, order: list, label: str) -> DataFrame:
    """``df`` sorted by ``order`` over range partitions and stored, with ``rn``, the row's place from 0.

    Rows that tie in ``order`` must be interchangeable; a last random key spreads them over partitions.
    """
    salted = df.withColumn("__salt", F.xxhash64(F.monotonically_increasing_id()))
    at = F.monotonically_increasing_id()  # the partition's number above 33 bits of the place in it
    parts = stored(salted.repartitionByRange(*order, "__salt").sortWithinPartitions(*order, "__salt").drop("__salt").withColumns(
        {"__part": F.shiftright(at, 33), "__at": at.bitwiseAND(F.lit((1 << 33) - 1))}), label)
    sizes = parts.groupBy("__part").agg(F.count("*").alias("n"))  # a row per partition
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    return parts.join(F.broadcast(first), "__part").withColumn("rn", F.col("__first") + F.col("__at")).drop("__part", "__at", "__first")
