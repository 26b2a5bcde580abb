"""Windows over one long ordered series, without a single-task sort.

``Window.orderBy`` with no partition key sends the whole series to one task.
Here the series is range-partitioned, numbered, and cut into blocks of
consecutive rows. Each block also receives the few neighbouring rows its
windows look at (the halo), so every block is evaluated on its own and the rows
a block owns get exactly the values of the global window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from marlspike.session import cut_lineage

BLOCK_ROWS = 4096

# monotonically_increasing_id keeps the row position within a partition in its low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def ordered_parts(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Range-partitioned, sorted copy with ``_part`` and ``_pos`` (position within the part).

    Range boundaries come from a sample, so the parts are checkpointed before
    anything reads them twice. A tie-break in ``order`` lets one frequent sort
    value spread over several parts.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)))
    )
    return cut_lineage(parts)


def _part_offsets(parts: DataFrame, amount: Column) -> DataFrame:
    """Sum of ``amount`` over all earlier parts: one row per shuffle partition."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.groupBy("_part").agg(amount.alias("_amount"))
        .select("_part", F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_offset"))
    )


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "rn") -> DataFrame:
    """Zero-based row numbers in ``order``, which must be unique."""
    parts = ordered_parts(df, order)
    offsets = _part_offsets(parts, F.count(F.lit(1)))
    return (
        parts.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_pos") + F.col("_offset"))
        .drop("_part", "_pos", "_offset")
    )


def running_sum(df: DataFrame, order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows up to and including the current one."""
    parts = ordered_parts(df, order)
    offsets = _part_offsets(parts, F.sum(value))
    within = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return (
        parts.withColumn("_within", F.sum(value).over(within))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_within") + F.col("_offset"))
        .drop("_part", "_pos", "_offset", "_within")
    )


def over_blocks(
    numbered: DataFrame,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    before: int,
    after: int = 0,
    rn: str = "rn",
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Apply ``compute(rows, window)`` to blocks with a halo and keep the blocks' own rows.

    ``before`` and ``after`` are the furthest rows any result depends on,
    counted through nested windows.
    """
    first = F.greatest(F.floor((F.col(rn) - after) / block), F.lit(0).cast("bigint"))
    last = F.floor((F.col(rn) + before) / block)
    halo = numbered.withColumn("_block", F.explode(F.sequence(first, last))).withColumn(
        "_home", F.floor(F.col(rn) / block) == F.col("_block")
    )
    done = compute(halo, Window.partitionBy("_block").orderBy(rn))
    return done.filter("_home").drop("_block", "_home")


def ordered_window(
    df: DataFrame, order: Sequence[str | Column],
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    before: int, after: int = 0, block: int = BLOCK_ROWS,
) -> DataFrame:
    """Number the rows, then evaluate ``compute`` over blocks."""
    return over_blocks(number_rows(df, order), compute, before, after, block=block)


def chronological_split(numbered: DataFrame, train: float = 0.8, rn: str = "rn") -> DataFrame:
    """Adds ``split``: the first ⌊train·n⌋ rows are ``train``, the others ``test``."""
    n = numbered.agg(F.count(F.lit(1))).scalar()
    cut = F.floor(n * train)
    return numbered.withColumn("split", F.when(F.col(rn) < cut, "train").otherwise("test"))
