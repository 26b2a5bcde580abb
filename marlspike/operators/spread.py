"""Keep small single-file inputs from running in one task; bring rows together in small partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Repartition only when the scan has too few splits to occupy the cores.

    Large inputs have far more splits than cores and pass through unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < 2 * cores else df


#: Partitions of gathered rows for every split of the scan, so that tasks stay small.
PER_SPLIT = 8


def small_parts(df: DataFrame, per_split: int = PER_SPLIT) -> int:
    """Partitions for the rows of a scan, several for each of its splits."""
    return max(df.sparkSession.sparkContext.defaultParallelism, per_split * df.rdd.getNumPartitions())


def gathered(df: DataFrame, *keys: str, per_split: int = PER_SPLIT) -> DataFrame:
    """Rows with equal ``keys`` in one partition; later grouping by these and more keys needs no other shuffle."""
    return df.repartition(small_parts(df, per_split), *keys)
