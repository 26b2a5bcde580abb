"""Fields of a block record as expressions over its hexadecimal text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.functions.hashing import double_sha256, little_endian, reverse_bytes

# Header length in bytes, and the longest transaction-count field.
HEADER_BYTES = 80
VARINT_BYTES = 9


def _bytes(hex_text: Column, start: int, length: int) -> Column:
    return F.substring(hex_text, 2 * start + 1, 2 * length)


def varint(hex_text: Column, start: int) -> Column:
    """Variable-length unsigned integer at a byte offset; 0 when it is cut off."""
    first = F.lower(_bytes(hex_text, start, 1))

    def wide(width):
        field = _bytes(hex_text, start + 1, width)
        whole = F.length(field) == 2 * width
        value = F.conv(reverse_bytes(field, width), 16, 10).try_cast("bigint")
        return F.when(whole, value).otherwise(F.lit(0).cast("bigint"))

    return (
        F.when(F.length(first) < 2, F.lit(0).cast("bigint"))
        .when(first == "fd", wide(2)).when(first == "fe", wide(4)).when(first == "ff", wide(8))
        .otherwise(F.conv(first, 16, 10).cast("bigint"))
    )


def header_fields(df: DataFrame, hex_col: str, size: Column) -> DataFrame:
    """Header fields, block hash, transaction count and size of each record."""
    h = F.col("_hex")
    return df.withColumn("_hex", F.lower(hex_col)).select(
        *[c for c in df.columns if c != hex_col],
        reverse_bytes(double_sha256(_bytes(h, 0, HEADER_BYTES)), 32).alias("block_hash"),
        little_endian(_bytes(h, 0, 4), 4).alias("version"),
        reverse_bytes(_bytes(h, 4, 32), 32).alias("prev_block"),
        reverse_bytes(_bytes(h, 36, 32), 32).alias("merkle_root"),
        little_endian(_bytes(h, 68, 4), 4).alias("timestamp"),
        little_endian(_bytes(h, 72, 4), 4).alias("bits"),
        little_endian(_bytes(h, 76, 4), 4).alias("nonce"),
        varint(h, HEADER_BYTES).alias("tx_count"),
        size.cast("bigint").alias("size"),
    )
