"""Hash and byte-order expressions over hexadecimal text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: number of feature buckets.
HASH_DIM = 1 << 18


def md5_bucket(text: Column, dim: int = HASH_DIM) -> Column:
    """md5 of the text modulo ``dim``.

    ``dim`` must be a power of two up to 2**20: then the last five hexadecimal
    digits of the digest decide the remainder.
    """
    if dim & (dim - 1) or not 0 < dim <= 1 << 20:
        raise ValueError("dim must be a power of two up to 2**20")
    tail = F.conv(F.substring(F.md5(text), 28, 5), 16, 10).cast("int")
    return tail % dim


def slot(text: Column, slots: Column) -> Column:
    """Deterministic slot 0 … slots-1 of a text value."""
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, slots)


def reverse_bytes(hex_text: Column, width: int) -> Column:
    """Hexadecimal text of ``width`` bytes with the bytes in reverse order."""
    return F.concat(*[F.substring(hex_text, 2 * i + 1, 2) for i in reversed(range(width))])


def little_endian(hex_text: Column, width: int) -> Column:
    """Unsigned little-endian integer of up to seven bytes, as bigint."""
    return F.conv(reverse_bytes(hex_text, width), 16, 10).cast("bigint")


def double_sha256(hex_text: Column) -> Column:
    """SHA-256 applied twice to the bytes behind the hexadecimal text."""
    return F.sha2(F.unhex(F.sha2(F.unhex(hex_text), 256)), 256)
