"""SHA-256 of each group's values, joined in order, without holding a group."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def joined_sha256(rows: DataFrame, key: str, order: str, value: str, separator: str) -> DataFrame:
    """``key, sha256``: the hexadecimal digest of a group's ``value`` strings in ``order``, joined by ``separator``.

    A digest needs its bytes in sequence, so the task that gets a group reads it as a
    stream: one running digest and one batch are in memory, however large the group is.
    """
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, first = None, None, True
        for batch in batches:
            keys, shas = [], []
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if first or k != now:
                    if not first:
                        keys.append(now)
                        shas.append(digest.hexdigest())
                    now, digest, first = k, hashlib.sha256(v.encode()), False
                else:
                    digest.update((separator + v).encode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), pa.array(shas)], [key, "sha256"])
            form = batch.column(0).type
        if not first:
            yield pa.RecordBatch.from_arrays([pa.array([now], form), pa.array([digest.hexdigest()])], [key, "sha256"])

    sorted_rows = rows.select(key, order, F.col(value).alias("__value")).repartition(key).sortWithinPartitions(key, order)
    return sorted_rows.select(key, "__value").mapInArrow(run, f"{key} {kind}, sha256 string")
