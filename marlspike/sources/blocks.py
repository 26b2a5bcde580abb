"""Length-framed binary block files, read in byte ranges.

Spark's text reader cuts files into ranges and finds the first separator in each; with the
frame marker as the separator, and a one-byte encoding to name it, every range finds its
first frame without reading what lies before. A piece is what stands between two markers:
the length field, the payload, and bytes that belong to no record.

A marker can also occur inside a payload. Then the frame's piece is shorter than its
length says, and it swallows the pieces up to its end; one that would run past the end of
the file is cut off and no record. Only such pieces, which are rare, are compared with
others. Offsets are running sums of the sizes of all pieces of a file.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlspike.functions.blocks import HEADER_BYTES, VARINT_BYTES, header_fields
from marlspike.functions.hashing import little_endian
from marlspike.session import cut_lineage

# Fixed value: bytes that start every record.
MAGIC = bytes.fromhex("f9beb4d9")
KEEP = HEADER_BYTES + VARINT_BYTES


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """``path, file_size, offset, size, head``: what follows each marker, by the byte after the marker; at most the bytes of a head are kept."""
    raw = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("file_size"), F.col("value").cast("binary").alias("bytes"))
    cut = cut_lineage(raw.select(
        "path", "start", "file_size", F.monotonically_increasing_id().alias("seen"), F.octet_length("bytes").cast("long").alias("size"),
        F.substring("bytes", 1, 4 + KEEP).alias("head")))
    within = Window.partitionBy("path", "start").orderBy("seen").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.col("size") + len(MAGIC)
    # one row a range
    ranges = cut.groupBy("path", "start").agg(F.sum(taken).alias("bytes")).withColumn("before", F.coalesce(F.sum("bytes").over(
        Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = cut.withColumn("at", F.coalesce(F.sum(taken).over(within), F.lit(0))).join(ranges.drop("bytes"), ["path", "start"])
    return placed.select("path", "file_size", (F.col("before") + F.col("at")).alias("offset"), "size", "head").filter("offset > 0")  # before the first marker


def _unswallowed(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the frames of one file that claim more than their piece holds: those whose marker lies in no earlier one."""
    rows, end, keep = rows.sort_values("offset"), -1, []
    for offset, until in zip(rows["offset"], rows["until"]):
        keep.append(offset - len(MAGIC) >= end)
        end = until if keep[-1] else end
    return rows[keep]


def frames(found: DataFrame) -> DataFrame:
    """``path, offset, payload_bytes, head``: every complete frame; ``head`` is the payload's beginning."""
    declared = little_endian(F.hex(F.substring("head", 1, 4)), 4)
    found = found.withColumn("length", F.when(F.col("size") >= 4, declared)).withColumn("until", F.col("offset") + 4 + F.col("length"))
    found = cut_lineage(found)
    whole = (F.col("length") + 4) <= F.col("size")
    longer = found.filter(~whole & (F.col("until") <= F.col("file_size"))).select("path", "offset", "length", "until", "head")
    longer = cut_lineage(longer.groupBy("path").applyInPandas(_unswallowed, longer.schema))
    inside = found.alias("p").join(longer.alias("f"), (F.col("p.path") == F.col("f.path")) & (F.col("p.offset") > F.col("f.offset"))
                                   & (F.col("p.offset") - len(MAGIC) < F.col("f.until"))).select("p.path", "p.offset", F.col("f.offset").alias("of"), "p.head")
    inside = cut_lineage(inside)
    marker = F.lit(MAGIC)
    near = inside.filter(F.col("offset") - len(MAGIC) - F.col("of") < 4 + KEEP).groupBy("path", F.col("of").alias("offset")).agg(
        F.sort_array(F.collect_list(F.struct("offset", "head"))).alias("rest"))
    text = F.aggregate("rest", F.col("head"), lambda all_, r: F.concat(all_, marker, r["head"]))
    merged = longer.join(near, ["path", "offset"], "left").select(
        "path", "offset", "length", F.when(F.col("rest").isNull(), F.col("head")).otherwise(text).alias("head"))
    plain = found.filter(whole).join(inside.select("path", "offset"), ["path", "offset"], "left_anti").select("path", "offset", "length", "head")
    return plain.unionByName(merged).select(
        "path", (F.col("offset") + 4).alias("offset"), F.col("length").alias("payload_bytes"),
        F.substring(F.col("head"), F.lit(5), F.least(F.col("length"), F.lit(KEEP)).cast("int")).alias("head"))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """One row per block in all files under ``path``; files of any size are read by as many tasks as they have ranges."""
    records = frames(pieces(spark, path)).filter(F.col("payload_bytes") >= HEADER_BYTES)
    named = records.select("path", "offset", "payload_bytes", F.hex("head").alias("head"))
    fields = header_fields(named, "head", F.col("payload_bytes")).drop("payload_bytes")
    return fields.withColumn("datetime", F.timestamp_seconds("timestamp"))
