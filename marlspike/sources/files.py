"""File sources: text, pipe-delimited tables, CSV, TSV, edge lists, parquet, trip streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marlspike.operators.series import running_sum
from marlspike.session import scratch_path

# The reduced relational schemas and the trip schema.
TBL_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int, n_comment string",
    "customer": "c_custkey int, c_name string, c_nationkey int, c_comment string",
    "orders": "o_orderkey int, o_custkey int, o_orderstatus string, o_totalprice double, o_orderdate date, "
              "o_clerk string, o_shippriority int, o_comment string",
    "part": "p_partkey int, p_name string, p_mfgr string, p_brand string, p_type string",
    "supplier": "s_suppkey int, s_name string, s_nationkey int, s_comment string",
    "lineitem": "l_orderkey int, l_partkey int, l_suppkey int, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate date, l_commitdate date, l_receiptdate date, "
                "l_shipinstruct string, l_shipmode string, l_comment string",
}
TRIP_SCHEMA = (
    "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count int, "
    "trip_distance double, dropoff_longitude double, dropoff_latitude double"
)
MESSAGE_SCHEMA = "label_raw string, text string"


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def numbered_text(spark: SparkSession, path: str) -> DataFrame:
    """``line, line_no``: zero-based line numbers over all files in path order.

    Lines are numbered within their input split, which one task reads in order,
    and moved up by the number of lines in all earlier splits.
    """
    split = ["_file", "_start"]
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    )
    sizes = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"))
    upto = running_sum(sizes, split, "_n", "_upto").select(*split, (F.col("_upto") - F.col("_n")).alias("_base"))
    within = Window.partitionBy(*split).orderBy("_seen")
    return (
        lines.withColumn("_seen", F.monotonically_increasing_id())
        .withColumn("_pos", F.row_number().over(within) - 1)
        .join(upto, split)
        .select("line", (F.col("_base") + F.col("_pos")).alias("line_no"))
    )


def read_tbl(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Pipe-delimited table with a trailing pipe; empty fields are null, blank lines dropped."""
    return spark.read.schema(TBL_SCHEMAS[name]).option("sep", "|").option("quote", "").csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


#: Kinds of text, from narrow to wide, by pattern; what fits none is a string.
KINDS = (
    ("int", r"[+-]?\d+"),
    ("double", r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]?|[+-]?(NaN|Infinity|Inf)"),
    ("date", r"\d{4}-\d{2}-\d{2}"),
    ("timestamp", r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?"),
    ("boolean", r"(?i)true|false"),
)
_TYPES = ("int", "bigint", "double", "date", "timestamp", "boolean", "string")


def _kind(value: Column) -> Column:
    """The narrowest type of one text value; null for an empty one."""
    out = F.when(value.isNull() | (value == ""), F.lit(None).cast("string"))
    for name, pattern in KINDS:
        fits = value.rlike(f"^({pattern})$")
        if name == "int":
            whole = value.try_cast("decimal(38,0)")
            out = out.when(fits & whole.between(-(1 << 31), (1 << 31) - 1), "int").when(fits & whole.between(-(1 << 63), (1 << 63) - 1), "bigint")
        elif name in ("date", "timestamp"):
            out = out.when(fits & value.try_cast(name).isNotNull(), name)
        else:
            out = out.when(fits, name)
    return out.otherwise("string")


def _merged(kinds: set[str]) -> str:
    """The least type that holds all kinds."""
    if not kinds:
        return "string"
    if len(kinds) == 1:
        return next(iter(kinds))
    for wide, inside in (("bigint", {"int"}), ("double", {"int", "bigint"}), ("timestamp", {"date"})):
        if kinds <= inside | {wide}:
            return wide
    return "string"


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and types found in the data, which is read once.

    The scan writes the text values to the shared folder as Parquet, and merges the types
    of every column on the way; the result is that table with the text cast. A column
    without a value is a string.
    """
    raw = spark.read.option("header", True).csv(path)
    seen = Observation("kinds")
    bits = F.create_map(*[x for i, k in enumerate(_TYPES) for x in (F.lit(k), F.lit(1 << i))])
    kinds = [F.bit_or(bits[_kind(F.col(f"`{c}`"))]).alias(f"k{i}") for i, c in enumerate(raw.columns)]
    target = scratch_path(spark, "csv")
    raw.observe(seen, *kinds).write.parquet(target)
    masks = [seen.get[f"k{i}"] or 0 for i in range(len(raw.columns))]
    found = [_merged({k for i, k in enumerate(_TYPES) if m >> i & 1}) for m in masks]
    stored = spark.read.schema(raw.schema).parquet(target)
    return stored.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in zip(raw.columns, found)])


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """``label, label_raw, text`` of a two-column TSV; quotes stay in the text, null texts go."""
    raw = spark.read.schema(MESSAGE_SCHEMA).option("sep", "\t").option("quote", "").csv(path)
    return raw.filter(F.col("text").isNotNull()).select(
        F.when(F.col("label_raw") == "spam", 1.0).otherwise(0.0).alias("label"), "label_raw", "text")


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """``src, dst`` strings of a whitespace edge list; comments and malformed lines are skipped."""
    parts = F.split(F.trim("value"), r"\s+")
    return (
        spark.read.text(path).filter(~F.col("value").startswith("#"))
        .select(parts.alias("p")).filter(F.size("p") == 2)
        .select(F.col("p")[0].alias("src"), F.col("p")[1].alias("dst"))
    )


def trip_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(TRIP_SCHEMA).option("header", True)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path)
