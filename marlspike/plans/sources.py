"""Registered source and sink queries: given tables written in a format and read back.

The files are written by Spark into the shared folder, so their size follows the tables.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from marlspike.operators import metrics as K
from marlspike.operators import ml as M
from marlspike.plans.blocks import BLOCKS, records
from marlspike.plans.ml import Z, Z_SQL
from marlspike.plans.registry import query
from marlspike.session import scratch_path
from marlspike.sources import blocks, files, prices, sinks
from marlspike.sources.tables import table


def _written(spark, lines, label):
    """Lines of text in a new folder."""
    path = scratch_path(spark, label)
    lines.write.text(path)
    return path


@query("src_tbl", """
    SELECT o_orderkey::INTEGER AS o_orderkey, o_custkey::INTEGER AS o_custkey, o_orderstatus, o_totalprice,
      strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority AS o_clerk, NULL::INTEGER AS o_shippriority FROM orders
""")
def src_tbl(spark, sf):
    """Pipe-delimited orders with trailing pipes, empty fields and blank lines."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    fields = F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day, "o_orderpriority", F.lit(""), F.lit(""), F.lit(""))
    blank = F.when(F.col("o_orderkey") % 7 == 0, F.array(fields, F.lit(""))).otherwise(F.array(fields))
    path = _written(spark, table(spark, sf, "orders").select(F.explode(blank)), "tbl")
    read = files.read_tbl(spark, path, "orders")
    return read.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_clerk", "o_shippriority")


@query("src_csv_infer", """
    SELECT p_partkey::INTEGER AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
""")
def src_csv_infer(spark, sf):
    """Parts as CSV with a header; the types are found while the files are read once."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(table(spark, sf, "part"), path)
    return files.read_csv_inferred(spark, path)


@query("src_tsv", """
    SELECT CASE WHEN toxic = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS label, CASE WHEN toxic = 1 THEN 'spam' ELSE 'ham' END AS label_raw,
      translate(text, chr(9) || chr(10) || chr(13), '   ') AS text
    FROM documents JOIN labels USING (doc_id) WHERE text <> ''
""")
def src_tsv(spark, sf):
    """Labelled texts as two-column lines, quotes included; empty texts go."""
    kind = F.when(F.col("toxic") == 1, "spam").otherwise("ham")
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return files.read_messages(spark, _written(spark, labelled.select(F.concat_ws("\t", kind, F.translate("text", "\t\n\r", "   "))), "tsv"))


@query("src_edges", "SELECT l_orderkey::VARCHAR AS src, l_partkey::VARCHAR AS dst FROM lineitem")
def src_edges(spark, sf):
    """An edge list with comments and malformed lines in between."""
    edge = F.concat(F.lit("  "), "l_orderkey", F.lit(" \t "), "l_partkey")
    others = F.when(F.col("l_linenumber") == 1, F.array(edge, F.lit("# a comment"), F.lit("1 2 3"), F.lit("alone"), F.lit(""))).otherwise(F.array(edge))
    return files.read_edges(spark, _written(spark, table(spark, sf, "lineitem").select(F.explode(others)), "edges"))


@query("src_blocks", f"SELECT * EXCLUDE (event_id) FROM ({BLOCKS})")
def src_blocks(spark, sf):
    """Framed records in binary files, a line feed between them, cut into small byte ranges when read."""
    payload = F.unhex("payload")
    size = F.unhex(F.lpad(F.hex(F.octet_length(payload)), 8, "0"))
    frame = F.concat(F.lit(blocks.MAGIC), *[F.substring(size, i, 1) for i in (4, 3, 2, 1)], payload)
    path = _written(spark, records(spark, sf).select(frame.cast("string")), "blocks")
    return blocks.read_blocks(spark, path).drop("path", "offset", "datetime")


@query("snk_csv_single", "SELECT c_custkey::INTEGER AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def snk_csv_single(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(table(spark, sf, "customer"), path)
    return spark.read.schema("c_custkey int, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").option("header", True).csv(path)


@query("snk_parquet", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem")
def snk_parquet(spark, sf):
    """Line items in a folder per return flag, read back with the folder as a column."""
    path = scratch_path(spark, "parquet")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    sinks.write_parquet(rows, path, ("l_returnflag",))
    return files.read_parquet(spark, path, rows.schema)


@query("snk_tsv", "SELECT s_suppkey::INTEGER AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def snk_tsv(spark, sf):
    path = scratch_path(spark, "tsv")
    sinks.write_tsv(table(spark, sf, "supplier"), path)
    return spark.read.schema("s_suppkey int, s_name string, s_nationkey int, s_acctbal double").option("sep", "\t").csv(path)


@query("snk_model", Z_SQL)
def snk_model(spark, sf):
    """A fitted pipeline saved, loaded and applied."""
    keep = ["l_orderkey", "l_linenumber", "l_partkey"]
    rows = table(spark, sf, "lineitem").select(*keep, *Z)
    path = scratch_path(spark, "model")
    sinks.save_model(Pipeline(stages=M.scaling_stages(Z)).fit(rows), path)
    z = sinks.load_model(path).transform(rows).select(*keep, vector_to_array("features").alias("z"))
    return z.select(*keep, *[(F.round(F.col("z")[i], 6) + F.lit(0.0)).alias(f"z_{c}") for i, c in enumerate(Z)])


@query("snk_metrics", """
    WITH s AS (SELECT l_returnflag AS label, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem), 6) AS share
               FROM lineitem GROUP BY 1 ORDER BY n DESC, label LIMIT 1)
    SELECT run_id, 'train' AS stage, metric, CASE metric WHEN 'n' THEN n ELSE share END AS value
    FROM s, (VALUES ('first'), ('second')) r(run_id), (VALUES ('n'), ('share')) m(metric)
""")
def snk_metrics(spark, sf):
    """Metric rows of two runs appended to one log."""
    path = scratch_path(spark, "log")
    found = K.majority(table(spark, sf, "lineitem"), "l_returnflag")
    for run in ("first", "second"):
        rows = found.select(F.lit(run).alias("run_id"), F.lit("train").alias("stage"), F.explode(F.create_map(
            F.lit("n"), F.col("n").cast("double"), F.lit("share"), "share")).alias("metric", "value"))
        sinks.append_metrics(rows, path)
    return spark.read.schema("run_id string, stage string, metric string, value double, timestamp timestamp").option("header", True).csv(path).drop("timestamp")


# --- price tables with foreign headers ---------------------------------------

def _foreign(spark, sf):
    """Events as a price table: times in milliseconds, prices as text, some of them no numbers, no volume."""
    text = F.when(F.col("event_id") % 11 == 0, "n/a").otherwise(F.col("value").cast("string"))
    return table(spark, sf, "events").select(
        (F.unix_seconds(F.col("ts").cast("timestamp")) * 1000).cast("string").alias("Open time"),
        text.alias("Open"), F.col("value").alias("High"), (F.col("value") / 2).alias("Low"), F.col("value").alias("Close"), "event_id")


PRICED = """
    SELECT event_id, epoch_us(ts) // 1000000 AS t, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS open, value AS high, value / 2 AS low,
      value AS close FROM events
"""


@query("prj_rename_synonyms", f"""
    SELECT (t * 1000)::VARCHAR AS timestamp, event_id % 11 <> 0 AS numeric, high, low, close, event_id FROM ({PRICED})
""")
def prj_rename_synonyms(spark, sf):
    named = prices.rename_synonyms(_foreign(spark, sf))
    return named.withColumn("numeric", F.col("open") != "n/a").drop("open")


@query("prj_cast", f"SELECT event_id, open FROM ({PRICED})")
def prj_cast(spark, sf):
    """Prices stored as text become doubles, what is no number null."""
    return M.cast_prices(prices.rename_synonyms(_foreign(spark, sf))).select("event_id", "open")


@query("cln_default_column", f"""
    SELECT t AS timestamp, open, high, low, close, 0.0::DOUBLE AS volume, make_timestamp(t * 1000000) AS datetime FROM ({PRICED})
    WHERE open IS NOT NULL AND high IS NOT NULL
""")
def cln_default_column(spark, sf):
    """Bars with the missing volume set to zero; rows with a null go."""
    bars = prices.harmonise(_foreign(spark, sf))
    return bars.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


@query("prj_drop_dupcols", "SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def prj_drop_dupcols(spark, sf):
    """A join that repeats columns, each kept once."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    return prices.drop_duplicate_columns(joined.select("*", orders["o_totalprice"], customers["c_name"]))
