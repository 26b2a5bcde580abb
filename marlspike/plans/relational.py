"""Registered relational queries: shipped-goods reports, joins, aggregates, sets, clean-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlspike.operators import relational as R
from marlspike.plans.registry import query
from marlspike.sources.tables import table

DAY = "1995-08-09"
NATIONS = ("NATION_1", "NATION_2")
ORDERED_BEFORE = "1995-04-01"
SHIPPED_AFTER = "1995-03-01"


# --- shipped-goods reports -------------------------------------------------

@query("q1_shipped_count", f"""
    SELECT count(*) AS n FROM lineitem WHERE l_shipdate = TIMESTAMP '{DAY}'
""")
def q1(spark, sf):
    return R.shipped_count(table(spark, sf, "lineitem"), DAY)


@query("q2_clerks_semi", f"""
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey
                  AND l_shipdate = TIMESTAMP '{DAY}')
    ORDER BY o_orderkey, o_orderpriority LIMIT 20
""")
def q2_semi(spark, sf):
    return R.clerks_semi(table(spark, sf, "orders"), table(spark, sf, "lineitem"), DAY, "o_orderpriority")


@query("q2_clerks_inner", f"""
    SELECT o_orderkey, o_orderpriority FROM orders
    JOIN lineitem ON l_orderkey = o_orderkey
    WHERE l_shipdate = TIMESTAMP '{DAY}'
    ORDER BY o_orderkey, o_orderpriority LIMIT 20
""")
def q2_inner(spark, sf):
    return R.clerks_inner(table(spark, sf, "orders"), table(spark, sf, "lineitem"), DAY, "o_orderpriority")


@query("q3_part_supplier", f"""
    SELECT l_orderkey, p_name, s_name FROM lineitem
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    WHERE l_shipdate = TIMESTAMP '{DAY}'
    ORDER BY l_orderkey, p_name, s_name LIMIT 20
""")
def q3(spark, sf):
    return R.part_supplier(
        table(spark, sf, "lineitem"), table(spark, sf, "part"), table(spark, sf, "supplier"), DAY
    )


@query("q4_nation_shipments", f"""
    SELECT n_nationkey, n_name, count(*) AS shipments
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE l_shipdate = TIMESTAMP '{DAY}' GROUP BY ALL
""")
def q4(spark, sf):
    return R.nation_shipments(
        table(spark, sf, "lineitem"), table(spark, sf, "orders"),
        table(spark, sf, "customer"), table(spark, sf, "nation"), DAY,
    )


@query("q5_monthly_volumes", """
    SELECT n_nationkey, n_name, strftime(l_shipdate, '%Y-%m') AS month, count(*) AS shipments
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name IN ('NATION_1', 'NATION_2') GROUP BY ALL
""")
def q5(spark, sf):
    return R.monthly_volumes(
        table(spark, sf, "lineitem"), table(spark, sf, "orders"),
        table(spark, sf, "customer"), table(spark, sf, "nation"), NATIONS,
    )


@query("q6_pricing_summary", f"""
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
           round(sum(l_extendedprice), 4) AS sum_price,
           round(sum(l_discount), 4) AS sum_discount, count(*) AS n,
           round(avg(l_quantity), 6) AS avg_qty, round(avg(l_extendedprice), 6) AS avg_price
    FROM lineitem WHERE l_shipdate = TIMESTAMP '{DAY}' GROUP BY ALL
""")
def q6(spark, sf):
    return R.pricing_summary(table(spark, sf, "lineitem"), DAY).select(
        "l_returnflag", "l_linestatus", "sum_qty",
        F.round("sum_price", 4).alias("sum_price"),
        F.round("sum_discount", 4).alias("sum_discount"), "n",
        F.round("avg_qty", 6).alias("avg_qty"), F.round("avg_price", 6).alias("avg_price"),
    )


@query("q7_shipping_priority", f"""
    SELECT c_name, o_orderkey,
           round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    WHERE o_orderdate < TIMESTAMP '{ORDERED_BEFORE}' AND l_shipdate > TIMESTAMP '{SHIPPED_AFTER}'
    GROUP BY c_name, o_orderkey, o_orderpriority
    ORDER BY revenue DESC, c_name, o_orderkey, o_orderpriority LIMIT 10
""")
def q7(spark, sf):
    return R.shipping_priority(
        table(spark, sf, "lineitem"), table(spark, sf, "orders"), table(spark, sf, "customer"),
        ORDERED_BEFORE, SHIPPED_AFTER, "o_orderpriority",
    )


# --- projection and filters ------------------------------------------------

@query("prj_select", """
    SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS total FROM orders
""")
def prj_select(spark, sf):
    return (
        table(spark, sf, "orders")
        .select(F.col("o_orderkey").alias("order_key"),
                F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total")).alias("s"))
        .select("order_key", F.col("s.status").alias("status"), F.col("s.total").alias("total"))
    )


@query("prj_derive", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge,
           CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS label FROM lineitem
""")
def prj_derive(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .withColumn("charge", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")), 6))
        .withColumn("label", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0))
        .select("l_orderkey", "l_linenumber", "l_partkey", "charge", "label")
    )


@query("src_parquet", """
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 4) AS qty
    FROM lineitem GROUP BY ALL
""")
def src_parquet(spark, sf):
    from marlspike.sources.files import read_parquet

    schema = "l_returnflag string, l_linestatus string, l_quantity double"
    return (
        read_parquet(spark, f"{sf}/lineitem.parquet", schema)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("qty"))
    )


@query("flt_equality", f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
    WHERE l_shipdate = TIMESTAMP '{DAY}'
""")
def flt_equality(spark, sf):
    return R.shipped_on(table(spark, sf, "lineitem"), DAY).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )


@query("flt_range", f"""
    SELECT count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders
    WHERE o_orderdate < TIMESTAMP '{ORDERED_BEFORE}' AND o_orderdate > TIMESTAMP '1995-01-15'
""")
def flt_range(spark, sf):
    o = table(spark, sf, "orders")
    return o.filter(
        (F.col("o_orderdate") < R.day(ORDERED_BEFORE)) & (F.col("o_orderdate") > R.day("1995-01-15"))
    ).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("flt_in", """
    SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name IN ('NATION_1', 'NATION_2')
""")
def flt_in(spark, sf):
    n = table(spark, sf, "nation").filter(F.col("n_name").isin(*NATIONS))
    return table(spark, sf, "customer").join(
        n, F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "c_name", "n_name")


@query("flt_notnull", """
    SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)
    WHERE l.quality IS NOT NULL
""")
def flt_notnull(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return d.join(table(spark, sf, "labels"), "doc_id", "left").filter(
        F.col("quality").isNotNull()
    ).select("doc_id", "lang", "quality")


@query("flt_having", """
    SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 60
""")
def flt_having(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 60")


# --- cleaning --------------------------------------------------------------

@query("cln_dropna", """
    SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)
    WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL
""")
def cln_dropna(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return d.join(table(spark, sf, "labels"), "doc_id", "left").dropna(subset=["quality", "toxic"]).select(
        "doc_id", "quality", "toxic"
    )


@query("cln_fillna", """
    SELECT d.doc_id, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic
    FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def cln_fillna(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return d.join(table(spark, sf, "labels"), "doc_id", "left").fillna(0, subset=["quality", "toxic"]).select(
        "doc_id", "quality", "toxic"
    )


@query("cln_epoch_normalise", """
    SELECT event_id, epoch_us(ts) // 1000000 AS seconds FROM events
""")
def cln_epoch_normalise(spark, sf):
    """Epochs written as seconds, as milliseconds and as text, all brought back to seconds."""
    from marlspike.functions.timefix import epoch_seconds

    ts = F.col("ts").cast("timestamp")
    raw = (
        F.when(F.col("event_id") % 3 == 0, F.unix_seconds(ts).cast("string"))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit(" "), F.unix_millis(ts).cast("string")))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return table(spark, sf, "events").select("event_id", epoch_seconds(raw).alias("seconds"))


@query("prf_describe", """
    WITH v AS (SELECT value, (props::JSON->>'$.k')::BIGINT AS k, user_id FROM events)
    SELECT * FROM (
      SELECT 'value' AS "column", count(value) AS count, round(avg(value), 9) AS mean,
             round(stddev_samp(value), 9) AS stddev, min(value)::DOUBLE AS min, max(value)::DOUBLE AS max FROM v
      UNION ALL SELECT 'k', count(k), round(avg(k), 9), round(stddev_samp(k), 9), min(k)::DOUBLE, max(k)::DOUBLE FROM v
      UNION ALL SELECT 'user_id', count(user_id), round(avg(user_id), 9), round(stddev_samp(user_id), 9),
             min(user_id)::DOUBLE, max(user_id)::DOUBLE FROM v)
""")
def prf_describe(spark, sf):
    e = table(spark, sf, "events").select(
        "value", F.get_json_object("props", "$.k").cast("bigint").alias("k"), "user_id"
    )
    return R.describe(e, ["value", "k", "user_id"]).select(
        "column", "count", F.round("mean", 9).alias("mean"), F.round("stddev", 9).alias("stddev"), "min", "max"
    )


# --- joins -----------------------------------------------------------------

@query("jn_inner_equi", """
    SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def jn_inner_equi(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    places = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "c_name", "n_name", "r_name")
    )


@query("jn_reduce_side", """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def jn_reduce_side(spark, sf):
    keys = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey").distinct()
    return table(spark, sf, "orders").join(
        keys, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi"
    ).select("o_orderkey", "o_orderpriority")


@query("jn_inner_dup", """
    SELECT o_orderkey, o_orderpriority, count(*) AS copies
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY ALL
""")
def jn_inner_dup(spark, sf):
    """How often the inner form repeats each order: items counted before the shuffle."""
    per_order = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        table(spark, sf, "orders").join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_orderkey", "o_orderpriority").agg(F.sum("n").alias("copies"))
    )


@query("jn_broadcast", """
    SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def jn_broadcast(spark, sf):
    n = R.broadcast_if_small(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    return table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "n_name"
    )


@query("jn_mixed", """
    SELECT n_name, count(*) AS items, round(sum(l_extendedprice), 4) AS price
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def jn_mixed(spark, sf):
    """Shuffle join for the two fact tables, size-checked broadcasts for the dimensions."""
    c = R.broadcast_if_small(table(spark, sf, "customer").select("c_custkey", "c_nationkey"))
    n = R.broadcast_if_small(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("p")
    )
    return (
        per_order.join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
                       F.col("l_orderkey") == F.col("o_orderkey"))
        .join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name").agg(F.sum("n").alias("items"), F.round(F.sum("p"), 4).alias("price"))
    )


@query("jn_left_outer", """
    SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
""")
def jn_left_outer(spark, sf):
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return table(spark, sf, "customer").join(per, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders")
    )


@query("jn_hour_bucket", """
    WITH p AS (SELECT date_trunc('hour', ts) AS hour_ts, count(*) AS n FROM events
               WHERE event_type = 'error' GROUP BY 1)
    SELECT event_id, coalesce(n, 0) AS errors_in_hour FROM events
    LEFT JOIN p ON date_trunc('hour', ts) = hour_ts
""")
def jn_hour_bucket(spark, sf):
    e = table(spark, sf, "events").withColumn("hour_ts", F.date_trunc("hour", "ts"))
    per_hour = e.filter("event_type = 'error'").groupBy("hour_ts").agg(F.count(F.lit(1)).alias("n"))
    return e.join(per_hour, "hour_ts", "left").select(
        "event_id", F.coalesce("n", F.lit(0)).alias("errors_in_hour")
    )


@query("jn_anti_orphans", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def jn_anti_orphans(spark, sf):
    return R.orphans(table(spark, sf, "orders"), "o_orderkey", table(spark, sf, "lineitem"), "l_orderkey").select(
        "o_orderkey", "o_custkey"
    )


# --- aggregates ------------------------------------------------------------

@query("agg_count_by_key", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def agg_count_by_key(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("agg_global_count", "SELECT count(*) AS n FROM lineitem")
def agg_global_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("agg_sum_by_key", """
    SELECT l_suppkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
    FROM lineitem GROUP BY l_suppkey
""")
def agg_sum_by_key(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue")
    )


@query("agg_multi", """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 4) AS sum_qty,
           round(sum(l_extendedprice), 4) AS sum_price, round(sum(l_discount), 4) AS sum_discount,
           count(*) AS n, round(avg(l_quantity), 6) AS avg_qty, round(avg(l_extendedprice), 6) AS avg_price
    FROM lineitem GROUP BY ALL
""")
def agg_multi(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 4).alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 4).alias("sum_price"),
        F.round(F.sum("l_discount"), 4).alias("sum_discount"),
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
        F.round(F.avg("l_extendedprice"), 6).alias("avg_price"),
    )


@query("agg_conditional", """
    SELECT user_id, count(*) FILTER (event_type = 'error') AS errors,
           count(*) FILTER (event_type = 'click' AND value > 50) AS big_clicks,
           round(coalesce(sum(value) FILTER (event_type = 'purchase'), 0), 4) AS spent
    FROM events GROUP BY user_id
""")
def agg_conditional(spark, sf):
    t = F.col("event_type")
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if(t == "error").alias("errors"),
        F.count_if((t == "click") & (F.col("value") > 50)).alias("big_clicks"),
        F.round(F.coalesce(F.sum(F.when(t == "purchase", F.col("value"))), F.lit(0.0)), 4).alias("spent"),
    )


@query("agg_majority", """
    SELECT toxic AS label, n, round(n / sum(n) OVER (), 6) AS share
    FROM (SELECT toxic, count(*) AS n FROM labels GROUP BY toxic)
    ORDER BY n DESC, label LIMIT 1
""")
def agg_majority(spark, sf):
    from marlspike.operators.metrics import majority

    return majority(table(spark, sf, "labels"), "toxic")


@query("agg_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def agg_distinct(spark, sf):
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()


# --- sort and limit --------------------------------------------------------

@query("srt_multi", """
    SELECT c_nationkey, c_mktsegment, count(*) AS n, round(sum(c_acctbal), 4) AS balance
    FROM customer GROUP BY ALL ORDER BY n DESC, c_nationkey, c_mktsegment
""")
def srt_multi(spark, sf):
    return table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 4).alias("balance")
    ).orderBy(F.desc("n"), "c_nationkey", "c_mktsegment")


@query("srt_limit", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50
""")
def srt_limit(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("srt_topk_heap", """
    SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 10
""")
def srt_topk_heap(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "l_partkey").limit(10)


# --- sets ------------------------------------------------------------------

@query("set_union", """
    SELECT l_orderkey AS k, 'R' AS origin FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT o_orderkey, o_orderstatus FROM orders
""")
def set_union(spark, sf):
    li = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("k"), F.lit("R").alias("origin"))
    o = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("origin"), F.col("o_orderkey").alias("k"))
    return li.unionByName(o)


@query("set_distinct", """
    SELECT l_partkey AS node FROM lineitem UNION SELECT l_suppkey FROM lineitem
""")
def set_distinct(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_partkey").alias("node")).union(li.select("l_suppkey")).distinct()


@query("set_intersect", """
    SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'
    INTERSECT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A'
""")
def set_intersect(spark, sf):
    li = table(spark, sf, "lineitem")
    returned = li.filter("l_returnflag = 'R'").select("l_orderkey").distinct()
    return returned.intersect(li.filter("l_returnflag = 'A'").select("l_orderkey").distinct())


@query("set_except", """
    SELECT o_orderkey FROM orders EXCEPT ALL
    SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'
""")
def set_except(spark, sf):
    li = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey").distinct()
    return table(spark, sf, "orders").select("o_orderkey").exceptAll(li)


# --- reports the reference describes in prose ------------------------------

@query("doc_clean_enrich", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c_name, p_name, p_brand
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey
    WHERE l_extendedprice > 0 AND l_quantity > 0
""")
def doc_clean_enrich(spark, sf):
    """Valid items with customer and product; the customer is resolved per order first."""
    buyers = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(
        table(spark, sf, "customer").select("c_custkey", "c_name"),
        F.col("o_custkey") == F.col("c_custkey"), "left",
    ).select("o_orderkey", "c_name")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return (
        table(spark, sf, "lineitem").filter("l_extendedprice > 0 AND l_quantity > 0")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "c_name", "p_name", "p_brand")
    )


@query("doc_top_customers", """
    SELECT c_custkey, c_name, round(sum(o_totalprice), 4) AS spent
    FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY ALL ORDER BY spent DESC, c_custkey LIMIT 20
""")
def doc_top_customers(spark, sf):
    spent = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"))
    return (
        spent.join(table(spark, sf, "customer").select("c_custkey", "c_name"),
                   F.col("o_custkey") == F.col("c_custkey"))
        .select("c_custkey", "c_name", F.round("s", 4).alias("spent"))
        .orderBy(F.desc("spent"), "c_custkey").limit(20)
    )


@query("doc_category_sales", """
    SELECT p_brand, round(sum(l_extendedprice), 4) AS sales, count(*) AS items
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
""")
def doc_category_sales(spark, sf):
    per_part = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_extendedprice").alias("s"), F.count(F.lit(1)).alias("n"))
    return (
        per_part.join(table(spark, sf, "part").select("p_partkey", "p_brand"),
                      F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand").agg(F.round(F.sum("s"), 4).alias("sales"), F.sum("n").alias("items"))
    )


@query("doc_anomalies", """
    WITH li AS (SELECT *, l_extendedprice / nullif(l_quantity, 0) AS unit FROM lineitem),
    s AS (SELECT avg(unit) mu, stddev_samp(unit) sd, avg(l_quantity) mq, stddev_samp(l_quantity) sq FROM li)
    SELECT 'unit_price' AS reason, l_orderkey AS k, l_partkey AS detail FROM li, s WHERE abs(unit - mu) > 3 * sd
    UNION ALL SELECT 'quantity', l_orderkey, l_partkey FROM li, s WHERE l_quantity - mq > 1.7 * sq
    UNION ALL SELECT 'unknown_customer', o_orderkey, o_custkey FROM orders
      WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
""")
def doc_anomalies(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity",
        F.try_divide("l_extendedprice", F.col("l_quantity")).alias("unit"))
    mean_q, std_q = R.mean_std(li, "l_quantity")
    flagged = li.filter(R.outside_sigmas(li, "unit")).select(
        F.lit("unit_price").alias("reason"), F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("detail"))
    heavy = li.filter(F.col("l_quantity") - mean_q > 1.7 * std_q).select(
        F.lit("quantity").alias("reason"), F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("detail"))
    unknown = R.orphans(
        table(spark, sf, "orders"), "o_custkey", table(spark, sf, "customer"), "c_custkey"
    ).select(F.lit("unknown_customer").alias("reason"), F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("detail"))
    return flagged.unionByName(heavy).unionByName(unknown)


@query("doc_outlier_3sigma", """
    SELECT event_id, value FROM events, (SELECT avg(value) m, stddev_samp(value) s FROM events)
    WHERE abs(value - m) <= 3 * s
""")
def doc_outlier_3sigma(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    return e.filter(~R.outside_sigmas(e, "value"))


@query("doc_projection_study", """
    SELECT year(o_orderdate)::INTEGER AS order_year, count(*) AS n, round(sum(o_totalprice), 4) AS total
    FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1
""")
def doc_projection_study(spark, sf):
    """Orders written partitioned by year, read back pruned to one year and one column."""
    from marlspike.session import scratch_path

    path = scratch_path(spark, "orders-by-year")
    (
        table(spark, sf, "orders")
        .withColumn("order_year", F.year(F.col("o_orderdate").cast("date")))
        .write.partitionBy("order_year").parquet(path)
    )
    return (
        spark.read.parquet(path).filter("order_year = 1997").groupBy("order_year")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 4).alias("total"))
    )


# --- scalar function families ----------------------------------------------

@query("fn_math", """
    SELECT l_orderkey, l_linenumber, l_partkey, round(log10(l_extendedprice), 6) AS log_price,
           round(abs(l_discount - 0.05), 6) AS distance, floor(l_extendedprice / 100)::BIGINT AS hundreds,
           round(l_extendedprice / nullif(l_tax, 0), 4) AS ratio,
           round(1 / (1 + exp(-(l_quantity - 25) / 10)), 6) AS sigmoid FROM lineitem
""")
def fn_math(spark, sf):
    from marlspike.functions.maths import sigmoid

    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(F.log10("l_extendedprice"), 6).alias("log_price"),
        F.round(F.abs(F.col("l_discount") - 0.05), 6).alias("distance"),
        F.floor(F.col("l_extendedprice") / 100).alias("hundreds"),
        F.round(F.try_divide("l_extendedprice", F.col("l_tax")), 4).alias("ratio"),
        F.round(sigmoid((F.col("l_quantity") - 25) / 10), 6).alias("sigmoid"),
    )


@query("fn_datetime", """
    SELECT event_id, date_trunc('hour', ts) AS hour_ts, strftime(ts, '%Y-%m') AS month,
           hour(ts)::INTEGER AS hour_of_day, (dayofweek(ts) + 1)::INTEGER AS day_of_week, epoch_us(ts) // 1000000 AS epoch,
           time_bucket(INTERVAL '10 minutes', ts) AS window_start FROM events
""")
def fn_datetime(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour_ts"),
        F.date_format(ts, "yyyy-MM").alias("month"),
        F.hour(ts).alias("hour_of_day"), F.dayofweek(ts).alias("day_of_week"),
        F.unix_seconds(ts.cast("timestamp")).alias("epoch"),
        F.window(ts, "10 minutes").getField("start").alias("window_start"),
    )


@query("fn_conditional", """
    SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'browse'
             WHEN event_type = 'purchase' THEN 'buy' ELSE 'other' END AS kind,
           coalesce((props::JSON->>'$.missing')::BIGINT, (props::JSON->>'$.k')::BIGINT, -1) AS k,
           value IS NOT NULL AS has_value FROM events
""")
def fn_conditional(spark, sf):
    t = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(t.isin("click", "view"), "browse").when(t == "purchase", "buy").otherwise("other").alias("kind"),
        F.coalesce(F.get_json_object("props", "$.missing").cast("bigint"),
                   F.get_json_object("props", "$.k").cast("bigint"), F.lit(-1)).alias("k"),
        F.col("value").isNotNull().alias("has_value"),
    )
