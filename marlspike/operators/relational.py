"""Joins, shipped-goods reports and clean-up steps over relational tables.

Fact rows are pre-aggregated on the join key before they are shuffled, so a key
that holds a large share of the fact table arrives at the join as a few rows
per map task and not as one oversized partition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 200_000


def day(value: str | dt.date) -> Column:
    """Date literal; Spark folds it to the column's type, so it reaches the scan."""
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only after counting that it holds at most ``max_rows``.

    The count stops at ``max_rows + 1`` rows. A larger side is returned as it
    is, and Spark joins it with a shuffle.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def shipped_on(lineitem: DataFrame, on: str | dt.date) -> DataFrame:
    return lineitem.filter(F.col("l_shipdate") == day(on))


def shipped_count(lineitem: DataFrame, on: str | dt.date) -> DataFrame:
    return shipped_on(lineitem, on).agg(F.count(F.lit(1)).alias("n"))


def clerks_semi(
    orders: DataFrame, lineitem: DataFrame, on: str | dt.date,
    clerk: str = "o_clerk", limit: int = 20,
) -> DataFrame:
    """One row per order with an item shipped on the day."""
    keys = shipped_on(lineitem, on).select("l_orderkey").distinct()
    return (
        orders.select("o_orderkey", clerk)
        .join(keys, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        .orderBy("o_orderkey", clerk)
        .limit(limit)
    )


def clerks_inner(
    orders: DataFrame, lineitem: DataFrame, on: str | dt.date,
    clerk: str = "o_clerk", limit: int = 20,
) -> DataFrame:
    """One row per matching line item.

    Items are counted per order before the join and repeated after it. No order
    can fill more than ``limit`` of the ``limit`` output rows, so repeating it at
    most that often leaves the result unchanged.
    """
    counts = shipped_on(lineitem, on).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return (
        orders.select("o_orderkey", clerk)
        .join(counts, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            "o_orderkey", clerk,
            F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(limit)).cast("int"))).alias("_copy"),
        )
        .drop("_copy")
        .orderBy("o_orderkey", clerk)
        .limit(limit)
    )


def part_supplier(
    lineitem: DataFrame, part: DataFrame, supplier: DataFrame,
    on: str | dt.date, limit: int = 20,
) -> DataFrame:
    """(order, part name, supplier name) of the day's items, both lookups size-checked."""
    parts = broadcast_if_small(part.select("p_partkey", "p_name"))
    suppliers = broadcast_if_small(supplier.select("s_suppkey", "s_name"))
    return (
        shipped_on(lineitem, on)
        .select("l_orderkey", "l_partkey", "l_suppkey")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "p_name", "s_name")
        .orderBy("l_orderkey", "p_name", "s_name")
        .limit(limit)
    )


def nation_shipments(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame,
    on: str | dt.date,
) -> DataFrame:
    """Items shipped on the day per customer nation."""
    per_order = shipped_on(lineitem, on).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    per_customer = (
        per_order.join(
            orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
        )
        .groupBy("o_custkey")
        .agg(F.sum("n").alias("n"))
    )
    per_nation = (
        per_customer.join(
            customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
        )
        .groupBy("c_nationkey")
        .agg(F.sum("n").alias("n"))
    )
    return (
        per_nation.join(
            nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        .groupBy("n_nationkey", "n_name")
        .agg(F.sum("n").alias("shipments"))
        .orderBy(F.desc("shipments"), "n_name", "n_nationkey")
    )


def monthly_volumes(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame,
    nations: Sequence[str],
) -> DataFrame:
    """Items shipped per month for the named nations.

    The nation filter comes first and cuts customers and orders down before
    they meet the line items.
    """
    chosen = nation.filter(F.col("n_name").isin(list(nations))).select("n_nationkey", "n_name")
    customers = customer.select("c_custkey", "c_nationkey").join(
        chosen, F.col("c_nationkey") == F.col("n_nationkey")
    )
    nation_orders = orders.select("o_orderkey", "o_custkey").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    ).select("o_orderkey", "n_nationkey", "n_name")
    per_order_month = (
        lineitem.select("l_orderkey", F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month_start"))
        .groupBy("l_orderkey", "month_start")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_order_month.join(nation_orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("n_nationkey", "n_name", "month_start")
        .agg(F.sum("n").alias("shipments"))
        .select(
            "n_nationkey", "n_name",
            F.date_format("month_start", "yyyy-MM").alias("month"), "shipments",
        )
        .orderBy("n_name", "month", "n_nationkey")
    )


def pricing_summary(lineitem: DataFrame, on: str | dt.date) -> DataFrame:
    return (
        shipped_on(lineitem, on)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.sum("l_extendedprice").alias("sum_price"),
            F.sum("l_discount").alias("sum_discount"),
            F.count(F.lit(1)).alias("n"),
            F.avg("l_quantity").alias("avg_qty"),
            F.avg("l_extendedprice").alias("avg_price"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


def shipping_priority(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
    ordered_before: str | dt.date, shipped_after: str | dt.date,
    priority: str = "o_shippriority", limit: int = 10,
) -> DataFrame:
    """Largest open revenue per (customer, order, priority)."""
    revenue = (
        lineitem.filter(F.col("l_shipdate") > day(shipped_after))
        .groupBy("l_orderkey")
        .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    )
    early = orders.filter(F.col("o_orderdate") < day(ordered_before)).select(
        "o_orderkey", "o_custkey", priority
    )
    return (
        revenue.join(early, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_name", "o_orderkey", priority)
        .agg(F.round(F.sum("revenue"), 4).alias("revenue"))
        .select("c_name", "o_orderkey", "revenue", priority)
        .orderBy(F.desc("revenue"), "c_name", "o_orderkey", priority)
        .limit(limit)
    )


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose foreign key has no parent (or is null)."""
    return child.join(
        parent.select(F.col(parent_key).alias("_parent")),
        F.col(key) == F.col("_parent"), "left_anti",
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count / mean / stddev / min / max of numeric columns, one row per column, one pass."""
    stats = df.agg(*[
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        ).alias(f"_{i}")
        for i, c in enumerate(columns)
    ])
    return stats.select(
        F.explode(F.array(*[F.col(f"_{i}") for i in range(len(columns))])).alias("s")
    ).select("s.*")


def mean_std(df: DataFrame, value: str) -> tuple[Column, Column]:
    """Mean and sample deviation of one column as scalar subqueries."""
    return (
        df.agg(F.avg(value)).scalar(),
        df.agg(F.stddev_samp(value)).scalar(),
    )


def outside_sigmas(df: DataFrame, value: str, sigmas: float = 3.0) -> Column:
    mean, std = mean_std(df, value)
    return F.abs(F.col(value) - mean) > sigmas * std
