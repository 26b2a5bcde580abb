import datetime as dt

import pytest

from marlspike.operators import relational as R
from marlspike.sources import files
from tests.conftest import rows
from tests.fixtures.tables import DAY, TBL


@pytest.fixture(scope="module", params=["tbl", "parquet"])
def t(request, spark, tmp_path_factory):
    """The six tables read from text, and the same tables through parquet."""
    base = tmp_path_factory.mktemp("tables")
    out = {}
    for name, text in TBL.items():
        path = base / f"{name}.tbl"
        path.write_text(text)
        out[name] = files.read_tbl(spark, str(path), name)
        if request.param == "parquet":
            out[name].write.parquet(str(base / f"{name}.parquet"))
            out[name] = files.read_parquet(spark, str(base / f"{name}.parquet"), files.TBL_SCHEMAS[name])
    return out


def test_load(t):
    assert t["customer"].count() == 3
    assert t["customer"].filter("c_comment IS NULL").count() == 1
    assert t["lineitem"].first().l_shipdate == dt.date(1995, 3, 15)


def test_q1(t):
    assert rows(R.shipped_count(t["lineitem"], DAY)) == [(3,)]


def test_q2(t):
    semi = R.clerks_semi(t["orders"], t["lineitem"], DAY)
    assert rows(semi) == [(1, "Clerk#000000001"), (2, "Clerk#000000002")]
    inner = R.clerks_inner(t["orders"], t["lineitem"], DAY)
    assert rows(inner) == [(1, "Clerk#000000001"), (1, "Clerk#000000001"), (2, "Clerk#000000002")]


def test_q3(t):
    assert rows(R.part_supplier(t["lineitem"], t["part"], t["supplier"], DAY)) == [
        (1, "Part#1", "Supplier#1"), (1, "Part#2", "Supplier#2"), (2, "Part#1", "Supplier#1")]


def test_q4(t):
    got = R.nation_shipments(t["lineitem"], t["orders"], t["customer"], t["nation"], DAY)
    assert [tuple(r) for r in got.collect()] == [(1, "UNITED STATES", 2), (2, "CANADA", 1)]


def test_q5(t):
    got = R.monthly_volumes(t["lineitem"], t["orders"], t["customer"], t["nation"], ["CANADA", "UNITED STATES"])
    assert [tuple(r) for r in got.collect()] == [
        (2, "CANADA", "1995-03", 1), (2, "CANADA", "1995-05", 1),
        (1, "UNITED STATES", "1995-03", 2), (1, "UNITED STATES", "1995-04", 1)]


def test_q6(t):
    (row,) = R.pricing_summary(t["lineitem"], DAY).collect()
    assert tuple(row)[:6] == ("N", "O", 10.0, 1000.0, 0.05, 3)
    assert row.avg_qty == pytest.approx(10 / 3) and row.avg_price == pytest.approx(1000 / 3)


def test_q7(t):
    got = R.shipping_priority(t["lineitem"], t["orders"], t["customer"], "1995-04-01", "1995-03-01")
    assert [tuple(r) for r in got.collect()] == [("Customer#1", 1, 500.0, 0), ("Customer#2", 2, 475.0, 0)]


def test_inner_form_with_one_order_holding_most_items(spark):
    items = spark.range(1000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7L ELSE id END AS l_orderkey", "date'1995-03-15' AS l_shipdate")
    orders = spark.range(1000).selectExpr("id AS o_orderkey", "concat('c', id) AS o_clerk")
    got = [r.o_orderkey for r in R.clerks_inner(orders, items, DAY, limit=10).collect()]
    brute = sorted([7 if i % 3 == 0 else i for i in range(1000)])[:10]
    assert got == brute


def test_broadcast_only_when_small(spark):
    df = spark.range(100)
    assert "broadcast" in R.broadcast_if_small(df, 100)._jdf.queryExecution().logical().toString().lower()
    assert R.broadcast_if_small(df, 99) is df


def test_orphans_keep_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "p int")
    assert rows(R.orphans(child, "k", parent, "p")) == [(2,), (None,)]
