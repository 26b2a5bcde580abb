"""Every registered query against its DuckDB oracle (all rows, all columns)."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

SF_DIR = os.environ.get("MARLSPIKE_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()
# Model fits have no oracle and take minutes together; tests/test_ml.py covers them with small settings.
NAMES = [n for n in entry.queries() if n in ORACLES or os.environ.get("MARLSPIKE_FITS")]


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    ok, message = compare(spark, con, entry.queries()[name], ORACLES.get(name), SF_DIR)
    assert ok, message


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["n_nationkey", "n_name", "month", "shipments"] and df.count() > 0
