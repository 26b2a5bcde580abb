"""Registry pairing each named query with its DuckDB oracle."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, sf_dir)`` under ``name``, with its oracle SQL if there is one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = textwrap.dedent(oracle).strip()
        return fn

    return add
