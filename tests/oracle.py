"""Compare registered queries with their DuckDB oracles.

Run as a script: ``python tests/oracle.py [SF_DIR] [NAME_PREFIX ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marlspike.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in v.items()) + "}"
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf_dir):
    """Return (ok, message) for one query."""
    df = fn(spark, sf_dir)
    got = [r.asDict(False) for r in df.collect()]
    got_rows = rows_of(df.columns, [[r[c] for c in df.columns] for r in got])
    if sql is None:
        return True, f"{len(got)} rows, no oracle"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_rows = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {d[0]: str(d[1]) for d in cur.description}
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    bad = {c: (t, types[c]) for c, t in df.dtypes if t in pairs and pairs[t] != types[c]}
    if len(got_rows) != len(want_rows):
        return False, f"{len(got_rows)} rows, oracle {len(want_rows)}"
    if got_rows != want_rows:
        diff = [(a, b) for a, b in zip(got_rows, want_rows) if a != b]
        return False, f"{len(diff)} of {len(got_rows)} rows differ, first {diff[0]}"
    if bad:
        return False, f"types differ {bad}"
    return True, f"{len(got)} rows"


def main() -> int:
    import __spark_entry__ as entry
    from marlspike.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session("oracle")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = duck(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            ok, message = compare(spark, con, fn, oracles.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, message = False, f"{type(e).__name__}: {str(e)[:1500]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - start:6.2f}s {message}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)
