"""Differential check: every registered query against its DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Runs each Spark query and its SQL on the same parquet tables, then compares
row counts, column names and the multiset of rows (floats rounded to 6
decimals). Prints one line per query and exits non-zero on any mismatch.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from threadsift.plans import registry  # noqa: E402
from threadsift.plans.tables import TABLES  # noqa: E402

DEFAULT_DIR = "/root/testdata/sf0.01"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    return str(v) if not isinstance(v, str) else v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t)), sorted(cols)


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_cols = df.columns
    sql = registry.ORACLE_SQL.get(name)
    if sql is None:
        return "rows-only", len(s_rows), None
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    a, ac = _rows(s_cols, s_rows)
    b, bc = _rows(d_cols, d_rows)
    if ac != bc:
        return "COLUMNS", len(s_rows), f"spark={ac} duck={bc}"
    if len(a) != len(b):
        return "ROWCOUNT", len(s_rows), f"spark={len(a)} duck={len(b)}"
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return "VALUES", len(s_rows), repr(diff)[:600]
    return "ok", len(s_rows), None


def main(argv):
    from threadsift.session import local_session

    sf_dir = DEFAULT_DIR
    names = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            names.append(a)
    registry.load_all()
    names = names or list(registry.QUERIES)
    spark = local_session(8)
    con = duck_connection(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            status, n, detail = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and continue
            status, n, detail = "ERROR", -1, f"{type(e).__name__}: {str(e)[:800]}"
        bad += status not in ("ok", "rows-only")
        print(f"{name:32s} {status:9s} rows={n:<7d} {time.time() - t0:6.1f}s {detail or ''}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
