"""Run registered Spark queries and their DuckDB oracle side by side.

    python tests/oracle_compare.py [sf_dir] [name ...]

Compares row count, column names, and sorted rows (values normalized the same
way on both sides). Used by tests and for local iteration.
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 if not isinstance(x, tuple) else (False, "tuple", str(x)) for x in row)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = [tuple(_norm(x) for x in r) for r in cur.fetchall()]
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS differ: spark={s_cols} oracle={d_cols}"
        return res
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    ss, dd = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    if ss == dd:
        res["status"] = "MATCH"
    else:
        diffs = [(a, b) for a, b in zip(ss, dd) if a != b][:3]
        res["status"] = "VALUES differ"
        res["first_diffs"] = diffs
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from peerguard.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, ors = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, con, name, qs[name], ors.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        if r["status"] not in ("MATCH", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"non-matching: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
