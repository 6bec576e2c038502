"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: status, rows, and the first difference.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()[:10] if isinstance(v, dt.date) and not isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return round(float(v), 6)
    if isinstance(v, bool):
        return int(v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from __spark_entry__ import oracle_sql, queries
    from churnlake.session import local_session

    spark = local_session(8, 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"SPARK-ERROR {name}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS-ONLY {name}: rows={len(s_rows)} cols={s_cols} {ts:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            d_cols = [d[0] for d in res.description]
            d_rows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"SQL-ERROR {name}: {str(e)[:400]}")
            bad += 1
            continue
        if sorted(s_cols) != sorted(d_cols):
            print(f"COLS {name}: spark={s_cols} sql={d_cols}")
            bad += 1
            continue
        a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
        if a == b:
            print(f"OK {name}: rows={len(a)} {ts:.1f}s")
        else:
            bad += 1
            diff = next(((x, y) for x, y in zip(a, b) if x != y), None)
            print(f"DIFF {name}: spark_rows={len(a)} sql_rows={len(b)} first={diff} cols={sorted(s_cols)}")
    print(f"failures: {bad}")


if __name__ == "__main__":
    main()
