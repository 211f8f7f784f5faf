"""Run registered Spark queries against their DuckDB oracle SQL.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of values.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if v != v:
            return None
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    items = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256()
    for it in items:
        h.update(it.encode())
    return h.hexdigest(), items


def compare(spark, con, sf_dir, name, fn, sql, show=5):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = list(sdf.columns)
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    ok_cols = sorted(scols) == sorted(dcols)
    sh, sitems = digest(scols, srows)
    dh, ditems = digest(dcols, drows)
    ok = ok_cols and len(srows) == len(drows) and sh == dh
    print(f"{'OK ' if ok else 'BAD'} {name}: spark {len(srows)} rows {t1 - t0:.2f}s | duck {len(drows)} rows "
          f"{t2 - t1:.2f}s", flush=True)
    if not ok:
        if not ok_cols:
            print("   cols spark", sorted(scols), "\n   cols duck ", sorted(dcols))
        ss, ds = set(sitems), set(ditems)
        for x in list(ss - ds)[:show]:
            print("   spark only:", x[:400])
        for x in list(ds - ss)[:show]:
            print("   duck only: ", x[:400])
    return ok


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not os.path.isdir(a)]
    import __spark_entry__ as E
    from pricelake.session import get_spark
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = []
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in os_:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"--  {name}: rows-only {n} rows {time.time() - t0:.2f}s")
            continue
        try:
            if not compare(spark, con, sf_dir, name, fn, os_[name]):
                bad.append(name)
        except Exception as e:  # report and go on
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:800]}")
            bad.append(name)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
