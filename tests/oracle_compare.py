"""Run registered Spark queries against their DuckDB oracle (strict compare)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

from paylens.sources.tables import DRIVER_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return ("f", repr(float(v)))
    if isinstance(v, decimal.Decimal):
        return ("d", str(v.normalize()) if v == v else None)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    return ("s", str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], [cols[i] for i in order]


def compare(spark, sf_dir, names=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, sql = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in sdf.collect()]
        scols = sdf.columns
        t1 = time.time()
        if name not in sql:
            results[name] = ("rows-only", len(srows))
            if verbose:
                print(f"{name:28s} rows-only rows={len(srows)} spark={t1 - t0:.2f}s", flush=True)
            continue
        cur = con.execute(sql[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        a, ac = rows_of(scols, srows)
        b, bc = rows_of(dcols, drows)
        ok = ac == bc and len(a) == len(b) and sorted(a, key=repr) == sorted(b, key=repr)
        results[name] = ("ok" if ok else "MISMATCH", len(srows), len(drows))
        if verbose:
            print(f"{name:28s} {'ok' if ok else 'MISMATCH'} rows={len(srows)}/{len(drows)} "
                  f"spark={t1 - t0:.2f}s", flush=True)
            if not ok:
                if ac != bc:
                    print("   cols spark:", ac, "\n   cols duck: ", bc)
                sa, sb = set(a), set(b)
                print("   spark-only:", sorted(sa - sb, key=repr)[:3])
                print("   duck-only: ", sorted(sb - sa, key=repr)[:3])
    return results


if __name__ == "__main__":
    from paylens.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session(master="local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("MISMATCHES:", bad)
