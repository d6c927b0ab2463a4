"""Run registered queries in Spark and their oracle SQL in DuckDB, compare results.

usage: python tests/oracle_harness.py [sf_dir] [key-substring ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickframe.sources.tables import BASE_TABLES  # noqa: E402


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(timespec="microseconds") if isinstance(v, dt.datetime) else str(v)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in records:
        out.append(tuple(norm(r[i]) for i in order))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def close(a, b):
    if len(a) != len(b):
        return False
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float) and isinstance(y, (float, int)):
                if not math.isclose(x, float(y), rel_tol=1e-9, abs_tol=1e-9):
                    return False
            elif x != y:
                if isinstance(x, int) and isinstance(y, float) and x == y:
                    continue
                return False
    return True


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = list(sdf.columns)
    srows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t0
    if sql is None:
        return dict(key=key, rows=len(srows), oracle=None, secs=round(ts, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    return dict(key=key, rows=len(srows), orows=len(drows),
                cols=sorted(scols) == sorted(dcols), exact=(a == b), close=close(a, b),
                secs=round(ts, 2), scols=scols if sorted(scols) != sorted(dcols) else None,
                dcols=dcols if sorted(scols) != sorted(dcols) else None,
                sample=(a[:2], b[:2]) if a != b else None)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    pats = argv[2:]
    from tickframe.plans import catalog
    from tickframe.session import build_session
    spark = build_session(partitions=8)
    con = duck(sf_dir)
    qs, os_ = catalog.queries(), catalog.oracle_sql()
    bad = 0
    for k in sorted(qs):
        if pats and not any(p in k for p in pats):
            continue
        try:
            r = compare(spark, con, k, qs[k], os_.get(k), sf_dir)
        except Exception as e:  # report and continue
            r = dict(key=k, error=repr(e)[:600])
        ok = r.get("oracle", 1) is None or (r.get("exact") and r.get("cols") and r.get("rows") == r.get("orows"))
        if not ok:
            bad += 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(qs)} queries, {len(os_)} with oracle, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
