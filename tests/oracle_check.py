"""Run queries() against oracle_sql() the way the driver does (row count, schema, value hash).

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def type_mismatches(sdf, con, sql):
    st = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    rel = con.sql(sql)
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return {c: (st[c], dt.get(c)) for c in st if SPARK_TO_DUCK.get(st[c], st[c]) != dt.get(c)}


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    ts = time.time() - t0
    if sql is None:
        return dict(name=name, status="rows-only", rows=len(srows), spark_s=round(ts, 2))
    t0 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    td = time.time() - t0
    ok_cols = sorted(scols) == sorted(dcols)
    hs, ls = digest(scols, srows)
    hd, ld = digest(dcols, drows)
    types = type_mismatches(sdf, con, sql)
    status = "ok" if ok_cols and hs == hd and not types else "MISMATCH"
    out = dict(name=name, status=status, rows=(len(srows), len(drows)), spark_s=round(ts, 2),
               duck_s=round(td, 2))
    if status != "ok":
        out["cols"] = (scols, dcols)
        out["types"] = types
        out["spark_only"] = sorted(set(ls) - set(ld))[:3]
        out["duck_only"] = sorted(set(ld) - set(ls))[:3]
    return out


def main():
    from skein.session import get_session
    import __spark_entry__ as E

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = get_session(shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            r = compare(spark, name, fn, sqls.get(name), sf_dir, con)
        except Exception as e:  # noqa: BLE001
            r = dict(name=name, status="ERROR", err=str(e)[:600])
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
