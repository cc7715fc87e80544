"""Run registered queries and their SQL side by side: python tests/compare.py [name ...]."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_connection(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (int(v) if v.is_integer() and abs(v) < 1e15 else v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat() + " (date)"
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


def compare(spark, con, sf_dir, fn, sql):
    """None when both sides agree, else a short account of the difference."""
    df = fn(spark, sf_dir)
    cols, got = table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    wcols, want = table([d[0] for d in cur.description], cur.fetchall())
    if cols != wcols:
        return f"columns {cols} != {wcols}"
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return f"rows {len(got)} vs {len(want)}; only spark {sorted(a)[:3]}; only sql {sorted(b)[:3]}"
    return "both empty" if not got else None


def main(names):
    from tidewater.session import local_session

    import __spark_entry__ as entry

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session("compare", cpus=8)
    spark.sparkContext.setLogLevel("OFF")
    con = oracle_connection(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    picked = [q for q in queries if not names or any(q == n or (n.endswith("*") and q.startswith(n[:-1])) for n in names)]
    bad = 0
    for q in picked:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, queries[q], oracle.get(q))
        except Exception as e:  # noqa: BLE001
            problem = "ERROR " + str(e)[:700].replace("\n", " | ")
            if os.environ.get("TRACE"):
                traceback.print_exc()
        took = time.time() - start
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        if problem or took > 6 or os.environ.get("VERBOSE"):
            print(f"{mark} {q} {took:.1f}s {'' if q in oracle else '(no sql)'} {problem or ''}", flush=True)
    print(f"{len(picked)} run, {bad} bad, {sum(q in oracle for q in picked)} with sql")


if __name__ == "__main__":
    main(sys.argv[1:])
