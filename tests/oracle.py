"""Compare every query with its SQL counterpart in DuckDB: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return repr(v + 0.0) if isinstance(v, float) else repr(v)

    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf, name, query, sql):
    started = time.time()
    df = query(spark, sf)
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    result = con.execute(sql)
    want = bag([c[0] for c in result.description], result.fetchall())
    return got, want, took


if __name__ == "__main__":
    import __spark_entry__ as entry
    from cyclemill.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = local_session(8), connect(sf)
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        sql = entry.oracle_sql().get(name)
        try:
            if sql is None:
                started = time.time()
                n = len(entry.queries()[name](spark, sf).collect())
                print(f"rows {name} {n} {time.time() - started:.2f}s", flush=True)
                continue
            got, want, took = compare(spark, con, sf, name, entry.queries()[name], sql)
            print(f"{'ok  ' if got == want else 'DIFF'} {name} {len(got[1])}/{len(want[1])} {took:.2f}s", flush=True)
            if got != want:
                print("   ", got[0], want[0])
                bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w][:2]
                print("   ", *bad, sep="\n    ")
        except Exception as e:
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:600]}", flush=True)
