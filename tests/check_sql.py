"""Compare registered queries with their SQL twins: python tests/check_sql.py [folder] [name part ...]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from netorigin.plans.tables import GIVEN


def session(name="check"):
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[8]").appName(name).config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    return s


def duck_views(folder):
    c = duckdb.connect()
    c.execute("set threads to 8")
    for t in GIVEN:
        c.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return repr(v)


def compare(df, con, sql):
    """None when equal, else what differs."""
    cols = sorted(df.columns)
    got = df.select(*cols).collect()
    rel = con.sql(sql)
    want_cols = sorted(rel.columns)
    if cols != want_cols:
        return f"columns {cols} <> {want_cols}"
    want = rel.select(*[f'"{c}"' for c in cols]).fetchall()
    a = sorted(tuple(norm(v) for v in r) for r in got)
    b = sorted(tuple(norm(v) for v in r) for r in want)
    if not a:
        return "no rows" if not b else f"0 rows <> {len(b)}"
    if a == b:
        return None
    sa, sb = set(a), set(b)
    return f"rows {len(a)} <> {len(b)}; cols {cols}; only spark {sorted(sa - sb)[:3]}; only sql {sorted(sb - sa)[:3]}"


def main():
    folder, parts = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"), sys.argv[2:]
    import __spark_entry__ as e

    spark, con = session(), duck_views(folder)
    oracles, bad = e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        t = time.time()
        try:
            df = fn(spark, folder)
            r = compare(df, con, oracles[name]) if name in oracles else ("no rows" if not df.count() else None)
        except Exception as x:
            r = f"{type(x).__name__}: {str(x)[:700]}"
        note = "" if name in oracles else " (rows only)"
        print(f"{'ok  ' if r is None else 'FAIL'} {time.time() - t:5.1f}s {name}{note}" + (f"\n     {r}" if r else ""), flush=True)
        bad += r is not None
    print("failures:", bad)


if __name__ == "__main__":
    main()
