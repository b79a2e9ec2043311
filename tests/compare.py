"""Run registered queries next to their oracle SQL: python tests/compare.py [--sf 0.01] [key ...]."""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(d: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "~null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def kinds(types):
    short = {"bigint": "long", "timestamp": "timestamp_ntz", "integer": "int", "varchar": "string", "boolean": "bool"}
    return [short.get(t.lower(), t.lower()) for t in types]


def compare(spark, con, d, fn, sql):
    """(message or None, rows, seconds)."""
    start = time.time()
    df = fn(spark, d)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return None, len(got), took
    rel = con.execute(sql)
    want_cols = [c[0] for c in rel.description]
    want_types = dict(zip(want_cols, kinds([str(c[1]) for c in rel.description])))
    want = rel.fetchall()
    gc, g = rows_of(df.columns, got)
    wc, w = rows_of(want_cols, want)
    if gc != wc:
        return f"columns {gc} != {wc}", len(got), took
    if len(g) != len(w):
        return f"rows {len(g)} != {len(w)}", len(got), took
    have = {c: {"bigint": "long"}.get(t, t) for c, t in df.dtypes}
    diff_types = {c: (have[c], want_types[c]) for c in gc if have[c] != want_types[c]}
    bad = [(a, b) for a, b in zip(g, w) if a != b]
    if bad:
        return f"{len(bad)} rows differ, e.g. {bad[0]} types {diff_types}", len(got), took
    return (f"types {diff_types}" if diff_types else None), len(got), took


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from __spark_entry__ import oracle_sql, queries

    from cohortforge.session import local_session

    d = f"/root/testdata/sf{a.sf}"
    spark, con = local_session(), connect(d)
    qs, sqls = queries(), oracle_sql()
    failed = []
    for name in [k for k in qs if not a.keys or any(k == x or (x.endswith("*") and k.startswith(x[:-1])) for x in a.keys)]:
        try:
            msg, n, took = compare(spark, con, d, qs[name], sqls.get(name))
        except Exception as err:  # report and go on
            msg, n, took = f"ERROR {type(err).__name__}: {str(err)[:600]}", -1, 0.0
        state = "ok  " if msg is None else "BAD "
        print(f"{state} {name:32s} rows={n:<7d} {took:6.2f}s {'' if name in sqls else '(rows only)'} {msg or ''}", flush=True)
        if msg:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
