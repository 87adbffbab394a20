"""Compare registered queries with their oracles.

    python tests/compare.py [--sf 0.01] [name prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return f"DEC:{v}"
    if isinstance(v, float):
        return "NAN" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, fn, sql):
    """(ok, message, row count) of one query."""
    df = fn(spark, folder)
    rows = df.collect()
    if sql is None:
        return True, "rows only", len(rows)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    a_cols, a = normal(df.columns, [tuple(x) for x in rows])
    b_cols, b = normal(cols, cur.fetchall())
    if a_cols != b_cols:
        return False, f"columns spark-only {set(a_cols) - set(b_cols)} sql-only {set(b_cols) - set(a_cols)}", len(a)
    if len(a) != len(b):
        return False, f"rows {len(a)} vs {len(b)}", len(a)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        x, y = bad[0]
        diff = [(c, p, q) for c, p, q in zip(a_cols, x, y) if p != q]
        return False, f"{len(bad)} rows differ, first {diff[:4]} in {x[:5]}", len(a)
    return True, "match", len(a)


def session(cpus: str = "8"):
    from tidemark.session import build_session

    spark = build_session("compare", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--slow", type=float, default=8.0)
    ap.add_argument("prefix", nargs="*")
    args = ap.parse_args()
    import __spark_entry__ as entry

    folder = f"/root/testdata/sf{args.sf}"
    spark, con = session(), connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not args.prefix or any(n.startswith(p) for p in args.prefix)]
    failed, started = [], time.time()
    for n in names:
        t = time.time()
        try:
            ok, msg, count = compare(spark, con, folder, n, queries[n], oracles.get(n))
        except Exception as e:  # noqa: BLE001
            ok, msg, count = False, f"{type(e).__name__}: {str(e)[:700]}", -1
        took = time.time() - t
        if not ok:
            failed.append(n)
        if not ok or took > args.slow or count == 0 or args.prefix:
            print(f"{'ok ' if ok else 'BAD'} {n} rows={count} {took:.1f}s {msg}", flush=True)
    print(f"{len(names)} queries, {len(failed)} failed, {time.time() - started:.0f}s: {failed}")
    spark.stop()


if __name__ == "__main__":
    main()
