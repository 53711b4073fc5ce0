"""Run the queries next to their SQL and compare rows, columns and values."""

from __future__ import annotations

import datetime
import decimal
import math
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def kinds(rows, columns):
    out = {}
    for i, c in enumerate(columns):
        out[c] = {type(r[i]).__name__ for r in rows if r[i] is not None}
    return out


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(table, key=lambda r: tuple("" if v is None else str(v) for v in r)), [columns[i] for i in order]


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark, con, folder, fn, sql):
    t0 = time.time()
    df = fn(spark, folder)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - t0
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    a, ca = normal(got, df.columns)
    b, cb = normal(want, names)
    if ca != cb:
        return f"columns {ca} != {cb}", spent, len(a)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}", spent, len(a)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, first: {ca} got {bad[0][0]} want {bad[0][1]}", spent, len(a)
    ka, kb = kinds(got, df.columns), kinds(want, names)
    odd = {c: (ka[c], kb[c]) for c in ka if ka[c] and kb[c] and ka[c] != kb[c]}
    if odd:
        return f"types {odd}", spent, len(a)
    return None, spent, len(a)


def main():
    import os
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry
    from vacancia.session import build_session

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": "/tmp/vacancia-warehouse", "spark.log.level": "ERROR"})
    con = duck(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if only and name not in only:
            continue
        try:
            if name in sqls:
                problem, spent, n = compare(spark, con, folder, fn, sqls[name])
            else:
                t0 = time.time()
                n = fn(spark, folder).count()
                problem, spent = None, time.time() - t0
        except Exception as e:  # noqa: BLE001
            problem, spent, n = f"{type(e).__name__}: {str(e)[:700]}", 0.0, -1
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {n:8d} rows {spent:6.2f}s {problem or ''}", flush=True)
    print(f"{len(queries)} queries, {bad} failing")


if __name__ == "__main__":
    main()
