"""Run registered queries in Spark and their oracle SQL in DuckDB; compare like the driver.

usage: python tests/oracle_check.py [sf_dir] [key ...]
Reports row count, column names, column types and an order-insensitive value comparison.
"""
from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from marketlens.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

_SPARK2DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
               "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}


def norm(v):
    if isinstance(v, float):
        return ("f", round(v, 9))
    if isinstance(v, decimal.Decimal):
        return ("d", v.normalize() if v == v else v)
    if isinstance(v, datetime.datetime):
        return ("t", v.isoformat())
    if isinstance(v, datetime.date):
        return ("dt", v.isoformat())
    return ("o", v)


def key_of(row):
    return tuple((x[0], str(x[1])) for x in row)


def compare(spark, con, sf_dir, key, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    names = df.columns
    stypes = [f.dataType.simpleString() for f in df.schema.fields]
    srows = df.collect()
    t1 = time.time()
    res = con.execute(sql)
    dnames = [d[0] for d in res.description]
    drows = res.fetchall()
    dtypes = [str(t) for t in con.execute(f"DESCRIBE {sql}").fetchall()] if False else None
    t2 = time.time()
    problems = []
    if sorted(names) != sorted(dnames):
        problems.append(f"columns differ: spark-only={sorted(set(names)-set(dnames))} duck-only={sorted(set(dnames)-set(names))}")
    if len(srows) != len(drows):
        problems.append(f"rows {len(srows)} vs {len(drows)}")
    if not problems:
        order = sorted(range(len(names)), key=lambda i: names[i])
        dorder = [dnames.index(names[i]) for i in order]
        a = sorted((tuple(norm(r[i]) for i in order) for r in srows), key=key_of)
        b = sorted((tuple(norm(r[i]) for i in dorder) for r in drows), key=key_of)
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        if bad:
            cols = [names[i] for i in order]
            x, y = bad[0]
            diff = [(cols[i], x[i], y[i]) for i in range(len(cols)) if x[i] != y[i]]
            problems.append(f"{len(bad)} rows differ; first: {diff[:6]}")
    # type check
    dt = con.execute(f"SELECT * FROM ({sql}) LIMIT 0").description
    dtypes = {d[0]: str(d[1]) for d in dt}
    tmis = []
    for n, st in zip(names, stypes):
        want = _SPARK2DUCK.get(st, st.upper())
        got = dtypes.get(n, "?")
        if want.replace(" ", "") != got.replace(" ", "") and not (want.startswith("DECIMAL") and got.startswith("DECIMAL") and want.split(",")[1] == got.split(",")[1]):
            tmis.append(f"{n}:{st}/{got}")
    status = "OK " if not problems else "BAD"
    print(f"{status} {key:40s} rows={len(srows):6d} spark={t1-t0:5.1f}s duck={t2-t1:4.1f}s "
          + ("; ".join(problems)) + (f" TYPES {tmis}" if tmis else ""), flush=True)
    return not problems


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    keys = args or list(qs)
    ok = 0
    for k in keys:
        if k not in sqls:
            df = qs[k](spark, sf_dir)
            print(f"--- {k:40s} rows={df.count()} (no oracle)")
            continue
        try:
            ok += compare(spark, con, sf_dir, k, qs[k], sqls[k])
        except Exception as e:  # noqa: BLE001
            print(f"ERR {k:40s} {type(e).__name__}: {str(e)[:400]}", flush=True)
    print(f"{ok}/{len([k for k in keys if k in sqls])} oracle matches")


if __name__ == "__main__":
    main()
