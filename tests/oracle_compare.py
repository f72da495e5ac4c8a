"""Run registered queries and their DuckDB oracles side by side.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)          # bit-exact: the KPIs use exact integer partials
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
                 "string": "VARCHAR", "boolean": "BOOLEAN", "smallint": "SMALLINT"}


def compare(spark, con, name, qfn, sql, sf_dir):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    s_cols = sdf.columns
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    t2 = time.time()
    msg = []
    if sorted(s_cols) != sorted(d_cols):
        msg.append(f"columns differ: spark={s_cols} duck={d_cols}")
        return False, "; ".join(msg), t1 - t0, t2 - t1
    order = sorted(s_cols)
    s_types = dict(sdf.dtypes)
    d_types = dict(zip(d_cols, [str(d[1]) for d in rel.description]))
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    bad_types = [(c, s_types[c], duck_types.get(c)) for c in order
                 if SPARK_TO_DUCK.get(s_types[c], s_types[c]) != duck_types.get(c)]
    if bad_types:
        msg.append(f"types differ: {bad_types}")
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_n = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    d_n = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    ok = not bad_types
    if len(s_n) != len(d_n):
        ok = False
        msg.append(f"rows spark={len(s_n)} duck={len(d_n)}")
    if s_n != d_n:
        ok = False
        diffs = 0
        for a, b in zip(s_n, d_n):
            if a != b:
                diffs += 1
                if diffs <= 3:
                    bad = [(order[i], a[i], b[i]) for i in range(len(a)) if a[i] != b[i]]
                    msg.append(f"diff {bad}")
        msg.append(f"{diffs} differing rows")
    return ok, "; ".join(msg) + f" types={[(c, s_types[c], d_types[c]) for c in order]}" if not ok else "", t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from tidewatch.session import get_session

    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"{name:28s} ROWS-ONLY rows={df.count()}")
            continue
        try:
            ok, msg, ts, td = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg, ts, td = False, f"ERROR {type(e).__name__}: {str(e)[:600]}", 0, 0
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} spark={ts:5.2f}s duck={td:5.2f}s {msg}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
