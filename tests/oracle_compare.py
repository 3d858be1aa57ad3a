"""Run a registered query on Spark and its oracle on DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"  # compare floats bit for bit


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0 if EXACT else round(v, 5) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()[:19]
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT"}


def type_mismatches(con, sdf, sql):
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (t, duck_types.get(c)) for c, t in sdf.dtypes
            if SPARK_TO_DUCK.get(t, t) != duck_types.get(c)}


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return res
    bad_types = type_mismatches(con, sdf, sql)
    if bad_types:
        res["status"] = f"TYPES {bad_types}"
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a == b:
        res["status"] = "ok"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"VALUES len {len(a)} vs {len(b)} first diffs {diff}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    pats = argv[2:]
    from contrail.session import local_session
    import __spark_entry__ as E

    spark = local_session()
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            r = compare(spark, con, name, fn, orc.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"done: {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
