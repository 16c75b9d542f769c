"""Run registered queries against their DuckDB oracle the way the driver
does: row count, column names, order-insensitive multiset of values.

    python tests/oracle_harness.py [sf_dir] [query ...]
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return repr(v)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir, verbose=True):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in sdf.select(*cols).collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    dcols = list(rel.columns)
    res["cols_equal"] = sorted(dcols) == cols
    if not res["cols_equal"]:
        res["status"] = f"COLS spark={cols} duck={sorted(dcols)}"
        return res
    stypes = dict(sdf.dtypes)
    dtypes = dict(zip(dcols, [str(t) for t in rel.types]))
    tmap = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE"}
    tdiff = {c: (stypes[c], dtypes[c]) for c in cols if tmap.get(stypes[c], stypes[c]) != dtypes[c]}
    if tdiff:
        res["type_diff"] = tdiff
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    res["duck_rows"] = len(drows)
    a, b = collections.Counter(srows), collections.Counter(drows)
    if a == b:
        res["status"] = "MATCH" if not tdiff else "MATCH-TYPES"
    else:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        res["status"] = "DIFF"
        res["n_diff"] = sum((a - b).values()) + sum((b - a).values())
        if verbose:
            res["only_spark"] = only_s
            res["only_duck"] = only_d
            res["cols"] = cols
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from tickflow.session import local_session
    tz = os.environ.get("ORACLE_TZ")
    spark = local_session(extra={"spark.sql.session.timeZone": tz} if tz else None)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("MATCH", "rows-only")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
