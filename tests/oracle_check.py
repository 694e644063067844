"""Compare registered Spark queries with their DuckDB oracle statements.

Mirrors the driver's gate: row count, column names, order-insensitive hash
of the values (doubles rounded).  Usable from tests and as a script:
``python tests/oracle_check.py /root/testdata/sf0.01 [key ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if v != v:
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, pd.Timestamp):
        return v.date().isoformat() if v == v.normalize() else v.isoformat()
    if isinstance(v, (dt.datetime,)):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def digest(rows: list[tuple], cols: list[str]) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), h


def spark_rows(df) -> tuple[list[tuple], list[str]]:
    cols = df.columns
    return [tuple(r) for r in df.collect()], cols


def duck_rows(con, sql) -> tuple[list[tuple], list[str]]:
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return [tuple(r) for r in res.fetchall()], cols


def compare(spark, con, key: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    srows, scols = spark_rows(fn(spark, sf_dir))
    t1 = time.time()
    drows, dcols = duck_rows(con, sql)
    t2 = time.time()
    out = {"key": key, "spark_rows": len(srows), "oracle_rows": len(drows),
           "columns_match": sorted(scols) == sorted(dcols), "spark_s": round(t1 - t0, 2),
           "oracle_s": round(t2 - t1, 2)}
    if out["columns_match"]:
        out["hash_match"] = digest(srows, scols) == digest(drows, dcols)
    else:
        out["hash_match"] = False
        out["spark_cols"] = scols
        out["oracle_cols"] = dcols
    out["ok"] = out["columns_match"] and out["hash_match"] and len(srows) == len(drows)
    return out


def main(argv: list[str]) -> int:
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from rxlens.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(E.queries())
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, qs[k], sqls[k], sf_dir)
        except Exception as e:  # report and continue
            r = {"key": k, "ok": False, "error": repr(e)[:800]}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
