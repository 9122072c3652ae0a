"""Compare every registered query with its DuckDB SQL on the same Parquet tables.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
Prints one line per query: rows, schema and order-insensitive value agreement.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, decimals):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, decimals) + 0.0)
    return repr(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i], 10 if columns[i] == "sim" else 9) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def kinds(columns: list[str], rows: list[tuple]) -> dict[str, set]:
    """Python types of the values of each column, apart from null."""
    return {c: {type(r[i]) for r in rows if r[i] is not None} for i, c in enumerate(columns)}


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    from __spark_entry__ import oracle_sql, queries

    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        res = {"rows_spark": len(s_rows), "spark_sec": round(t1 - t0, 2)}
        if name in sqls:
            rel = con.sql(sqls[name])
            d_cols = rel.columns
            d_rows = rel.fetchall()
            res.update(rows_sql=len(d_rows), sql_sec=round(time.time() - t1, 2),
                       schema=sorted(s_cols) == sorted(d_cols),
                       values=digest(s_cols, s_rows) == digest(d_cols, d_rows) if sorted(s_cols) == sorted(d_cols)
                       else False)
            res["types"] = kinds(s_cols, s_rows) == kinds(d_cols, d_rows)
            res["ok"] = res["schema"] and res["types"] and res["values"] and res["rows_spark"] == res["rows_sql"]
            if not res["schema"]:
                res["cols"] = (s_cols, d_cols)
        out[name] = res
        if verbose:
            print(name, res, flush=True)
    return out


if __name__ == "__main__":
    from tastegraph.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    result = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in result.items() if not v.get("ok", True)]
    print("FAILED:", bad if bad else "none")
    print("WITHOUT SQL:", [k for k, v in result.items() if "ok" not in v] or "none")
