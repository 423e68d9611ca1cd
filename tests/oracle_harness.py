"""Run catalogue queries in Spark and their SQL oracle in DuckDB, and compare.

Mirrors the driver's check: same row count, same column names, and the same multiset
of rows once columns are put in name order. Usable from pytest and as a script:

    python tests/oracle_harness.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    return sorted((tuple(_norm(v) for v in row) for row in df[cols].itertuples(index=False, name=None)),
                  key=repr)


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con=None) -> dict:
    t0 = time.time()
    got = query(spark, sf_dir).toPandas()
    t1 = time.time()
    out = {"query": name, "rows": len(got), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    exp = con.execute(sql).df()
    out["oracle_rows"] = len(exp)
    if sorted(got.columns) != sorted(exp.columns):
        out["status"] = f"columns differ: {sorted(got.columns)} vs {sorted(exp.columns)}"
        return out
    if len(got) != len(exp):
        out["status"] = "row count differs"
        return out
    a, b = _rows(got), _rows(exp)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["status"] = f"values differ, e.g. {diff}"
        return out
    out["status"] = "match"
    return out


def main(argv: list[str]) -> int:
    from hamper.session import local_session
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = local_session(8, shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, qs[n], sqls.get(n), con)
        except Exception as e:  # report and go on
            r = {"query": n, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
