"""Compare registered queries with their SQL twins in DuckDB (same rule as the project driver)."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            files = f"{path}/*.parquet" if os.path.isdir(path) else path
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{files}'")
    return con


def _plain(v: object) -> str:
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.9g}" if v else "0"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    if isinstance(v, int):
        return f"{float(v):.9g}" if v else "0"
    return str(v)


def rows(columns: list[str], data: list[tuple]) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(_plain(r[k]) for k in order) for r in data)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    result = con.execute(sql)
    want = rows([d[0] for d in result.description], result.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if want[0] != got[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(want[1]) != len(got[1]):
        return f"{len(got[1])} rows, SQL has {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main(folder: str, names: list[str]) -> int:
    from shelfcount.session import build_session
    from shelfcount_checks.catalog import ORACLES, QUERIES

    settings = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    settings.update(pair.split("=", 1) for pair in os.environ.get("COMPARE_CONF", "").split() if pair)
    spark = build_session("compare", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, query in QUERIES.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if os.environ.get("COMPARE_ROWS"):
                print(f"{con.execute(f'SELECT count(*) FROM ({ORACLES[name]})').fetchone()[0] if name in ORACLES else '?':>9} rows", end=" ")
            if name in ORACLES:
                problem = difference(df, con, ORACLES[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report every query, whatever one of them does
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:5.1f}s {name} {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
