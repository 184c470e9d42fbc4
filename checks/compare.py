"""Run queries next to their SQL and compare rows, columns and values (order-insensitive)."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(x: object) -> str:
    if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
        return "~"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        return repr(round(x, 6) + 0.0)
    return f"{type(x).__name__}:{x}"


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted("|".join(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[str, float]:
    start = time.time()
    df = fn(spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    rel = con.execute(sql)
    want = canonical([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return f"columns {sorted(set(got[0]) ^ set(want[0]))}", took
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} vs {len(want[1])}", took
    if got[1] != want[1]:
        a, b = next((x, y) for x, y in zip(got[1], want[1]) if x != y)
        return f"values\n   spark {a[:600]}\n   sql   {b[:600]}", took
    return f"ok {len(got[1])}", took


def main(sf_dir: str, names: list[str]) -> int:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES
    from promolens.session import local_session

    spark = local_session("checks")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or list(QUERIES):
        if name not in ORACLES:
            print(f"{name:26s} no SQL")
            continue
        try:
            result, took = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            result, took = f"error {type(error).__name__}: {str(error)[:700]}", 0.0
        bad += not result.startswith("ok")
        print(f"{name:26s} {took:6.1f}s {result}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
