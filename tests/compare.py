"""Runs every named query against its SQL oracle on one scale and reports differences."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _norm(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~null"
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, bool):
        return str(value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [names[i] for i in order]


def difference(df, con, sql: str) -> str | None:
    """None where both sides hold the same rows under the same column names."""
    got, got_names = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_names = [d[0] for d in rel.description]
    want, want_sorted = _rows(want_names, rel.fetchall())
    if got_names != want_sorted:
        return f"columns {got_names} != {want_sorted}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference: {a} != {b}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from clickpulse.session import build_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = query(spark, sf_dir)
            n = df.count()
            t1 = time.time()
            verdict = difference(df, con, oracles[name]) if name in oracles else "no oracle"
        except Exception as exc:  # report and go on with the next query
            n, t1, verdict = -1, time.time(), f"{type(exc).__name__}: {str(exc)[:1500]}"
        print(f"{name:28s} rows={n:8d} {t1 - t0:6.2f}s {'OK' if verdict is None else verdict}", flush=True)
