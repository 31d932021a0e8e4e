"""Compares queries with their SQL: ``python tests/oracle.py [sf_dir] [name...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    return round(value, 9) if isinstance(value, float) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, fn, sql, sf_dir):
    """Empty text when both agree, else what differs."""
    df = fn(spark, sf_dir)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = _rows([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} vs {theirs[0]}"
    if not mine[1]:
        return "no rows"
    if mine[1] != theirs[1]:
        a, b = set(map(repr, mine[1])), set(map(repr, theirs[1]))
        return f"{len(mine[1])} vs {len(theirs[1])} rows; ours {sorted(a - b)[:2]}; sql {sorted(b - a)[:2]}"
    return ""


if __name__ == "__main__":
    from shelfspark.bindings import all_oracles, all_queries
    from shelfspark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = all_oracles()
    for name, fn in all_queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, fn, oracles[name], sf_dir) if name in oracles else f"rows only: {fn(spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            verdict = "ERROR " + " ".join(str(error).split())[:600]
        print(f"{name:28s} {time.time() - start:6.1f}s {verdict[:1500] or 'match'}", flush=True)
