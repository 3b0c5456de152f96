"""Compare registered queries with their SQL on DuckDB.

Run as a script for a report: ``python tests/oracle.py [--sf DIR] [name ...]``.
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """``None`` when equal, else what differs."""
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_names, want = _rows([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference:\n  got  {g}\n  want {w}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    for name, kind in df.dtypes:
        same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}.get(kind)
        if same and kinds[name] != same:
            return f"type of {name}: {kind} != {kinds[name]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from farebox.session import build_session
    from farebox.sources.scratch import clear_scratch

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    todo, sql = queries(), oracle_sql()
    bad = 0
    for name, query in todo.items():
        if args.names and name not in args.names:
            continue
        started = time.perf_counter()
        try:
            df = query(spark, args.sf)
            if name in sql:
                problem = compare(df, con, sql[name])
                verdict = problem or "ok"
            else:
                problem, verdict = None, f"rows only: {df.count()}"
        except Exception as e:  # report and go on with the next query
            problem = verdict = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'pass'} {time.perf_counter() - started:6.2f}s {name}: {verdict}", flush=True)
    clear_scratch(spark)
    print(f"{bad} failed of {len(args.names) or len(todo)}")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
