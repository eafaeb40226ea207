"""Compare queries with their check SQL: columns, types, rows and values.

    python tests/check_oracle.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(table) -> list[tuple]:
    columns = sorted(table.column_names)
    rows = zip(*[table[c].to_pylist() for c in columns]) if table.num_rows else []
    return sorted((tuple(_norm(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, con, folder: str, job, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    got, want = job(spark, folder).toArrow(), con.execute(sql).to_arrow_table()
    kinds = lambda t: {f.name: str(f.type).replace("large_string", "string") for f in t.schema}
    if kinds(got) != kinds(want):
        return f"schema {sorted(set(kinds(got).items()) ^ set(kinds(want).items()))}"
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} != {want.num_rows}"
    for mine, theirs in zip(_rows(got), _rows(want)):
        if mine != theirs:
            return f"value {sorted(got.column_names)} {mine} != {theirs}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, bad = local_session("check"), connect(folder), 0
    oracle = oracle_sql()
    for name, job in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, folder, job, oracle[name])
            else:
                problem = None if job(spark, folder).count() >= 0 else "no rows"
        except Exception as error:  # a report tool: show every failure
            problem = f"{type(error).__name__} {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
