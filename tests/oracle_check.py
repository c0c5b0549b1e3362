"""Compares every registered query with its SQL counterpart.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None:
        return "\0"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    spark_types = {type(v) for row in df.limit(50).collect() for v in row if v is not None}
    if not spark_types <= {str, int, float, bool}:
        return f"types {spark_types}"
    got, want = _rows(df.columns, df.collect()), _rows(columns, expected)
    if got == want:
        return None
    only_got = [r for r in got if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(got)][:3]
    return f"rows {len(got)} != {len(want)}\n   columns {sorted(columns)}\n   only here {only_got}\n   only sql  {only_want}"


def main() -> int:
    import __spark_entry__ as entry
    from feedmark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con, sqls = local_session(), connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name in names:
        started = time.time()
        try:
            fault = compare(entry.queries()[name](spark, sf_dir), con, sqls[name]) if name in sqls else "no sql"
        except Exception as error:  # report and go on
            fault = f"{type(error).__name__}: {str(error)[:500]}"
        bad += fault is not None
        print(f"{name:28s} {time.time() - started:6.1f}s  {fault or 'ok'}", flush=True)
    print(f"{bad} of {len(names)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
