"""Compare a registered query with its SQL on DuckDB. Run as a script for a report:

    python -m tests.oracle [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from jobstrata.catalog import REGISTRY

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(shaped, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(spark, con, name: str, sf_dir: str) -> tuple[str | None, int]:
    """None when both sides agree, else what differs; and the number of rows."""
    entry = REGISTRY[name]
    df = entry.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if entry.sql is None:
        return None, len(got)
    con.execute(entry.sql)
    want_columns = [d[0] for d in con.description]
    want = con.fetchall()
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}", len(got)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}", len(got)
    a, b = _sorted_rows(df.columns, got), _sorted_rows(want_columns, want)
    for left, right in zip(a, b):
        same = all(
            type(x) is type(y)
            and (math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6) if isinstance(x, float) else x == y)
            for x, y in zip(left, right)
        )
        if not same:
            return f"spark {left}\n      duck  {right}", len(got)
    return None, len(got)


if __name__ == "__main__":
    from jobstrata.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(sf)
    bad = 0
    for query in sys.argv[2:] or list(REGISTRY):
        start = time.time()
        try:
            problem, n = difference(session, connection, query, sf)
        except Exception as e:  # a report goes on to the next query
            problem, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        took = time.time() - start
        kind = "rows-only" if REGISTRY[query].sql is None else "sql"
        print(f"{'ok ' if problem is None else 'BAD'} {took:6.2f}s {n:7d} {kind:9s} {query}")
        if problem:
            bad += 1
            print("     ", problem)
    print("bad:", bad, "of", len(sys.argv[2:] or REGISTRY))
