"""Compare registered queries with their DuckDB SQL, value by value.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _cell(value: object) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return repr(value)
    return str(value)


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    df = query(spark, sf_dir)
    got_names, got = df.columns, [tuple(row) for row in df.collect()]
    result = connection.execute(sql)
    want_names, want = [d[0] for d in result.description], result.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} / {sorted(want_names)}"
    got, want = rows_of(got_names, got), rows_of(want_names, want)
    if got == want:
        return None if got else "no rows"
    extra = [row for row in got if row not in set(want)][:3]
    missing = [row for row in want if row not in set(got)][:3]
    return f"rows {len(got)} / {len(want)}\n  {sorted(got_names)}\n  only Spark {extra}\n  only SQL   {missing}"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from skybasin.session import local_session

    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:] or list(oracle_sql())
    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(directory)
    bad = 0
    for name in chosen:
        started = time.time()
        try:
            found = difference(session, duck, queries()[name], oracle_sql()[name], directory)
        except Exception as error:  # noqa: BLE001 - a report over all queries
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {'ok' if found is None else found}", flush=True)
    print(f"{bad} of {len(chosen)} differ")
