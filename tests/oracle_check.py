"""Run registered queries on Spark and their SQL on DuckDB, and compare rows and values.

    python -m tests.oracle_check [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"create view {table} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, Decimal):
        return str(value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str | None:
    """None where both sides agree, a short description otherwise."""
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    expected = _rows(names, relation.fetchall())
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    wrong = [(g, e) for g, e in zip(got, expected, strict=True) if g != e]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first: {wrong[0][0]} != {wrong[0][1]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from marlstone.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "oracle-check", "local[8]", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    failed = 0
    for name in chosen:
        began = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            if sql is None:
                verdict = f"rows only: {df.count()}"
            else:
                verdict = difference(df, connection, sql)
                failed += verdict is not None
                verdict = f"DIFFERS {verdict}" if verdict else "ok"
        except Exception as error:
            failed += 1
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{time.time() - began:6.1f}s {name}: {verdict}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
