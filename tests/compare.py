"""Compare registered queries with their SQL in DuckDB.

    python tests/compare.py [data folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return (type(v).__name__, v) if isinstance(v, bool) else repr(v) if isinstance(v, str) else str(v)


def _canon(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = _canon(want_columns, result.fetchall())
    if sorted(spark_df.columns) != sorted(want_columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(want_columns)}"
    got = _canon(spark_df.columns, spark_df.collect())
    if got == want:
        return None
    names = sorted(want_columns)
    extra, lacking = list((got - want).items())[:2], list((want - got).items())[:2]
    return f"rows {sum(got.values())} vs {sum(want.values())}\n  cols {names}\n  spark {extra}\n  sql   {lacking}"


def main(argv: list[str]) -> int:
    import __spark_entry__ as e
    from touchline.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(folder), []
    for name, fn in e.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            sql = e.oracle_sql().get(name)
            if sql:
                problem = difference(fn(spark, folder), con, sql)
            else:
                problem = None if fn(spark, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s", flush=True)
        if problem:
            failed.append(name)
            print("  " + problem[:1800], flush=True)
    print(f"{len(failed)} failed: {failed}")
    spark.stop()
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
