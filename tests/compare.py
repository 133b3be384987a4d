"""Runs registered queries and their SQL side by side and compares the rows.

``python tests/compare.py DIR [NAME ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from windrow.plans import ORACLES, QUERIES  # noqa: E402
from windrow.plans.inputs import TABLES  # noqa: E402


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _cell(value: object) -> object:
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, connection, name: str, sf_dir: str) -> str:
    """Empty when the query's rows, names and types agree with its SQL."""
    result = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in result.collect()]
    relation = connection.sql(ORACLES[name])
    want, want_columns = relation.fetchall(), relation.columns
    if sorted(result.columns) != sorted(want_columns):
        return f"columns {sorted(result.columns)} want {sorted(want_columns)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    have = {c: kinds.get(t, t) for c, t in result.dtypes}
    types = {c: str(t) for c, t in zip(want_columns, relation.types)}
    if have != types:
        return f"types {[(c, have[c], types[c]) for c in have if have[c] != types[c]]}"
    a, b = rows_of(result.columns, got), rows_of(want_columns, want)
    if len(a) != len(b):
        return f"{len(a)} rows, want {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def main() -> None:
    from windrow.session import open_session

    spark = open_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    connection, failed = database(sf_dir), []
    for name in names:
        start = time.time()
        try:
            result = difference(spark, connection, name, sf_dir)
        except Exception as error:  # shown, not hidden: the run goes on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not result else 'FAIL'} {name} {time.time() - start:.2f}s {result}", flush=True)
        if result:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")


if __name__ == "__main__":
    main()
