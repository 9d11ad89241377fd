"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

``python tests/compare.py [folder] [name ...]``
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(frame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(None if value != value else value for value in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def differences(spark, connection, folder: str, name: str, may_be_empty: bool = False) -> list[str]:
    """What is wrong with a query; empty if its rows equal those of its SQL."""
    result = contract.queries()[name](spark, folder)
    got = result.toPandas()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return [] if len(got) else ["no rows"]
    expected = connection.sql(sql).df()
    problems = []
    if sorted(got.columns) != sorted(expected.columns):
        return [f"columns {sorted(got.columns)} / {sorted(expected.columns)}"]
    for column in got.columns:
        kinds = got[column].dtype.kind, expected[column].dtype.kind
        sizes = got[column].dtype.itemsize, expected[column].dtype.itemsize
        if len(got) and (kinds[0] != kinds[1] or sizes[0] != sizes[1]):
            problems.append(f"type of {column}: {got[column].dtype} / {expected[column].dtype}")
    left, right = rows_of(got), rows_of(expected)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} / {len(right)}")
    if left != right:
        extra, missing = set(left) - set(right), set(right) - set(left)
        problems.append(f"only spark {sorted(extra, key=repr)[:1]}; only sql {sorted(missing, key=repr)[:1]}")
    if not left and not may_be_empty:
        problems.append("no rows on either side")
    return problems


def main() -> None:
    from conftest import local_session

    arguments = sys.argv[1:]
    folder = arguments.pop(0) if arguments and os.path.isdir(arguments[0]) else "/root/testdata/sf0.01"
    spark, connection = local_session(), duck(folder)
    failed = 0
    for name in arguments or contract.queries():
        started = time.time()
        try:
            problems = differences(spark, connection, folder, name)
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        failed += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '}{name} {time.time() - started:.1f}s", *[p[:900] for p in problems], flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
