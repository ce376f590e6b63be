"""Run catalog queries beside their SQL counterparts and compare every value.

``python -m tests.compare [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
DEFAULT_FOLDER = "/root/testdata/sf0.01"


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _value(cell: object) -> tuple:
    """A cell in a form that sorts and compares across engines."""
    if cell is None or (isinstance(cell, float) and math.isnan(cell)):
        return (0, "")
    if isinstance(cell, float):
        return (1, round(cell, 6) + 0.0)
    if isinstance(cell, int):
        return (1, cell)
    return (2, str(cell))


def _sorted_rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


def compare(spark: SparkSession, con, name: str, folder: str) -> str | None:
    """What differs between query and SQL, or ``None``."""
    df = queries()[name](spark, folder)
    found = [tuple(row) for row in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        return None if found else "no rows"
    result = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in result.description}
    wanted = result.fetchall()
    ours = {column: SQL_TYPES.get(kind, kind) for column, kind in df.dtypes}
    if ours != kinds:
        return f"columns {ours} against {kinds}"
    if len(found) != len(wanted):
        return f"{len(found)} rows against {len(wanted)}"
    left, right = _sorted_rows(df.columns, found), _sorted_rows(list(kinds), wanted)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(folder: str, names: list[str]) -> int:
    from ratewise.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    failed = 0
    for name in names or queries():
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:  # one broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "sql" if name in oracle_sql() else "rows"
        print(f"{name:22} {kind:5} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    place = args.pop(0) if args and "/" in args[0] else DEFAULT_FOLDER
    sys.exit(bool(main(place, args)))
