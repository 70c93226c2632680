"""Run registered queries and their SQL side by side and compare the rows as multisets.

    python tests/compare.py [names...] [--sf 0.01 | --folder DIR] [--times]
"""

from __future__ import annotations

import argparse
import datetime
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str, files: str = "") -> duckdb.DuckDBPyConnection:
    """Views of the tables; ``files`` is the pattern below a table's path if it is a folder."""
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet{files}')"
        )
    return connection


def plain(value):
    """A value in a form that both engines share. Types stay apart: 1 is not 1.0 or '1'."""
    if isinstance(value, bool) or value is None or isinstance(value, (str, int)):
        return (type(value).__name__, value)
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else value + 0.0)
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return (type(value).__name__, value.isoformat())
    raise TypeError(f"flatten the column: {type(value)}")


def multiset(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), multiset(df.columns, df.collect())


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return sorted(names), multiset(names, result.fetchall())


# Spark's names of the types that results are made of, and DuckDB's.
TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def type_differences(connection, df, sql: str) -> dict:
    """Columns whose types differ: name to (Spark, DuckDB)."""
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    theirs = {row[0]: str(row[1]) for row in described}
    ours = {name: TYPE_NAMES.get(kind, kind) for name, kind in df.dtypes}
    return {n: (ours.get(n), theirs.get(n)) for n in ours | theirs if ours.get(n) != theirs.get(n)}


def difference(spark_side, sql_side) -> str | None:
    """None if equal, else a short account of what differs."""
    if spark_side[0] != sql_side[0]:
        return f"columns {spark_side[0]} against {sql_side[0]}"
    if spark_side[1] == sql_side[1]:
        return None
    extra, lacking = spark_side[1] - sql_side[1], sql_side[1] - spark_side[1]
    return (
        f"rows {spark_side[1].total()} against {sql_side[1].total()}; "
        f"Spark only {list(extra.items())[:2]}; SQL only {list(lacking.items())[:2]}"
    )


def main() -> int:
    from tallywork.plans.catalog import REGISTRY
    from tallywork.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--folder", help="tables elsewhere, such as skewed ones")
    parser.add_argument("--times", action="store_true")
    arguments = parser.parse_args()
    folder = arguments.folder or f"/root/testdata/sf{arguments.sf}"
    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in arguments.names or REGISTRY:
        started = time.time()
        try:
            found = spark_rows(REGISTRY[name](spark, folder))
            spent = time.time() - started
            sql = REGISTRY[name].oracle
            problem = difference(found, sql_rows(connection, sql)) if sql else None
        except Exception as error:  # report and go on with the next query
            spent, problem, found, sql = time.time() - started, repr(error)[:1500], None, "?"
        failed += problem is not None
        state = "DIFF" if problem else "ok" if sql else "rows only"
        count = found[1].total() if found else 0
        if problem or not sql or count == 0 or arguments.times:
            print(f"{state:9} {name:28} {count:8} rows {spent:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} of {len(arguments.names or REGISTRY)} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
