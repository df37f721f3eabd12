"""Run every query against its SQL in DuckDB and compare whole results, order-insensitively.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, float):
        return (1, f"{value:.9g}")
    return (1, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_cell(row[i]) for i in order) for row in rows])


def differences(spark, con, folder: str, query, sql: str) -> tuple[list[str], int]:
    """Reasons why the results differ (empty when equal), and the number of rows."""
    df = query(spark, folder)
    left = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    right = result.fetchall()
    problems = []
    kinds = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    mine = {n: kinds.get(kind, kind) for n, kind in df.dtypes}
    theirs = {d[0]: str(d[1]) for d in result.description}
    if mine != theirs:
        problems.append(f"types differ: {[(n, mine[n], theirs.get(n)) for n in mine if mine[n] != theirs.get(n)]}")
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"], len(left)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    a, b = _rows(df.columns, left), _rows(names, right)
    if a != b:
        only = [(x, y) for x, y in zip(a, b) if x != y][:2]
        problems.append(f"values differ: {only}")
    return problems, len(left)


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    from tidecart.session import builder

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or [n for n in queries() if n in oracle_sql()]
    spark = builder("compare", spark__driver__host="127.0.0.1", spark__ui__enabled="false").master("local[8]").config(
        "spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problems, rows = differences(spark, con, folder, queries()[name], oracle_sql()[name])
        except Exception as error:  # noqa: BLE001
            problems, rows = [f"{type(error).__name__}: {str(error)[:600]}"], -1
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name:32} rows={rows:7} {time.time() - start:6.2f}s", *problems, flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
