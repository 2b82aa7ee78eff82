"""Compare every named query with its SQL counterpart: python tests/differential.py [folder] [name ...]."""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def cell(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def rows_of(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([cell(row[i]) for i in order]) for row in rows)


def compare(spark, con, name: str, query, sql: str, folder: str) -> tuple[str, int]:
    """Empty text when equal, otherwise what differs; and the row count."""
    df = query(spark, folder)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs_columns = [d[0] for d in result.description]
    theirs = rows_of(theirs_columns, result.fetchall())
    if sorted(df.columns) != sorted(theirs_columns):
        return f"columns {sorted(df.columns)} != {sorted(theirs_columns)}", len(ours)
    if ours == theirs:
        return "", len(ours)
    only_ours = sorted(set(ours) - set(theirs))[:2]
    only_theirs = sorted(set(theirs) - set(ours))[:2]
    return f"{len(ours)} != {len(theirs)} rows\n  ours   {only_ours}\n  oracle {only_theirs}", len(ours)


def types_differ(spark, con, query, sql: str, folder: str) -> list[str]:
    """Columns whose Spark type is not the one the SQL side yields."""
    same = {
        "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    ours = {f.name: same.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in query(spark, folder).schema}
    theirs = {name: kind for name, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{n}: {ours[n]} / {theirs.get(n)}" for n in ours if ours[n] != theirs.get(n)]


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from telemetry_lake import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:] or list(oracle_sql())
    spark = build_session("differential", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in chosen:
        start = time.time()
        try:
            problem, count = compare(spark, con, name, queries()[name], oracle_sql()[name], folder)
        except Exception as error:  # noqa: BLE001
            problem, count = f"{type(error).__name__}: {str(error)[:1500]}", -1
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:28} {count:7} rows {time.time() - start:6.1f}s {problem}", flush=True)
    print(f"{failed} of {len(chosen)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
