"""Run every named query and its SQL counterpart and compare the rows.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(folder, f"{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def normalized(names, rows):
    """Rows with columns in name order, sorted, every value as text."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple("∅" if row[i] is None else str(row[i]) for i in order) for row in rows)


def compare(spark, connection, folder: str, query, sql: str) -> str:
    frame = query(spark, folder)
    ours = normalized(frame.columns, [tuple(row) for row in frame.collect()])
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    theirs = normalized(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns differ: {sorted(frame.columns)} / {sorted(names)}"
    if len(ours) != len(theirs):
        return f"row counts differ: {len(ours)} / {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else ""


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from portflow.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles = oracle_sql()
    failed = 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            if name in oracles:
                problem = compare(spark, connection, folder, query, oracles[name])
            else:
                problem = "" if query(spark, folder).count() >= 0 else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "" if name in oracles else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - started:6.2f}s {name}{kind} {problem}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
