"""Runs registered queries next to their SQL and compares rows, types and values.

``python -m tests.oracle sf0.01 [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry
from deskmill.sources.tables import TABLES

# Spark type to the SQL type that must stand on the other side.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def make_spark() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .appName("deskmill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    return db


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, db, directory: str, name: str) -> str | None:
    """None when the query agrees with its SQL, else what differs."""
    df = entry.queries()[name](spark, directory)
    got = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    types = {r[0]: r[1] for r in db.execute(f"DESCRIBE {sql}").fetchall()}
    cursor = db.execute(sql)
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    odd = {c: (t, types[c]) for c, t in df.dtypes if SAME_TYPE.get(t, t) != types[c]}
    if odd:
        return f"types {odd}"
    if not want:
        return "the SQL gives no rows"
    left, right = _rows(got, df.columns), _rows(want, names)
    if left == right:
        return None
    only_left = sorted(set(left) - set(right))[:2]
    only_right = sorted(set(right) - set(left))[:2]
    return f"{len(left)} rows against {len(right)}; {sorted(names)}\n   spark {only_left}\n   sql   {only_right}"


def main(argv: list[str]) -> int:
    directory = f"/root/testdata/{argv[0]}"
    wanted = argv[1:]
    spark = make_spark()
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(directory)
    failures = 0
    for name in entry.queries():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        started = time.time()
        try:
            problem = difference(spark, db, directory, name)
        except Exception:
            problem = traceback.format_exc()[-1500:]
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {(problem or '')[:1800]}", flush=True)
    print(f"{failures} failures", flush=True)
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
