"""Run every query next to its SQL: ``python -m checks.compare [sf_dir] [names...]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.fixtures import TABLES
from checks.oracle import ORACLE
from checks.queries import QUERIES


def comparable(rows, columns) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, sf_dir: str, name: str) -> tuple[str | None, int]:
    """What differs, or ``None``, and the number of rows."""
    found = QUERIES[name](spark, sf_dir)
    rows = comparable([tuple(row) for row in found.collect()], found.columns)
    if name not in ORACLE:
        return (None if rows else "no rows"), len(rows)
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = db.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    expected = comparable(result.fetchall(), columns)
    if sorted(columns) != sorted(found.columns):
        return f"columns {found.columns} and {columns}", len(rows)
    if rows != expected:
        extra = [row for row in rows if row not in set(expected)][:2]
        absent = [row for row in expected if row not in set(rows)][:2]
        return f"{len(rows)} and {len(expected)} rows, extra {extra}, absent {absent}", len(rows)
    return None, len(rows)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        started = time.perf_counter()
        try:
            problem, rows = difference(spark, sf_dir, name)
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += problem is not None
        seconds = time.perf_counter() - started
        oracle = "sql" if name in ORACLE else "rows only"
        print(f"{name}: {problem or 'same'} ({rows} rows, {oracle}, {seconds:.1f}s)", flush=True)
    print(f"{len(names)} queries, {failed} differ")
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
