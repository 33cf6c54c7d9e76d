"""Compare registered queries with their SQL on DuckDB: python -m tests.oracle_check [folder] [key prefix...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession, types as T

import __spark_entry__ as entry
from tabwright.sources.dirty_views import TABLES

DUCK_TYPES = {
    T.StringType: "VARCHAR", T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE",
    T.BooleanType: "BOOLEAN",
}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("tabwright-check")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.extraJavaOptions", "-Dlog4j.logger.org.apache.spark.sql.execution.window.WindowExec=ERROR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def compare(frame, db, sql: str) -> str | None:
    """None when schema and rows agree, else what differs."""
    names = sorted(frame.columns)
    answer = db.execute(sql)
    theirs = {d[0]: str(d[1]) for d in answer.description}
    if sorted(theirs) != names:
        return f"columns {names} != {sorted(theirs)}"
    for field in frame.schema:
        wanted = DUCK_TYPES.get(type(field.dataType), "?")
        if wanted != theirs[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} != {theirs[field.name]}"
    order = [list(theirs).index(n) for n in names]
    right = sorted(tuple(_cell(row[i]) for i in order) for row in answer.fetchall())
    left = sorted(tuple(_cell(row[n]) for n in names) for row in frame.collect())
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{names}: {a} != {b}"
    return None


def main(argv: list[str]) -> int:
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:])
    spark, db = session(), database(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failures = 0
    for key, run in queries.items():
        if prefixes and not key.startswith(prefixes):
            continue
        start = time.time()
        try:
            frame = run(spark, folder)
            if key in oracles:
                verdict = compare(frame, db, oracles[key])
            else:
                verdict = f"rows only: {frame.count()}"
        except Exception as failure:  # noqa: BLE001
            verdict = f"{type(failure).__name__}: {str(failure)[:600]}"
        bad = verdict is not None and not verdict.startswith("rows only")
        failures += bad
        print(f"{'FAIL' if bad else 'ok  '} {key:32s} {time.time() - start:6.1f}s {verdict or ''}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
