"""Compare the registered queries with their SQL on one folder of tables.

Usage: python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def _value(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows(names: list[str], tuples) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_value(t[i]) for i in order) for t in tuples)


def duckdb_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), rows(names, result.fetchall())


def spark_rows(spark: SparkSession, sf_dir: str, name: str) -> tuple[list[str], Counter]:
    df = QUERIES[name](spark, sf_dir)
    return sorted(df.columns), rows(df.columns, df.collect())


def session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def main(sf_dir: str, names: list[str]) -> int:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        columns, found = spark_rows(spark, sf_dir, name)
        spent = time.time() - start
        if name not in ORACLE:
            print(f"{name}: {found.total()} rows, no SQL, {spent:.1f} s")
            continue
        expected_columns, expected = duckdb_rows(sf_dir, ORACLE[name])
        good = columns == expected_columns and found == expected
        failed += not good
        print(f"{name}: {'ok' if good else 'DIFFERS'} {found.total()} / {expected.total()} rows, {spent:.1f} s", flush=True)
        if not good:
            print("  columns", columns, expected_columns)
            print("  only Spark", list((found - expected).items())[:3])
            print("  only SQL  ", list((expected - found).items())[:3])
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(arguments[0], arguments[1:]))
