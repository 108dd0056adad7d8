"""Compares registered queries with their SQL in DuckDB.

usage: python -m catalog.compare SF_DIR [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from catalog.oracles import all_oracles
from catalog.queries import all_queries

TABLES = "region nation customer supplier part orders lineitem events".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return value


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def difference(name: str, spark: SparkSession, con, sf_dir: str) -> str | None:
    """What differs between the query and its SQL, or None."""
    df = all_queries()[name](spark, sf_dir)
    result = con.execute(all_oracles()[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    ours = canonical(df.columns, df.collect())
    theirs = canonical(columns, result.fetchall())
    if ours == theirs:
        return None
    pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(ours)} vs {len(theirs)} rows, first {pairs[:2]}"


def main() -> int:
    sf_dir, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    failed = 0
    for name in names or all_queries():
        start = time.perf_counter()
        try:
            found = difference(name, spark, con, sf_dir)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        seconds = time.perf_counter() - start
        print(f"{name:28s} {seconds:6.2f}s {found or 'ok'}", flush=True)
    print(f"{failed} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
