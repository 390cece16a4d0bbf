"""Run the registered queries next to their SQL: ``python -m checks.compare [sf_dir] [name...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def session(cpus: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("flowlens")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def _sorted_rows(names: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL; None when nothing does."""
    df = QUERIES[name](spark, sf_dir)
    ours = _sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    cursor = connection.execute(ORACLES[name])
    theirs = _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    bad = [pair for pair in zip(ours[1], theirs[1]) if repr(pair[0]) != repr(pair[1])]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                found = difference(spark, connection, sf_dir, name)
                verdict = found or "same"
                bad += found is not None
            else:
                verdict = f"{QUERIES[name](spark, sf_dir).count()} rows"
        except Exception as error:  # report and go on with the next query
            bad += 1
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:26s} {time.time() - start:6.2f} s  {verdict}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
