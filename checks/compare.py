"""Run queries in Spark and DuckDB and compare them: python -m checks.compare SF_DIR [name ...]."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.registry import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("parcelwise-checks")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        # Wide projections make methods that the JVM does not compile; leave those unfused.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Few bytes can mean much work here, so small partitions are kept apart.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return str(value) if isinstance(value, Decimal) else value


def rows_of(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str:
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    t1 = time.time()
    if name not in ORACLE:
        return f"rows-only {len(got)} spark={t1 - t0:.1f}s"
    cursor = con.execute(ORACLE[name])
    want_columns, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    timing = f"spark={t1 - t0:.1f}s oracle={time.time() - t1:.1f}s"
    if got_columns != want_columns:
        return f"COLUMNS {got_columns} != {want_columns} {timing}"
    if len(got) != len(want):
        return f"ROWS {len(got)} != {len(want)} {timing}"
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    if differing:
        return f"VALUES {len(differing)} of {len(got)} differ, e.g. {differing[:2]} {timing}"
    return f"ok {len(got)} rows {timing}"


def main(argv: list[str]) -> int:
    sf_dir, names = argv[0], argv[1:] or list(QUERIES)
    spark, con = session(), oracle_connection(str(Path(sf_dir)))
    failures = 0
    for name in names:
        try:
            result = compare(spark, con, sf_dir, name)
        except Exception as error:  # report it and go on with the next query
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failures += not result.startswith(("ok", "rows-only"))
        print(f"{name:24s} {result}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
