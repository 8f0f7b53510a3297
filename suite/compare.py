"""Run queries in Spark and DuckDB over the same files and compare the rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, Decimal):
        return format(v.normalize() + 0, "f")
    if isinstance(v, float):
        return "nan" if math.isnan(v) else format(Decimal(repr(v)).normalize() + 0, "f")
    if isinstance(v, int):
        return format(Decimal(v).normalize() + 0, "f")
    return str(v)


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when columns and rows agree, else what differs."""
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    got = df.collect()
    a, b = bag(df.columns, got), bag(names, want)
    if a != b:
        return (
            f"{len(got)} vs {len(want)} rows; only Spark {list((a - b).items())[:2]}; "
            f"only SQL {list((b - a).items())[:2]}"
        )
    return None


def main(sf_dir: str, pattern: str = "", *settings: str) -> int:
    """``settings`` are extra ``key=value`` session settings."""
    from pyspark.sql import SparkSession

    from riskmart.session import tuned
    from suite.catalog import CHECKS, QUERIES

    builder = (
        tuned(SparkSession.builder.master("local[8]"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for setting in settings:
        builder = builder.config(*setting.split("=", 1))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    con, bad = duck(sf_dir), 0
    for name, build in QUERIES.items():
        if pattern not in name:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            if name in CHECKS:
                diff = compare(df, con, CHECKS[name])
            else:
                diff = None if df.count() >= 0 else "no rows"
        except Exception as e:  # noqa: BLE001 - report and go on
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        state = "ok  " if diff is None else "FAIL"
        print(f"{state} {time.time() - start:6.2f}s {name} {diff or ''}")
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
