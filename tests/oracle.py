"""Run a checked query in Spark and its SQL in DuckDB, and compare all rows exactly."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, run, sql: str, sf_dir: str) -> tuple[int, str]:
    """Number of rows, and a text that says how the two sides differ (empty if they do not)."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    df = run(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return sum(got.values()), f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == expected:
        return sum(got.values()), ""
    extra, missing = got - expected, expected - got
    return sum(got.values()), (
        f"{sorted(names)}\n rows {sum(got.values())} / {sum(expected.values())}; "
        f"only Spark {sum(extra.values())}: {list(extra)[:3]}; only SQL {sum(missing.values())}: {list(missing)[:3]}"
    )
