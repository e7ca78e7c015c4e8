"""Compare checked queries with their SQL: python tests/check.py SF_DIR [names...]."""

from __future__ import annotations

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from tests import oracle  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    runs, sql = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in names or list(sql):
        started = time.time()
        try:
            rows, fault = oracle.compare(spark, con, runs[name], sql[name], sf_dir)
        except Exception as error:  # a failing query must not hide the ones after it
            rows, fault = 0, f"{type(error).__name__}: {str(error)[:800]}"
        bad += bool(fault)
        print("BAD" if fault else "OK ", name, rows, f"{time.time() - started:.1f}s", fault, flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
