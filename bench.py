"""Time the headline queries: prints one JSON line with seconds per query.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES
(comma-separated names instead of the headline list).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "ohlc_by_clock",
    "resample_by_count",
    "neighbour_bars",
    "bollinger_bands",
    "signals_with_neighbours",
    "preset_bollinger_1m",
    "volume_spikes",
    "direction_spikes",
    "mac_signals",
    "mac_grid_signals",
    "support_levels",
    "usd_volume",
    "max_usd_volume",
    "last_snapshot",
    "daily_stats",
    "upsert_bars",
    "parse_bar_pages",
    "parse_depth_updates",
    "alerts_fired",
    "stream_ohlc",
    "stream_alerts",
    "stream_signals",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["ohlc_by_clock"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    report = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
