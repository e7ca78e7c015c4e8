"""Queries on rows as they come from larger tables: many ticks a day, series off their grid, several shuffled parts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests import oracle
from tickloom.operators import windows
from tickloom.plans.queries import ORACLES, QUERIES
from tickloom.session import prepare


def write_events(spark, path, rows):
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/events.parquet")
    return path


@pytest.mark.parametrize("k", [90_000, 200_000_000])
def test_stats_of_days_with_many_ticks(spark, tmp_path, k):
    start = dt.datetime(2024, 1, 10)
    rows = [
        (i, start + dt.timedelta(hours=7 * i), 1, "view", 10.25 + i, '{"k": %d}' % (k + i)) for i in range(12)
    ]
    path = write_events(spark, str(tmp_path), rows)
    days: dict[dt.date, list] = {}
    for _, ts, _, _, value, props in rows:
        days.setdefault(ts.date(), []).append((int(props[6:-1]), Decimal(str(value))))
    turnovers = [sum(v for v, _ in d) * 10**15 * d[-1][1] for d in days.values()]
    assert max(sum(v for v, _ in d) for d in days.values()) * 10**15 > 10**20  # beyond DECIMAL(28,8)
    (found,) = QUERIES["stats_large_volumes"](spark, path).collect()
    assert (found["symbol"], found["count"]) == ("view", len(days))
    assert found["total_amount"] == float(int(sum(turnovers)))
    assert found["max_per_day"] == float(int(max(turnovers)))
    assert found["avg_per_day"] == float((2 * int(sum(turnovers)) + len(days)) // (2 * len(days)))


def test_direction_blocks_follow_the_rows_not_the_period(spark, tmp_path, monkeypatch):
    """Ids are a thousand to a period: cut by it, all of them would lie in one block."""
    seen = []
    split = windows.split_series
    monkeypatch.setattr(windows, "split_series", lambda *a, **b: seen.append(split(*a, **b)) or seen[-1])
    noon = dt.datetime(2024, 1, 1, 12)
    path = write_events(spark, str(tmp_path), [(i, noon, 1, "view", 1.0, '{"k": 1}') for i in range(300_000)])
    found = QUERIES["direction_at_threshold"](spark, path)
    assert found.count() == 150_000
    sizes = [r["count"] for r in seen[0].df.groupBy("_block").count().collect()]
    assert len(sizes) >= 3 and max(sizes) <= 131_072 + 3 * 4096


def test_direction_windows_hold_no_lists(spark, tables):
    """The lists of neighbours are made by the last window: no window reads rows that carry them."""
    plan = windows.direction_spikes(tables.bars("1h"), increase=0.05)._jdf.queryExecution().optimizedPlan().toString()
    window_lines = [line for line in plan.splitlines() if "Window [" in line]
    assert "collect_list" in window_lines[0] and not any("collect_list" in line for line in window_lines[1:])


def test_upserts_side_by_side_keep_their_own_partitions(spark, tmp_path):
    noon = dt.datetime(2024, 1, 1, 12)
    path = write_events(spark, str(tmp_path), [(i, noon, 1, "view", float(i), '{"k": 1}') for i in range(200)])
    found = QUERIES["upsert_missing_orders"](spark, path)
    con = oracle.connect(str(tmp_path))
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{path}/events.parquet/*.parquet')")
    assert not oracle.compare(spark, con, QUERIES["upsert_missing_orders"], ORACLES["upsert_missing_orders"], path)[1]
    one = QUERIES["upsert_missing_orders"](spark, path).where("kind = 'int'")
    kinds = found.groupBy(F.spark_partition_id().alias("p"), "kind").count().groupBy("p").count()
    assert kinds.agg(F.max("count")).first()[0] == 1  # no task takes a part of each
    assert one.count() * 4 == found.count()


def test_depth_is_landed_by_many_tasks_and_in_few_files(spark, tmp_path):
    """One file a day and batch for some rows, and input written by every task that read it."""
    from tickloom.streaming import feeds

    prepare(spark)
    message = '{"e":"depthUpdate","E":%d,"s":"A","U":1,"u":2,"b":[["%d","2"]],"a":[["%d","1"]]}'
    start = 1_704_067_200_000
    rows = [(message % (start + 3_600_000 * i, i % 50 + 1, i % 50 + 2), dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i) for i in range(24 * 8)]
    landed, path = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows, "value string, seq timestamp, id bigint").repartition(4).write.parquet(landed)
    messages = spark.readStream.schema("value string, seq timestamp, id bigint").parquet(landed)
    feeds.stream_depth(messages, path, ingest_order=["seq", "id"]).awaitTermination()
    assert feeds.read_stream_levels(spark, path).count() == 2 * len(rows)
    files = feeds.levels_table(path).batches(spark, F.lit(True)).inputFiles()
    assert len(files) == 8
