"""Logged tables: any batches, replays and compactions give the same rows; reads and compactions keep to their partitions."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tickloom.sources.logged import logged, path_exists

SCHEMA = "symbol string, at bigint, v bigint"


def rows(df):
    return sorted(map(tuple, df.collect()))


def table_at(spark, path, combine=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    return logged(path, schema, ("symbol", "at"), combine, day=F.floor(F.col("at") / 10))


def summed(df):
    return df.groupBy("symbol", "at").agg(F.max("v").alias("v"))


@pytest.mark.parametrize("combine", [None, summed])
def test_any_compactions_give_the_same_rows(spark, tmp_path, combine):
    rng = random.Random(4)
    table, plain = table_at(spark, str(tmp_path / "t"), combine), {}
    assert rows(table.read(spark)) == []
    for batch in range(6):
        keys = rng.sample([(s, t) for s in "AB" for t in range(40)], 20 if batch != 3 else 0)
        new = [(*k, rng.randrange(100)) for k in keys]
        frame = spark.createDataFrame(new, SCHEMA)
        if batch == 2:  # a replay
            table.append(frame.withColumn("v", F.lit(1000)), batch)
        table.append(frame, batch)
        for s, t, v in new:
            plain[s, t] = v if combine is None else max(v, plain.get((s, t), v))
        expected = sorted((*k, v) for k, v in plain.items())
        assert rows(table.read(spark)) == expected
        if batch in (1, 4):
            table.compact(spark, batch)
            assert rows(table.read(spark)) == expected
    some = [r for r in expected if 10 <= r[1] < 30]
    assert rows(table.read(spark, F.col("day").between(1, 2))) == some
    assert table.compacted_to(spark) == 4
    with pytest.raises(ValueError, match="compacted"):
        table.read(spark, before=3)


def test_reads_and_compactions_keep_to_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    table = table_at(spark, path)
    table.append(spark.createDataFrame([("A", t, t) for t in range(100)], SCHEMA), 0)
    table.compact(spark, 0)
    table.append(spark.createDataFrame([("A", 55, -1)], SCHEMA), 1)
    asked = table.read(spark, F.col("day") == 5)
    assert rows(asked) == [("A", t, -1 if t == 55 else t) for t in range(50, 60)]
    plan = asked._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    held = [re.search(r"PartitionFilters: \[[^\]]*\(day#\d+L? = 5\)", x) is not None for x in scans]
    assert len(scans) >= 3 and sum(held) >= 3  # the batches, the base and its marks (a long list of filters is cut short)
    table.compact(spark, 1)
    assert path_exists(spark, f"{path}_base/upto=1/day=5") and not path_exists(spark, f"{path}_base/upto=1/day=4")
    assert rows(table.read(spark)) == [("A", t, -1 if t == 55 else t) for t in range(100)]
