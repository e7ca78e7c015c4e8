"""Jobs that append signals may be repeated: one set of rows a run, and never half a job."""

from __future__ import annotations

import os

import pytest

from tickloom.schemas import SIGNALS
from tickloom.sources.storage import append_signals, read_signals


def signals(spark, *indicators):
    return spark.createDataFrame([(i, "A", i % 3, i, 1.0, None, 2.0) for i in indicators], SIGNALS)


def found(spark, path):
    return sorted(r.indicator_id for r in read_signals(spark, path).collect())


def test_a_repeated_run_leaves_one_set(spark, tmp_path):
    path = str(tmp_path / "signals")
    assert found(spark, path) == []
    append_signals(signals(spark, 1, 2, 3), path, "01")
    append_signals(signals(spark, 7, 8), path, "1")  # another run, though the same number
    append_signals(signals(spark, 1, 2, 4), path, "01")
    assert found(spark, path) == [1, 2, 4, 7, 8]
    append_signals(signals(spark), path, "01")  # a run that now finds nothing
    assert found(spark, path) == [7, 8]
    for _ in range(2):  # without a name every call is a run
        append_signals(signals(spark, 5), path)
    assert found(spark, path) == [5, 5, 7, 8]


def test_a_run_that_fails_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "signals")
    append_signals(signals(spark, 1), path, "a")
    failing = signals(spark, 1, 2).selectExpr(
        "open_time", "symbol", "period", "IF(indicator_id = 2, CAST(raise_error('lost') AS INT), indicator_id) AS indicator_id", "volume", "vol_avg", "vol3_avg"
    )
    for run in ("a", "b"):
        with pytest.raises(Exception, match="lost"):
            append_signals(failing, path, run)
    # an attempt that was written whole but not committed
    signals(spark, 9).write.partitionBy("period").parquet(f"{path}/run=c/attempt=x")
    assert os.path.exists(f"{path}/run=c") and found(spark, path) == [1]
    with pytest.raises(ValueError, match="named"):
        append_signals(signals(spark, 1), path, "a/b")
