"""Split windows give the same rows as whole windows, whatever the gaps and block sizes."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import bars_frame, random_rows
from tickloom.operators import blocks as B
from tickloom.operators import crossover, windows
from tickloom.operators.bars import resample_by_count

TINY = B.Blocks(chunk_rows=4, block_rows=8)
WHOLE = B.Blocks(chunk_rows=10**6, block_rows=10**9)

# One hot series with most rows, some small ones, one with a single row.
COUNTS = {"HOT": 400, "A": 60, "B": 37, "ONE": 1}


@pytest.fixture(scope="module")
def bars(spark):
    return bars_frame(spark, random_rows(7, COUNTS)).persist()


def whole(bars):
    return Window.partitionBy("symbol", "period").orderBy("open_time")


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("before,after", [(0, 0), (1, 0), (0, 1), (5, 3), (50, 0), (0, 40), (120, 7)])
def test_frames_and_positions(bars, before, after):
    cut = B.split_series(bars, before=before, after=after, blocks=TINY)

    def look(df, w, position):
        frame = F.collect_list("open_time").over(w.rowsBetween(-before, after))
        return df.withColumns({"seen": frame, "at": position})

    got = cut.owned(look(cut.df, cut.window, cut.position))
    w = whole(bars)
    expected = look(bars, w, F.row_number().over(w) - 1)
    assert rows(got) == rows(expected.select(*got.columns))


def test_hot_series_is_spread(bars):
    cut = B.split_series(bars, before=2, after=1, blocks=B.Blocks(chunk_rows=4, block_rows=16))
    sizes = cut.df.filter("symbol = 'HOT'").groupBy("_block").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 16 + 3 * 4 + 3 + 4 and sizes[1] >= 400 // 20


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    seed=st.integers(0, 10**6),
    chunk=st.integers(1, 9),
    block=st.integers(1, 40),
    before=st.integers(0, 30),
    after=st.integers(0, 12),
)
def test_any_cut(spark, seed, chunk, block, before, after):
    bars = bars_frame(spark, random_rows(seed, {"X": 90, "Y": 11}, gap=0.5, big_gap=0.1))
    cut = B.split_series(bars, before=before, after=after, blocks=B.Blocks(chunk, block))
    frame = cut.window.rowsBetween(-before, after)
    got = cut.owned(cut.df.withColumns({"n": F.sum("num_trades").over(frame), "v": F.sum("volume").over(frame), "at": cut.position}))
    w = whole(bars)
    frame = w.rowsBetween(-before, after)
    expected = bars.withColumns(
        {"n": F.sum("num_trades").over(frame), "v": F.sum("volume").over(frame), "at": F.row_number().over(w) - 1}
    )
    assert rows(got) == rows(expected)


def test_totals(bars):
    cut = B.split_series(bars, totals={"total": F.sum("volume")}, blocks=TINY)
    got = {r[0]: r[1] for r in cut.df.select("symbol", "total").distinct().collect()}
    assert got == {r[0]: r[1] for r in bars.groupBy("symbol").agg(F.sum("volume")).collect()}


def test_running_total(spark):
    df = spark.range(300).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'A' ELSE 'B' END AS k",
        "cast(id as decimal(18,8)) AS price",
        "cast(pmod(hash(id), 100) / 7 as decimal(38,8)) AS volume",
    )
    got = B.running_total(
        df, "volume", keys=["k"], order=["price"], chunk=F.floor(F.col("price") / 7), name="total"
    )
    w = Window.partitionBy("k").orderBy("price")
    assert rows(got) == rows(df.withColumn("total", F.sum("volume").over(w)))


OPERATORS = {
    "neighbours": lambda b, k: windows.neighbour_bars(b, blocks=k),
    "bands": lambda b, k: windows.bollinger_bands(b, n=20, bandwidth=1.0, blocks=k),
    "long_bands": lambda b, k: windows.bollinger_bands(b, n=150, bandwidth=0.5, blocks=k),
    "signals": lambda b, k: windows.signals_with_neighbours(b, n=10, bandwidth=1.0, blocks=k),
    "volume_spikes": lambda b, k: windows.volume_spikes(b, n=1.1, blocks=k),
    "direction_spikes": lambda b, k: windows.direction_spikes(b, increase=0.005, blocks=k),
    "trailing_volume": lambda b, k: windows.trailing_volume(b, 30, blocks=k),
    "trailing_bars": lambda b, k: windows.trailing_bars(b, 7, blocks=k),
    "average_pair": lambda b, k: crossover.moving_average_pair(b, 12, blocks=k),
    "crossover": lambda b, k: crossover.mac_crossover(b, 20, 8, blocks=k),
    "mac": lambda b, k: crossover.mac_signals(b, [(10, 6), (30, 12)], blocks=k),
    "resample": lambda b, k: resample_by_count(b, (1, 5, 10, 30), blocks=k),
    "resample_odd": lambda b, k: resample_by_count(b, (3, 5), blocks=k),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operator_is_blind_to_blocks(bars, name):
    split, together = OPERATORS[name](bars, TINY), OPERATORS[name](bars, WHOLE)
    got = rows(split)
    assert got and got == rows(together)


def test_grid_equals_pairs(bars):
    folded = resample_by_count(bars, (1, 5))
    pairs = [(long, short) for long in range(10, 15) for short in range(6, 9) if short < long]
    few = crossover.mac_signals(folded, pairs, position="bar_index", keys=("symbol", "size"), blocks=TINY)
    grid = crossover.mac_grid(
        folded,
        position="bar_index",
        keys=("symbol", "size"),
        long_terms=(10, 14),
        short_terms=(6, 8),
        blocks=B.Blocks(block_rows=20),
    )
    assert rows(grid) and rows(grid) == rows(few)


@pytest.mark.parametrize("grid", [True, False])
def test_rows_by_bar_hold_the_signals_of_the_bars_asked_for(bars, grid):
    folded = resample_by_count(bars, (1, 5)).withColumn("asked", F.col("bar_index") % 3 > 0)
    keyed = {"position": "bar_index", "keys": ("symbol", "size")}
    if grid:
        found = lambda **more: crossover.mac_grid(folded, long_terms=(8, 14), short_terms=(6, 9), **keyed, **more)
    else:
        found = lambda **more: crossover.mac_signals(folded, [(12, 9), (10, 6), (10, 7)], blocks=TINY, **keyed, **more)
    names = ["symbol", "size", "open_time", "indicator_id", "volume", "vol_avg", "vol3_avg"]
    by_bar = found(only="asked", by_bar=True)
    expected = found().join(folded.where("asked").select(*names[:3]), names[:3], "left_semi").select(*names)
    assert rows(expected) and rows(crossover.signal_rows(by_bar).select(*names)) == rows(expected)
    assert by_bar.count() == by_bar.select(*names[:3]).distinct().count()


def test_without_broadcast(spark, bars):
    """Beyond the broadcast size the chunk table is met by a sort-merge join; same rows."""
    expected = rows(windows.bollinger_bands(bars, n=20, blocks=WHOLE))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        got = windows.bollinger_bands(bars, n=20, blocks=TINY)
        assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == expected
    finally:
        spark.conf.set(threshold, before)


def test_written_chunk_table(bars, tmp_path):
    stored = B.Blocks(chunk_rows=4, block_rows=8, counts_dir=str(tmp_path))
    assert rows(windows.neighbour_bars(bars, blocks=stored)) == rows(windows.neighbour_bars(bars, blocks=WHOLE))
    assert len(list(tmp_path.iterdir())) == 1
