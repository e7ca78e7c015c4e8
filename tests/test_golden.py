"""Values known by hand."""

from __future__ import annotations

import datetime as dt
import math
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import START_MS, bar, bars_frame, random_rows
from tickloom import schemas as S
from tickloom.functions import signals, times
from tickloom.operators import crossover, windows
from tickloom.operators.bars import first_n_from, price_vol_parts, price_vol_window, resample_by_count
from tickloom.operators.blocks import Blocks
from tickloom.operators.book import price_chunk
from tickloom.operators.stats import volume_average


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize(
    "duration,expected",
    [
        (S.DAY_MS, "2022-01-01 00:00:00"),
        (7 * S.DAY_MS, "2021-12-27 00:00:00"),
        (30 * S.DAY_MS, "2022-01-01 00:00:00"),
        (5 * S.MINUTE_MS, "2022-01-01 12:30:00"),
        (3 * S.DAY_MS, "2021-12-30 00:00:00"),
        (S.HOUR_MS, "2022-01-01 12:00:00"),
    ],
)
def test_start_of_period(spark, duration, expected):
    ts = F.lit("2022-01-01 12:34:56.789").cast("timestamp")
    assert str(one(spark, times.start_of_period(ts, duration))[0]) == expected


def test_start_of_period_before_origin(spark):
    ts = F.lit("2000-12-31 23:59:59").cast("timestamp")
    assert str(one(spark, times.start_of_period(ts, 3 * S.DAY_MS))[0]) == "2000-12-29 00:00:00"


@pytest.mark.parametrize(
    "prev,last,lower,upper,expected",
    [
        (80, 110, 90, 120, "BUY"),
        (120, 110, 90, 120, "SELL"),
        (110, 100, 90, 120, None),
        (110, 130, 90, 120, None),
        (90, 110, 100, 120, "BUY"),
        (130, 110, 100, 120, "SELL"),
        (None, 110, 90, 120, None),
    ],
)
def test_trading_signal(spark, prev, last, lower, upper, expected):
    values = [F.lit(v).cast("int") for v in (prev, last, lower, upper)]
    assert one(spark, signals.trading_signal(*values))[0] == expected


@pytest.mark.parametrize(
    "closes,expected",
    [
        ([20, 21, 11, 18, 10, 10, 14, 13, 15, 18], "BUY"),
        ([10, 11, 12, 13, 20, 16, 15, 14, 13, 9], "SELL"),
    ],
)
def test_mac_crossover(spark, closes, expected):
    rows = [bar("X", "1m", START_MS + i * 60_000, c, 1) for i, c in enumerate(closes)]
    got = crossover.mac_crossover(bars_frame(spark, rows), 10, 5).collect()
    assert [r.trade_signal for r in got] == [expected]


def test_mac_needs_an_average(spark):
    rows = [bar("X", "1m", START_MS + i * 60_000, 10 + i, 1) for i in range(12)]
    got = crossover.mac_crossover(bars_frame(spark, rows), 10, 1).collect()
    assert {r.trade_signal for r in got} == {None} and got[0].s1 == -1
    pair = crossover.moving_average_pair(bars_frame(spark, rows), 0).first()
    assert (pair.avg1, pair.avg2) == (-1.0, 0.0)
    with pytest.raises(ValueError):
        crossover.mac_signals(bars_frame(spark, rows), [(10, 10)])


def test_signal_codes(spark):
    assert signals.SIGNAL_CODES == {None: 0, "BUY": 1, "SELL": 2}
    got = one(spark, *[signals.signal_code(F.lit(s).cast("string")) for s in (None, "BUY", "SELL")])
    assert tuple(got) == (0, 1, 2)


def test_resample_by_count(spark):
    n = 100
    rows = []
    for i in range(n):
        row = bar("X", "1m", START_MS + i * 60_000, i + 1, i, open_price=i, low_price=i)
        row = list(row)
        for name in ("quote_asset_volume", "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume"):
            row[S.BARS.names.index(name)] = Decimal(i)
        row[S.BARS.names.index("num_trades")] = i
        rows.append(tuple(row))
    got = resample_by_count(bars_frame(spark, rows), (1, 15, 60)).collect()
    assert sorted({r.size for r in got}) == [1, 15, 60]
    for size, count in ((15, 7), (60, 2), (1, 100)):
        folded = sorted((r for r in got if r.size == size), key=lambda r: r.bar_index)
        assert len(folded) == count
        for g, r in enumerate(folded):
            first, last = g * size, min((g + 1) * size - 1, n - 1)
            total = sum(range(first, last + 1))
            assert (r.open_price, r.low_price, r.high_price, r.close_price) == (first, first, last + 1, last + 1)
            assert r.open_time == START_MS + first * 60_000
            assert r.close_time == START_MS + (last + 1) * 60_000 - 1
            assert r.volume == r.quote_asset_volume == r.num_trades == total
            assert r.taker_buy_base_asset_volume == r.taker_buy_quote_asset_volume == total


@pytest.mark.parametrize(
    "close,volume,expected",
    [("2.00000000", "7.5", "2.(8)"), ("1.50000000", "0.4", "1.5(0)"), ("27.10500000", "12", "27.105(12)"), (None, None, "()")],
)
def test_format_price_volume(spark, close, volume, expected):
    text = signals.format_price_volume(F.lit(close).cast(S.PRICE), F.lit(volume).cast(S.VOLUME))
    assert one(spark, text)[0] == expected


def test_pack_indicator_id(spark):
    def packed(signal):
        return signals.pack_indicator_id(F.lit(0), F.lit(50), F.lit(20), F.lit(signal))

    assert tuple(one(spark, packed("BUY"), packed("SELL"))) == (204820, -204820)
    parts = signals.unpack_indicator_id(F.lit(-204820))
    assert tuple(one(spark, *parts.values())) == (0, 50, 20, "SELL")
    top = signals.pack_indicator_id(F.lit(511), F.lit(1023), F.lit(4095), F.lit("BUY"))
    assert one(spark, top)[0] == 2**31 - 1
    with pytest.raises(Exception, match="out of range"):
        one(spark, signals.pack_indicator_id(F.lit(512), F.lit(1), F.lit(1), F.lit("BUY")))


def test_periods(spark):
    for name, ms, _ in S.PERIODS:
        assert one(spark, S.period_to_ms(F.lit(name)), S.ms_to_period(F.lit(ms))) == (ms, name)
    with pytest.raises(Exception, match="unknown period"):
        one(spark, S.period_to_ms(F.lit("7m")))
    with pytest.raises(Exception, match="not valid duration"):
        one(spark, S.ms_to_period(F.lit(1)))
    with pytest.raises(ValueError):
        S.check_period("7m")
    assert S.period_dim(spark).count() == 16 and S.price_period_dim(spark).count() == 8


def test_ts_to_ms_rounds(spark):
    ts = [F.timestamp_micros(F.lit(m)) for m in (1_500, 1_499, -1_500, -1_499)]
    assert tuple(one(spark, *[times.ts_to_ms(t) for t in ts])) == (2, 1, -2, -1)


def test_periods_before():
    at = "2024-03-31T00:00:00"
    assert times.periods_before_ms(at, "1h", 5) == times.to_epoch_ms(at) - 5 * S.HOUR_MS
    assert times.periods_before_ms(at, "1M", 1) == times.to_epoch_ms("2024-02-29T00:00:00")
    assert times.periods_before_ms(at, "1M", 14) == times.to_epoch_ms("2023-01-31T00:00:00")
    assert times.as_utc("2024-01-01") == dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def test_price_chunk_rises_with_the_price(spark):
    prices = spark.range(1, 20_000).selectExpr(
        "cast(id * id * id / 1000000 as decimal(28,8)) AS price"
    ).distinct()
    chunks = [r[0] for r in prices.select(price_chunk(F.col("price")), "price").orderBy("price").collect()]
    assert chunks == sorted(chunks)
    edges = spark.createDataFrame([(str(10.0**e),) for e in range(-6, 9)], "p string")
    low = edges.select(price_chunk(F.col("p").cast("decimal(28,8)")), price_chunk(F.col("p").cast("decimal(28,8)") - F.lit("0.00000001").cast("decimal(28,8)")))
    assert all(at > below for at, below in low.collect())


def test_bands_against_a_loop(spark):
    n, width = 6, 1.0
    rows = random_rows(3, {"X": 60}, gap=0)
    closes = [float(r[6]) for r in sorted(rows, key=lambda r: r[2])]
    got = windows.bollinger_bands(bars_frame(spark, rows), n=n, bandwidth=width).orderBy("open_time").collect()
    previous, expected = None, []
    for i in range(n - 1, len(closes)):
        last = closes[i - n + 1 : i + 1]
        mean, sd = statistics.fmean(last), statistics.pstdev(last)
        signal = None
        if previous is not None and previous <= mean - sd * width and closes[i] > mean - sd * width:
            signal = "BUY"
        elif previous is not None and previous >= mean + sd * width and closes[i] < mean + sd * width:
            signal = "SELL"
        expected.append((mean, sd, signal))
        previous = closes[i]
    assert len(got) == len(expected)
    for r, (mean, sd, signal) in zip(got, expected):
        assert math.isclose(r.middle_band, mean, rel_tol=1e-12)
        assert math.isclose(r.standard_deviation, sd, rel_tol=1e-9, abs_tol=1e-12)
        assert r.trade_signal == signal


def test_bands_of_a_steep_price(spark):
    """A spread of 1e-8 around a large price survives: the variance is exact."""
    rows = [bar("X", "1m", START_MS + i * 60_000, f"30000.0000000{i % 2}", 1) for i in range(40)]
    got = windows.bollinger_bands(bars_frame(spark, rows), n=20).collect()
    assert all(math.isclose(r.standard_deviation, 0.5e-8, rel_tol=1e-12) for r in got)


def test_bands_start_reads_n_more_periods(spark):
    rows = [bar("X", "1h", START_MS + i * S.HOUR_MS, 10 + i % 3, 1) for i in range(50)]
    start = times.as_utc("1970-01-01") + dt.timedelta(milliseconds=START_MS + 30 * S.HOUR_MS)
    got = windows.bollinger_bands(bars_frame(spark, rows), n=10, period="1h", start=start)
    assert got.agg(F.min("open_time")).first()[0] == START_MS + 29 * S.HOUR_MS
    assert windows.bollinger_bands(bars_frame(spark, rows[:9]), n=10).count() == 0


def test_signals_with_one_bar(spark):
    rows = [bar("X", "1h", START_MS + i * S.HOUR_MS, 10, 10 ** (i % 2)) for i in range(6)]
    start = times.as_utc("1970-01-01") + dt.timedelta(milliseconds=START_MS + 2 * S.HOUR_MS)
    got = windows.signals_with_neighbours(bars_frame(spark, rows), n=1, period="1h", start=start)
    # The bar before the first read one belongs to the neighbours all the same.
    assert [r.prev_volume for r in got.orderBy("open_time").collect()] == [1, 1, 1]


def test_volume_average_of_nothing(spark):
    empty = bars_frame(spark, [])
    assert volume_average(empty).first()[0] == 0.0


@pytest.mark.parametrize("n", [1, 7, 8, 9, 40, 250, 1200, 5000])
def test_first_n_by_position(spark, n):
    """Chunks of eight bars, series with gaps and without, of a bar and of none after the start."""
    series = random_rows(9, {"A": 300, "B": 20, "C": 1}) + [bar("D", "1s", START_MS + i * 1000, 1, 1) for i in range(1500)]
    start = times.as_utc("1970-01-01") + dt.timedelta(milliseconds=START_MS + 10_000)
    opened, expected = S.BARS.names.index("open_time"), []
    for symbol in "ABCD":
        run = sorted(r for r in (r[opened] for r in series if r[0] == symbol) if r >= START_MS + 10_000)
        expected += [(symbol, at, k + 1) for k, at in enumerate(run[:n])]
    bars, blocks = bars_frame(spark, series), Blocks(chunk_rows=8)
    got = first_n_from(bars, start, n, blocks=blocks)
    assert got.columns == [*S.BARS.names, "row_number"]
    assert sorted(map(tuple, got.select("symbol", "open_time", "row_number").collect())) == expected
    parts = price_vol_parts(bars, start, n, part_rows=5, blocks=blocks).orderBy("symbol", "part").collect()
    whole = {r.symbol: r.price_vol_window for r in price_vol_window(bars, start, n, blocks=blocks).collect()}
    assert whole == {s: ", ".join(r.price_vol_window for r in parts if r.symbol == s) for s in whole}
    assert max(r.price_vol_window.count("(") for r in parts) <= 5
    assert {s: t.count("(") for s, t in whole.items()} == {s: sum(e[0] == s for e in expected) for s in whole}
    assert whole["D"] == ", ".join(["1.(1)"] * min(n, 1490))


def test_first_n_shuffles_no_later_chunk(spark):
    bars = bars_frame(spark, [bar("X", "1s", START_MS + i * 1000, 1, 1) for i in range(10)])
    plans = [first_n_from(bars, "2001-01-01", n)._jdf.queryExecution().executedPlan().toString() for n in (5, 100_000)]
    assert all("WindowGroupLimit" not in p and "_chunk" in p for p in plans)
    assert plans[0].count("Window [") == plans[1].count("Window [") == 2  # over the counts, and within a chunk
