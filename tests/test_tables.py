"""Keyed tables, storage, alerts, tickers, planning, indicators."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import START_MS, bar, bars_frame, random_rows
from tickloom import schemas as S
from tickloom import session
from tickloom.functions.times import as_utc, to_epoch_ms
from tickloom.operators import alerts, book, ingest, keyed, stats, tickers, windows
from tickloom.operators.blocks import Blocks
from tickloom.plans import indicators
from tickloom.sources import storage


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_last_wins_and_is_idempotent(spark):
    stored = bars_frame(spark, [bar("A", "1m", START_MS, 1, 1), bar("B", "1m", START_MS, 2, 2)])
    incoming = spark.createDataFrame(
        [bar("A", "1m", START_MS, 5, 5) + (1,), bar("A", "1m", START_MS, 6, 6) + (2,), bar("C", "1m", START_MS, 7, 7) + (1,)],
        T.StructType([*S.BARS.fields, T.StructField("seq", T.LongType())]),
    )
    for order in (["seq"], ["seq", "open_time"]):
        got = keyed.upsert_bars(stored, incoming, order)
        assert got.columns == stored.columns
        assert {r.symbol: int(r.volume) for r in got.collect()} == {"A": 6, "B": 2, "C": 7}
        assert rows(keyed.upsert_bars(got, incoming, order)) == rows(got)


def test_upsert_keeps_nulls_of_the_winner(spark):
    stored = spark.createDataFrame([("A", Decimal(1))], S.PRICES)
    incoming = spark.createDataFrame([("A", None, 1)], "symbol string, price decimal(18,8), seq bigint")
    assert keyed.upsert_prices(stored, incoming, ["seq"]).first().price is None


def test_insert_absent_first_wins(spark):
    stored = spark.createDataFrame([("A", Decimal(1))], S.PRICES)
    incoming = spark.createDataFrame(
        [("A", Decimal(9), 1), ("B", Decimal(3), 2), ("B", Decimal(2), 1)], "symbol string, price decimal(18,8), seq int"
    )
    got = keyed.insert_absent(stored, incoming, ["symbol"], ["seq"])
    assert {r.symbol: int(r.price) for r in got.collect()} == {"A": 1, "B": 2}


def test_latest_per_key_forms_agree(spark):
    df = bars_frame(spark, random_rows(1, {"A": 50, "B": 20}))
    one = keyed.latest_per_key(df, ["symbol"], ["open_time"])
    two = keyed.latest_per_key(df, ["symbol"], ["open_time", "num_trades"])
    assert rows(one.select(*two.columns)) == rows(two) and one.count() == 2
    assert rows(keyed.latest_per_key(df.select("symbol", "open_time"), ["symbol"], ["open_time"], keep_order=False)) == [("A",), ("B",)]


def test_track_rejects_unknown_period(spark):
    tracked = spark.createDataFrame([("A", "1h")], S.TRACKED)
    wanted = spark.createDataFrame([("A", "1h"), ("A", "1d")], S.TRACKED)
    got = keyed.track_symbol_period(tracked, wanted, S.period_dim(spark))
    assert rows(got) == [("A", "1d"), ("A", "1h")]
    bad = spark.createDataFrame([("A", "7m")], S.TRACKED)
    with pytest.raises(Exception, match="unknown period: 7m"):
        keyed.track_symbol_period(tracked, bad, S.period_dim(spark)).collect()


def test_stored_bars_prune(spark, tmp_path):
    path = str(tmp_path / "bars")
    minutes = bars_frame(spark, random_rows(2, {"A": 80, "B": 30}))
    hours = bars_frame(spark, random_rows(3, {"A": 10}, period="1h"))
    storage.write_bars(minutes.unionByName(hours), path)
    stored = storage.read_bars(spark, path)
    assert rows(stored) == rows(minutes.unionByName(hours))
    first, last = as_utc("1970-01-01"), as_utc("2100-01-01")
    scan = storage.scan_bars(stored, "1h", first, last, symbol="A")
    assert [r.open_time for r in scan.collect()] == sorted(r.open_time for r in hours.collect())
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "GreaterThanOrEqual(open_time" in plan
    end = as_utc("1970-01-01") + dt.timedelta(milliseconds=START_MS + 20 * S.MINUTE_MS)
    back = storage.scan_bars_lookback(stored, end, 20)
    assert all(START_MS <= r.open_time <= START_MS + 20 * S.MINUTE_MS for r in back.collect())


def test_windows_prune_stored_bars(spark, tmp_path):
    """Period and look-back reach the scan, below the window, with only the needed columns."""
    path = str(tmp_path / "bars")
    storage.write_bars(bars_frame(spark, random_rows(2, {"A": 80, "B": 30}, period="1h")), path)
    bands = windows.bollinger_bands(storage.read_bars(spark, path), n=5, period="1h", start="2023-11-18")
    plan = bands._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    for scan in scans:
        assert "period" in scan.split("PartitionFilters: [")[1].split("]")[0]
        assert "GreaterThanOrEqual(open_time" in scan and "high_price" not in scan
    assert "close_price" not in min(scans, key=len)


def test_log_and_compaction(spark, tmp_path):
    path, packed = str(tmp_path / "log"), str(tmp_path / "packed")
    storage.write_batch(bars_frame(spark, [bar("A", "1m", START_MS, 1, 1), bar("B", "1m", START_MS, 1, 1)]), path, 0)
    for _ in range(2):  # the second write is the replay of the batch
        storage.write_batch(bars_frame(spark, [bar("A", "1m", START_MS, 2, 2)]), path, 1)
    latest = storage.latest_from_log(spark, path, S.BARS)
    assert {r.symbol: int(r.volume) for r in latest.collect()} == {"A": 2, "B": 1}
    storage.compact_log(spark, path, S.BARS, S.BAR_KEY, packed)
    assert rows(storage.latest_from_log(spark, packed, S.BARS)) == rows(latest)


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[1,\n2]')
    assert storage.read_landed_text(spark, str(tmp_path / "a.json")).first().value == "[1,\n2]"
    (tmp_path / "w.csv").write_text("symbol,symbol_id\nA,1\n")
    assert storage.read_csv(spark, str(tmp_path / "w.csv"), S.WATCHED).first() == ("A", 1)


def alert_rows(spark, *values):
    at = as_utc("2024-01-01")
    return spark.createDataFrame(
        [(i, 1, symbol, float(price), kind, at, at if active else None) for i, (symbol, price, kind, active) in enumerate(values)],
        S.ALERTS,
    )


def test_alerts_split_into_fired_and_left(spark):
    prices = spark.createDataFrame([("A", Decimal(10))], S.PRICES)
    held = alert_rows(spark, ("A", 10, 0, 1), ("A", 9, 0, 1), ("A", 10, 1, 1), ("A", 11, 1, 1), ("A", 10, 0, 0), ("B", 1, 1, 1))
    hit = alerts.alerts_hit(held, prices)
    assert sorted(r.id for r in hit.collect()) == [0, 2]
    assert sorted(r.id for r in alerts.alerts_remaining(held, hit).collect()) == [1, 3, 4, 5]
    archived = alerts.alerts_archived(hit, "2024-02-01").first()
    assert archived.triggered_at == dt.datetime(2024, 2, 1) and archived.last_price == 10


def test_arming(spark):
    prices = spark.createDataFrame([("A", Decimal(10))], S.PRICES)
    asked = spark.createDataFrame(
        [(0, "A", 11.0, 1), (1, "A", 9.0, 0), (2, "A", 10.0, 1), (3, "A", 9.0, 1), (4, "B", 1.0, 0)],
        "id int, symbol string, price double, kind int",
    )
    armed = alerts.arm_alerts(asked, prices, "2024-01-01").filter("active_since is not null")
    assert sorted(r.id for r in armed.collect()) == [0, 1]


INSTRUMENT_ROWS = [(1, "AUSDT", "A", "USDT"), (2, "USDCB", "USDC", "B"), (3, "AB", "A", "B"), (4, "CA", "C", "A"), (5, "CD", "C", "D"), (6, "AUSDC", "A", "USDC")]


def ticker_rows(spark, values):
    names = S.TICKER_24H.names
    out = []
    for symbol_id, at, last, volume, quote in values:
        row = dict.fromkeys(names, Decimal(0)) | {
            "symbol_id": symbol_id,
            "open_time": at,
            "close_time": at + 1,
            "last_price": None if last is None else Decimal(str(last)),
            "volume": Decimal(volume),
            "quote_volume": Decimal(quote),
        }
        out.append(tuple(row[n] for n in names))
    return spark.createDataFrame(out, S.TICKER_24H)


def test_usd_volume_rules(spark):
    instruments = spark.createDataFrame(INSTRUMENT_ROWS, "symbol_id int, symbol string, base_asset string, quote_asset string")
    ticker = ticker_rows(
        spark,
        [(1, 10, 2, 5, 50), (1, 20, 3, 5, 60), (6, 20, 4, 1, 1), (2, 10, 1, 7, 70), (3, 10, 1, 4, 9), (4, 10, 1, 4, 9), (5, 10, 1, 4, 9), (3, 11, None, 4, 9), (3, 12, 0, 4, 9)],
    )
    got = {(r.symbol, r.open_time): r.usd_volume for r in tickers.usd_volume(ticker, instruments).collect()}
    # Price of A: 3 and 4 are equally new, AUSDC sorts before AUSDT.
    assert got == {
        ("AUSDT", 10): 50, ("AUSDT", 20): 60, ("AUSDC", 20): 1, ("USDCB", 10): 7, ("AB", 10): 16,
        ("CA", 10): 36, ("CD", 10): None, ("AB", 11): None, ("AB", 12): None,
    }
    newest = tickers.latest_usd_volume(ticker, instruments, "AUSDT").collect()
    assert [(r.open_time, r.usd_volume) for r in newest] == [(20, 60)]
    series = tickers.symbol_volume_series(ticker, instruments, "ausdt")
    assert series.count() == 2
    assert tickers.most_popular(ticker, instruments, 2).first().symbol == "AUSDT"


def test_support_levels(spark):
    at = as_utc("2024-01-01")
    levels = [("A", "bid", at, Decimal(p), Decimal(v)) for p, v in ((1, 6), (2, 0), (3, 6), (4, 8), (5, 1))]
    levels += [("A", "bid", at + dt.timedelta(hours=1), Decimal(5), Decimal(9)), ("A", "ask", at, Decimal(3), Decimal(99))]
    frame = spark.createDataFrame(levels, S.BOOK)
    got = {r.part: r for r in book.support_levels(frame, 10).collect()}
    assert sorted(got) == [1, 2, 3] and got[1].count_prices == 2 and got[1].price_support == 2.0
    assert got[3].price_max == 5 and got[3].max_time == dt.datetime(2024, 1, 1, 1)
    early = {r.part: r for r in book.support_levels(frame, 10, finish="2024-01-01T00:30:00").collect()}
    assert early[2].total_volume == 9 and 3 not in early
    assert [r.part for r in book.top_support(frame, 10, k=1).collect()] == [3]


def test_stats_without_low_price(spark):
    at = to_epoch_ms("2024-01-10")
    low = lambda v: {"low_price": v}
    frame = bars_frame(spark, [bar("A", "1d", at, 10, 2, **low(8)), bar("A", "1d", at - S.DAY_MS, 10, 2, **low(0)), bar("A", "1d", at - 40 * S.DAY_MS, 10, 2)])
    row = stats.daily_stats(frame, "2024-01-20").first()
    assert (row["count"], float(row.avg_volatility), int(row.total_amount), int(row.avg_per_day)) == (2, 25.0, 40, 20)


def test_planning(spark):
    at = to_epoch_ms("2024-01-10")
    held = bars_frame(spark, [bar("A", "1d", at, 1, 1), bar("A", "1d", at - S.DAY_MS, 1, 1), bar("A", "1m", at, 1, 1)])
    tracked = spark.createDataFrame([("A", "1d"), ("B", "1h"), ("B", "1M")], S.TRACKED)
    now = "2024-01-10T12:00:00"
    plan = {(r.symbol, r.period): (r.start_time, r.due) for r in ingest.ingest_plan(tracked, S.period_dim(spark), held, now).collect()}
    assert plan[("A", "1d")] == (at, False)
    assert plan[("B", "1h")] == (to_epoch_ms(now) - 3000 * S.HOUR_MS, True)
    assert plan[("B", "1M")] == (to_epoch_ms("1774-01-10T12:00:00"), True)
    later = ingest.ingest_plan(tracked, S.period_dim(spark), held, "2024-01-12", default_start=ingest.default_month_start("2024-03-31"))
    plan = {(r.symbol, r.period): (r.start_time, r.due) for r in later.collect()}
    assert plan[("A", "1d")] == (at, True) and plan[("B", "1h")][0] == to_epoch_ms("2024-02-29")
    watched = spark.createDataFrame([("B", 2), ("A", 1)], S.WATCHED)
    cursor = ingest.ingest_cursor(watched, held)
    assert [tuple(r) for r in cursor.collect()] == [("A", at), ("B", 0)]
    starts = dict(map(tuple, ingest.history_start(cursor, "2024-02-29").collect()))
    assert starts == {"A": at, "B": to_epoch_ms("2022-03-01")}


def test_indicator_registry(spark):
    frame = bars_frame(spark, random_rows(5, {"HOT": 120, "B": 9}))
    assert {"MAC", "Bollinger"} <= set(indicators.indicators())
    assert indicators.run("MAC", frame, pairs=[(10, 6)]).count() > 0

    def momentum(pdf: pd.DataFrame) -> pd.Series:
        closes = pdf["close_price"].astype(float)
        return closes - closes.shift(3)

    indicators.register("Momentum", indicators.pandas_indicator(momentum, 3, "momentum", T.DoubleType()))
    got = indicators.run("Momentum", frame, blocks=Blocks(4, 10)).select("symbol", "open_time", "momentum")
    from pyspark.sql import Window

    w = Window.partitionBy("symbol").orderBy("open_time")
    close = F.col("close_price").cast("double")
    expected = {(r[0], r[1]): r[2] for r in frame.select("symbol", "open_time", (close - F.lag(close, 3).over(w))).collect()}
    rows_got = {(r[0], r[1]): r[2] for r in got.collect()}
    assert rows_got.keys() == expected.keys()
    for key, value in expected.items():
        if value is None:
            assert rows_got[key] is None or rows_got[key] != rows_got[key]
        else:
            assert abs(rows_got[key] - value) < 1e-9


def test_scratch_follows_the_session(spark, tmp_path):
    def asked(master, **settings):
        conf = SimpleNamespace(get=lambda key, default: settings.get("folder", default))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert session.scratch_dir(asked("yarn", folder="hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError):
        session.scratch_dir(asked("yarn"), "x")
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")


def test_views_and_sql_lookup(spark, tables):
    from tickloom.functions.sql import register_functions, register_symbol_lookup
    from tickloom.plans import views
    from tickloom.plans.fixtures import AS_OF_EVENTS

    register_functions(spark)
    register_symbol_lookup(spark, tables.instruments)
    names = spark.createDataFrame([("p3",), ("nobody",)], "name string")
    names.createOrReplaceTempView("asked")
    found = spark.sql("SELECT name, get_symbol_id(name) AS id FROM asked").collect()
    assert {r.name: r.id for r in found} == {"p3": 3, "nobody": None}
    assert spark.sql("SELECT dayago() < current_timestamp() AS past").first().past
    views.register_bar_views(tables.bars("1h"), AS_OF_EVENTS)
    views.register_ticker_views(tables.ticker24h, tables.instruments)
    views.register_book_views(tables.book)
    assert spark.sql("SELECT count(*) FROM bars_window WHERE prev_volume IS NULL").first()[0] == 5
    assert spark.sql("SELECT count(*) FROM hourly_stats").first()[0] == 5
    assert spark.sql("SELECT count(*) FROM boll1m").first()[0] == 0
    top = spark.sql("SELECT * FROM max_usd_volume LIMIT 1").first()
    assert top.max_usd_volume == spark.sql("SELECT round(max(usd_volume)) FROM symbol_usd_volume").first()[0]
    assert spark.sql("SELECT count(*) FROM avg_volume_per_hour").first()[0] == 1
    assert spark.sql("SELECT count(*) FROM support_b").first()[0] > 0
    assert spark.sql("SELECT count(DISTINCT symbol_id) = count(*) FROM last_ticker_snapshot").first()[0]


def test_landed_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"a":1}\n{"a":2}\n')
    stream = storage.stream_landed_text(spark, str(tmp_path / "in"), files_per_batch=1)
    done = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    done.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.value for r in got.collect()) == ['{"a":1}', '{"a":2}'] and got.filter("seq IS NULL").count() == 0
