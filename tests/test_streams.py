"""Streams over several files equal their batch operators."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import bars_frame, random_rows
from tests.test_messages import EVENT
from tickloom import schemas as S
from tickloom.functions.times import as_utc
from tickloom.operators import bars as bar_ops
from tickloom.operators import crossover
from tickloom.operators.alerts import alerts_hit
from tickloom.sources import storage
from tickloom.streaming import alerts as alert_jobs
from tickloom.streaming import feeds, ohlc
from tickloom.streaming import signals as signal_jobs


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def land(frame, path, parts, order):
    """Write a frame as files in time order, one file per part, and stream them one by one."""
    import time

    found = frame.orderBy(order).collect()
    step = -(-len(found) // parts)
    spark = frame.sparkSession
    for i in range(parts):
        spark.createDataFrame(found[i * step : (i + 1) * step], frame.schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)  # files are taken in the order of their times
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_bars_feed(spark, tmp_path):
    feed = [(EVENT.replace('"v":"1000"', f'"v":"{v}"'), seq) for v, seq in ((1, 1), (2, 3), (3, 2))]
    feed.append(("{broken", 9))
    path = str(tmp_path / "out")
    stream = land(spark.createDataFrame(feed, "value string, seq bigint"), str(tmp_path / "in"), 1, "seq")
    feeds.stream_bars(stream, path, ingest_order=["seq"]).awaitTermination()
    got = storage.latest_from_log(spark, f"{path}/bars", S.BARS).collect()
    assert [int(r.volume) for r in got] == [2]
    assert spark.read.parquet(f"{path}/rejects").count() == 1


def test_late_bar_replaces(spark, tmp_path):
    feed = [(EVENT.replace('"v":"1000"', f'"v":"{v}"').replace('"t":100', f'"t":{t}'), s) for s, (t, v) in enumerate([(100, 1), (10**12, 2), (100, 3)])]
    path = str(tmp_path / "out")
    stream = land(spark.createDataFrame(feed, "value string, seq bigint"), str(tmp_path / "in"), 3, "seq")
    feeds.stream_bars(stream, path, ingest_order=["seq"]).awaitTermination()
    got = storage.latest_from_log(spark, f"{path}/bars", S.BARS)
    assert {r.open_time: int(r.volume) for r in got.collect()} == {100: 3, 10**12: 2}


def test_depth_feed(spark, tmp_path):
    feed = [
        ('{"E":1000,"s":"a","b":[["1","1"]],"a":[["2","1"],["3","1"]]}', 1),
        ('{"E":1900,"s":"A","b":[["1","5"]],"a":[]}', 2),
        ('{"E":2000,"s":"A","b":[["1","0"]]}', 3),
    ]
    path = str(tmp_path / "out")
    stream = land(spark.createDataFrame(feed, "value string, seq bigint"), str(tmp_path / "in"), 2, "seq")
    feeds.stream_depth(stream, path, ingest_order=["seq"]).awaitTermination()
    levels = storage.latest_from_log(spark, f"{path}/levels", S.BOOK, S.BOOK_KEY)
    got = {(r.side, r.ptime.second, int(r.price)): int(r.volume) for r in levels.collect()}
    assert got == {("bid", 1, 1): 5, ("ask", 1, 2): 1, ("ask", 1, 3): 1, ("bid", 2, 1): 0}
    assert spark.read.parquet(f"{path}/counts").agg(F.sum("bids_affected"), F.sum("asks_affected")).first() == (3, 2)


DURATIONS = [S.HOUR_MS, 5 * S.HOUR_MS, S.DAY_MS, 3 * S.DAY_MS, 7 * S.DAY_MS, 30 * S.DAY_MS]


@pytest.mark.parametrize("duration", DURATIONS)
def test_ohlc_stream(spark, tables, tmp_path, duration):
    ticks = tables.ticks.select("symbol", "ts", "id", "price")
    stream = land(ticks, str(tmp_path / "in"), 4, "ts")
    path = str(tmp_path / "out")
    ohlc.stream_ohlc(stream, duration, path, order=("ts", "id")).awaitTermination()
    expected = bar_ops.ohlc_by_clock(ticks, duration, order=("ts", "id"))
    assert rows(ohlc.read_ohlc(spark, path)) == rows(expected)


def test_ohlc_stream_takes_ticks_of_any_lateness_and_twice(spark, tables, tmp_path):
    ticks = tables.ticks.select("symbol", "ts", "id", "price")
    again = ticks.unionByName(ticks.where("id % 5 = 0"))
    stream = land(again.withColumn("mix", F.xxhash64("id", "price")), str(tmp_path / "in"), 4, ["mix", "id"])
    path = str(tmp_path / "out")
    ohlc.stream_ohlc(stream.drop("mix"), 30 * S.DAY_MS, path, order=("ts", "id")).awaitTermination()
    expected = rows(bar_ops.ohlc_by_clock(ticks, 30 * S.DAY_MS, order=("ts", "id")))
    assert rows(ohlc.read_ohlc(spark, path)) == expected
    for upto in (1, 3):  # parts merged once for all, in two steps
        ohlc.compact_ohlc(spark, path, upto)
        assert rows(ohlc.read_ohlc(spark, path)) == expected


def test_ohlc_without_symbol_or_time(spark, tmp_path):
    feed = spark.createDataFrame(
        [("A", as_utc("2024-01-01"), 1, Decimal(1)), ("A", None, 2, Decimal(2)), (None, as_utc("2024-01-01"), 3, Decimal(3)), ("A", as_utc("2024-01-01T00:30:00"), 4, None)],
        "symbol string, ts timestamp, id bigint, price decimal(18,8)",
    )
    path = str(tmp_path / "out")
    ohlc.stream_ohlc(land(feed, str(tmp_path / "in"), 2, "id"), S.HOUR_MS, path, order=("ts", "id")).awaitTermination()
    batch = bar_ops.ohlc_by_clock(feed.where("symbol IS NOT NULL AND ts IS NOT NULL"), S.HOUR_MS, order=("ts", "id"))
    assert rows(ohlc.read_ohlc(spark, path)) == rows(batch)


def test_alert_stream_fires_once(spark, tmp_path):
    at = as_utc("2024-01-01")
    held = spark.createDataFrame(
        [(1, 7, "A", 5.0, 0, at, at), (2, 7, "A", 20.0, 1, at, at), (3, 7, "B", 1.0, 1, at, None)], S.ALERTS
    )
    prices = spark.createDataFrame(
        [("A", Decimal(10), 1), ("A", Decimal(4), 2), ("A", Decimal(3), 3), ("A", Decimal(25), 4), ("B", Decimal(9), 5)],
        "symbol string, price decimal(18,8), seq bigint",
    )
    path = str(tmp_path / "out")
    stream = land(prices, str(tmp_path / "in"), 5, "seq")
    alert_jobs.stream_alerts(stream, lambda: held, path, ingest_order=["seq"], triggered_at="2024-02-01").awaitTermination()
    fired = {r.id: float(r.last_price) for r in alert_jobs.fired_alerts(spark, path).collect()}
    assert fired == {1: 4.0, 2: 25.0}
    assert [r.id for r in alert_jobs.active_alerts(spark, held, path).collect()] == [3]
    # In one batch the newest price alone counts, as in the batch operator.
    newest = spark.createDataFrame([("A", Decimal(25))], S.PRICES)
    assert [r.id for r in alerts_hit(held, newest).collect()] == [2]


def test_alerts_wait_by_threshold(spark, tmp_path):
    """Random prices and alerts, added and removed on the way: as if every alert were tested in every batch."""
    rng, at, path, landed = random.Random(7), as_utc("2024-01-01"), str(tmp_path / "out"), str(tmp_path / "in")
    schema = "symbol string, price decimal(18,8), seq bigint"
    table, current, gone, expected, last_id = {}, {}, set(), {}, 0
    for number in range(5):
        for _ in range(60):
            last_id += 1
            price = rng.choice([rng.uniform(-1, 3), rng.uniform(0, 2000), 9.0, 10.0, 1e-12, 1e300, float("inf")])
            table[last_id] = (last_id, 1, rng.choice("ABC"), price, rng.randrange(2), at, rng.choice([at, at, at, None]))
        for i in rng.sample(sorted(table), 10 if number else 0):
            del table[i]
        ticks = [(s, Decimal(rng.choice(["0", "0.5", "1", "2.5", "9", "10", "900", "1500"])), 10 * number + k) for k, s in enumerate("AB" if number % 2 else "ABC")]
        ticks.append(("A", None, 10 * number + 9))
        current |= {s: float(p) for s, p, _ in ticks if p is not None}
        for i, _, s, price, kind, _, since in table.values():
            if since and i not in gone and s in current and (price >= current[s] if kind == 0 else price <= current[s]):
                expected[i] = current[s]
                gone.add(i)
        spark.createDataFrame(ticks, schema).coalesce(1).write.mode("append").parquet(landed)
        held = spark.createDataFrame(list(table.values()), S.ALERTS)
        stream = spark.readStream.schema(schema).parquet(landed)
        alert_jobs.stream_alerts(stream, lambda: held, path, ingest_order=["seq"]).awaitTermination()
        if number in (1, 3):
            before = rows(alert_jobs.waiting_alerts(spark, path).select("id"))
            alert_jobs.compact_alerts(spark, path, number)
            assert rows(alert_jobs.waiting_alerts(spark, path).select("id")) == before
    fired = alert_jobs.fired_alerts(spark, path).collect()
    assert {r.id: float(r.last_price) for r in fired} == expected and len(fired) == len(expected)
    left = {r.id for r in alert_jobs.waiting_alerts(spark, path).collect()}
    assert {i for i, r in table.items() if r[6] and i not in gone} <= left and not left & gone


def test_bands_rise_with_prices(spark):
    rng = random.Random(3)
    prices = sorted([0.0, -1.0, 1e-9, 1e20, 1e300, float("inf"), *[m * 10.0**e for e in range(-12, 22) for m in (1, 0.9999999999999999, 2, 3, 9)], *[10 ** rng.uniform(-10, 21) for _ in range(500)]])
    found = [r.b for r in spark.createDataFrame([(p,) for p in prices], "p double").select(alert_jobs.price_band(F.col("p")).alias("b")).collect()]
    assert found == sorted(found) and found[0] == alert_jobs.FIRST_BAND and found[-1] == alert_jobs.LAST_BAND


def test_alerts_read_the_bands_that_were_crossed(spark, tmp_path):
    path, at = str(tmp_path / "out"), as_utc("2024-01-01")
    table = alert_jobs.waiting_table(path)
    held = [(i, 1, "A", float(i), i % 2, at, at, True) for i in range(1, 1000)]
    table.append(spark.createDataFrame(held, alert_jobs.WAITING), 0)
    moves = spark.createDataFrame([("A", Decimal(51), Decimal(45))], "symbol string, last_price decimal(18,8), before decimal(18,8)")
    kept = table.read(spark, alert_jobs.bands_crossed(moves))
    assert {r.id for r in kept.collect()} == {i for i in range(40, 60) if i % 2 == 1}
    found = alert_jobs.thresholds_crossed(kept.drop("waits"), moves)
    assert {r.id for r in found.collect()} == {47, 49, 51}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    assert scans and all(re.search(r"PartitionFilters: \[[^\]]*side#", x) and "archive" not in x for x in scans)


def signals_of(spark, minutes, pairs, sizes):
    """The batch job's result over all minutes at once."""
    folded = bar_ops.resample_by_count(minutes, sizes)
    if pairs is None:
        found = crossover.mac_grid(folded, position="bar_index", keys=("symbol", "size"), long_terms=(10, 14), short_terms=(6, 9))
    else:
        found = crossover.mac_signals(folded, pairs, position="bar_index", keys=("symbol", "size"))
    return rows(crossover.as_signals(found, sizes))


def drain_signals(spark, batches, tmp_path, pairs, sizes, compacted=(), compared=(), **options):
    """Stream one file after the other; compact after some batches, compare with the batch job after others and the last."""
    landed, path = str(tmp_path / "in"), str(tmp_path / "out")
    seen = {}
    for number, batch in enumerate(batches):
        bars_frame(spark, batch).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(S.BARS).parquet(landed)
        signal_jobs.stream_signals(
            stream, path, pairs, sizes=sizes, long_terms=(10, 14), short_terms=(6, 9), **options
        ).awaitTermination()
        seen.update({(r["symbol"], r["open_time"]): r for r in batch})
        if number in compacted:
            signal_jobs.compact_stream_signals(spark, path, number, minute_chunk=options["minute_chunk"])
            assert signal_jobs.signals_table(path).compacted_to(spark) == number
        if number not in compared and number < len(batches) - 1:
            continue
        expected = signals_of(spark, bars_frame(spark, list(seen.values())), pairs, sizes)
        assert rows(signal_jobs.read_stream_signals(spark, path)) == expected, number
    return path


def as_dicts(found):
    return [r if isinstance(r, dict) else r.asDict() for r in found]


def test_signal_stream_equals_batch(spark, tmp_path):
    minutes = bars_frame(spark, random_rows(11, {"HOT": 500, "B": 120}, gap=0.2))
    pairs, sizes = [(10, 6), (12, 9)], (1, 5, 10)
    path = str(tmp_path / "out")
    stream = land(minutes, str(tmp_path / "in"), 5, "open_time")
    signal_jobs.stream_signals(stream, path, pairs, sizes=sizes).awaitTermination()
    got = signal_jobs.read_stream_signals(spark, path)
    assert got.count() > 50 and rows(got) == signals_of(spark, minutes, pairs, sizes)


def resent(spark, seed):
    """Batches with the open minute again, changed old minutes, late minutes, a late symbol and nothing new."""
    found = as_dicts(bars_frame(spark, random_rows(seed, {"HOT": 260, "B": 90, "C": 40}, gap=0.1)).orderBy("open_time").collect())
    rng = random.Random(seed)
    late = [r for i, r in enumerate(found) if i % 37 == 5]
    soon = [r for r in found if r not in late]
    third = len(soon) // 3
    changed = lambda r: r | {"close_price": r["close_price"] + rng.randrange(-3, 4), "volume": r["volume"] + 1}
    return [
        [changed(r) for r in soon[:third]],
        soon[third - 1 : 2 * third] + soon[third // 2 : third // 2 + 4],
        [changed(r) for r in late[: len(late) // 2]] + [changed(soon[3])],
        soon[2 * third :] + late,
        soon[:third],
        [],
    ]


def test_signals_are_taken_back(spark, tmp_path):
    path = drain_signals(spark, resent(spark, 21), tmp_path, [(10, 6), (12, 9)], (1, 5, 10), minute_chunk=16, compacted=(1,), compared=(2, 3))
    changes = spark.read.schema("withdrawn boolean, batch bigint").parquet(f"{path}/changes")
    assert changes.where("withdrawn").select("batch").distinct().count() >= 2


def test_grid_signals_are_taken_back(spark, tmp_path):
    batches = resent(spark, 22)
    drain_signals(spark, [batches[0], batches[2], batches[1] + batches[3]], tmp_path, None, (1, 5), minute_chunk=16)


@pytest.mark.parametrize("pairs", [None, [(10, 6), (10, 7), (12, 9)]])
def test_signals_are_kept_by_bar_and_changes_by_signal(spark, tmp_path, pairs):
    """Signals of a bar are one stored row; the changes of a batch lead from the batch job's rows before to those after."""
    batches, sizes, seen = resent(spark, 23), (1, 5), {}
    batches = [batches[0], batches[2] + batches[1], batches[3]]
    path = drain_signals(spark, batches, tmp_path, pairs, sizes, minute_chunk=16)
    stored = spark.read.parquet(f"{path}/signals")
    assert stored.groupBy("batch", "symbol", "period", "open_time").count().where("count > 1").count() == 0
    changes = spark.read.parquet(f"{path}/changes")
    before, places = {}, [S.SIGNALS.names.index(c) for c in ("open_time", "symbol", "period", "indicator_id")]
    for number, batch in enumerate(batches):
        seen.update({(r["symbol"], r["open_time"]): r for r in batch})
        found = signals_of(spark, bars_frame(spark, list(seen.values())), pairs, sizes)
        after = {tuple(r[i] for i in places): r for r in found}
        got = lambda w: rows(changes.where(f"batch = {number} AND withdrawn = {w}").select(*S.SIGNALS.names))  # noqa: B023, E731
        assert got("true") == sorted((r for k, r in before.items() if k not in after), key=repr), number
        assert got("false") == sorted((r for k, r in after.items() if before.get(k) != r), key=repr), number
        before = after


def test_a_resent_minute_reads_the_last_runs_alone(spark, tmp_path):
    found = as_dicts(bars_frame(spark, random_rows(5, {"A": 200}, gap=0)).orderBy("open_time").collect())
    path = drain_signals(spark, [found, found[-2:]], tmp_path, [(10, 6)], (1, 5), minute_chunk=16)
    touched = spark.read.schema(S.BARS).parquet(f"{path}/merged/batch=1").count()
    assert touched <= 2 * 16
    assert spark.read.parquet(f"{path}/minutes/batch=1").count() == 2  # no other minute moved


def test_dates_are_utc():
    assert as_utc("2024-01-01").tzinfo is dt.timezone.utc
