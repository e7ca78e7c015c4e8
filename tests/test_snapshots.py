"""Snapshots: the state at any moment equals the reduction of all changes, however late, repeated or compacted."""

from __future__ import annotations

import datetime as dt
import random
import re

from tickloom.functions.times import as_utc
from tickloom.operators.book import latest_levels, support_levels
from tickloom.schemas import BOOK
from tickloom.streaming import feeds

START = as_utc("2024-01-01")


def moment(hours):
    return START + dt.timedelta(hours=hours)


def as_rows(df):
    return sorted(map(tuple, df.collect()))


def batch_of(rng, hours, count):
    rows = {}
    for _ in range(count):
        key = (rng.choice("AB"), rng.choice(("bid", "ask")), moment(rng.choice(hours)), rng.randrange(8))
        rows[key] = rng.randrange(4)
    return rows


def book_of(spark, known):
    return spark.createDataFrame([(*k, v) for k, v in known.items()], "symbol string, side string, ptime timestamp, price int, volume int").selectExpr(
        *[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in BOOK.fields]
    )


def plain_state(known, finish):
    state = {}
    for (symbol, side, ptime, price), volume in sorted(known.items(), key=lambda r: r[0][2]):
        if ptime <= finish:
            state[symbol, side, price] = (ptime, volume)
    return sorted((s, d, t.replace(tzinfo=None), float(p), float(v)) for (s, d, p), (t, v) in state.items())


def found_state(spark, path, finish):
    found = feeds.read_stream_book(spark, path, finish).select("symbol", "side", "ptime", "price", "volume")
    return sorted((s, d, t, float(p), float(v)) for s, d, t, p, v in map(tuple, found.collect()))


def test_the_book_at_any_moment(spark, tmp_path):
    """Batches of four days; later ones repeat keys with other volumes and bring levels older than the snapshots."""
    rng, path, known = random.Random(7), str(tmp_path / "feed"), {}
    table = feeds.levels_table(path)
    hours = [range(0, 40), range(20, 70), range(0, 96), range(0, 96)]
    finishes = [moment(h) for h in (-1, 0, 13, 24, 47, 48, 60, 95, 500)]
    for number, span in enumerate(hours):
        rows = batch_of(rng, span, 60)
        if number:  # the same moment again, with another volume
            rows |= {k: 9 + number for k in rng.sample(sorted(known), 8)}
        known |= rows
        table.append(book_of(spark, rows), number)
        for finish in finishes if number in (0, 3) else finishes[3::3]:
            assert found_state(spark, path, finish) == plain_state(known, finish)
        if number == 0:
            feeds.snapshot_stream_levels(spark, path, moment(24).date(), 0)
        if number == 1:
            feeds.snapshot_stream_levels(spark, path, moment(48).date(), 1)
            table.compact(spark, 1)
        if number == 2:
            feeds.snapshot_stream_levels(spark, path, moment(24).date(), 2)
            feeds.snapshot_stream_levels(spark, path, moment(24).date(), 2)  # a repeated job
    days = [moment(24).date(), moment(48).date()]
    assert feeds.book_snapshots(path).taken(spark) == [(days[0], 0), (days[0], 2), (days[1], 1)]
    book, finish = book_of(spark, known), moment(60)
    expected = as_rows(support_levels(latest_levels(book, finish), 3))
    assert as_rows(support_levels(feeds.read_stream_book(spark, path, finish), 3, finish)) == expected


def test_a_feed_without_levels_has_an_empty_book(spark, tmp_path):
    assert feeds.read_stream_book(spark, str(tmp_path / "none"), START).collect() == []
    feeds.snapshot_stream_levels(spark, str(tmp_path / "none"), START.date(), 0)
    assert feeds.read_stream_book(spark, str(tmp_path / "none"), moment(100)).collect() == []


def test_a_read_keeps_to_the_days_since_the_snapshot(spark, tmp_path):
    path = str(tmp_path / "feed")
    rows = {("A", "bid", moment(h), h % 7): h for h in range(24 * 6)}
    table = feeds.levels_table(path)
    table.append(book_of(spark, rows), 0)
    feeds.snapshot_stream_levels(spark, path, moment(24 * 4).date(), 0)
    asked = feeds.read_stream_book(spark, path, moment(24 * 4 + 5))
    read = {re.search(r"/levels(_state)?/.*?day=([0-9-]+)", f).groups() for f in asked.inputFiles()}
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert (("_state"), "2024-01-05") in read
    assert found_state(spark, path, moment(24 * 4 + 5)) == plain_state(rows, moment(24 * 4 + 5))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert re.search(r"PartitionFilters: \[.*day#\d+ <= 2024-01-05\).*day#\d+ >= 2024-01-05", plan)
