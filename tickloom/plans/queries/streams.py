"""Streaming jobs, drained from files; each must equal its batch operator."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import schemas as S
from tickloom.operators import bars
from tickloom.operators import book as books
from tickloom.operators.bars import ohlc_parts
from tickloom.plans.fixtures import AS_OF_EVENTS, Tables, with_ctes
from tickloom.plans.queries.aggregates import OHLC_SQL, levels_sql
from tickloom.plans.queries.base import BAR_SQL, ORACLES, query
from tickloom.plans.queries.joins import ARCHIVE_SQL, HIT_SQL
from tickloom.plans.queries.sources import DEPTH_SQL
from tickloom.plans.queries.windows import PAIRS, RULE_SQL, folded_sql, grid_report
from tickloom.session import scratch_dir
from tickloom.sources import storage
from tickloom.streaming import alerts as alert_jobs
from tickloom.streaming import feeds, ohlc
from tickloom.streaming import signals as signal_jobs


def event_stream(t: Tables) -> DataFrame:
    """The events table as a file stream (a pattern, as it may be one file or a folder)."""
    schema = t.read("events").schema
    return t.spark.readStream.schema(schema).parquet(f"{t.sf_dir}/{{events.parquet}}")


@query("stream_bars", with_ctes(f"SELECT {BAR_SQL} FROM bars_1h", "bars_1h"))
def stream_bars(t: Tables):
    landed, path = scratch_dir(t.spark, "messages"), scratch_dir(t.spark, "stream-bars")
    t.as_bar_events(t.bars("1h")).write.parquet(landed)
    messages = t.spark.readStream.schema("value string, seq bigint").parquet(landed)
    feeds.stream_bars(messages, path, ingest_order=["seq"]).awaitTermination()
    return feeds.read_stream_bars(t.spark, path)


@query(
    "stream_bars_days",
    with_ctes(f"SELECT {BAR_SQL} FROM bars_1h WHERE open_time >= 1705276800000 AND open_time < 1705622400000", "bars_1h"),
)
def stream_bars_days(t: Tables):
    """Bars sent twice over three batches and compacted after the first two: four days of them."""
    landed, path = scratch_dir(t.spark, "messages"), scratch_dir(t.spark, "stream-bars")
    hours = t.bars("1h")
    partial = hours.where("open_time % 7200000 = 0").withColumn("volume", F.lit(0).cast(S.VOLUME))
    parts = [partial, hours.where("open_time < 1705500000000"), hours.where("open_time >= 1705500000000")]
    for number, part in enumerate(parts):
        t.as_bar_events(part).coalesce(1).write.mode("append").parquet(landed)
        messages = t.spark.readStream.schema("value string, seq bigint").parquet(landed)
        feeds.stream_bars(messages, path, ingest_order=["seq"]).awaitTermination()
        if number == 1:
            feeds.compact_stream_bars(t.spark, path, number)
    day = F.col("day")
    return feeds.read_stream_bars(t.spark, path, (F.col("period") == "1h") & day.between("2024-01-15", "2024-01-18"))


@query("late_data", with_ctes(f"SELECT {BAR_SQL} FROM bars_1h", "bars_1h"))
def late_data(t: Tables):
    """Unfinished bars first, then every bar again, complete and out of time order."""
    landed, path = scratch_dir(t.spark, "messages"), scratch_dir(t.spark, "late-data")
    partial = t.bars("1h").withColumn("volume", F.lit(0).cast(S.VOLUME))
    for drop in (partial, t.bars("1h")):
        t.as_bar_events(drop).write.mode("append").parquet(landed)
        messages = t.spark.readStream.schema("value string, seq bigint").parquet(landed)
        feeds.stream_bars(messages, path, ingest_order=["seq"]).awaitTermination()
    return feeds.read_stream_bars(t.spark, path)


@query(
    "stream_depth",
    with_ctes(
        """SELECT symbol, side, ptime, price, arg_max(volume, ts) AS volume FROM sent GROUP BY symbol, side, ptime, price""",
        "ticks",
        extra={
            "sent": DEPTH_SQL.replace("AS volume FROM ticks\n", "AS volume, ts FROM ticks\n").replace(
                "CAST(qty AS DOUBLE) FROM ticks", "CAST(qty AS DOUBLE), ts FROM ticks"
            )
        },
    ),
)
def stream_depth(t: Tables):
    path = scratch_dir(t.spark, "stream-depth")
    messages = t.as_depth(t.as_ticks(event_stream(t)))
    feeds.stream_depth(messages, path, ingest_order=["seq", "id"]).awaitTermination()
    return feeds.read_stream_levels(t.spark, path)


@query(
    "stream_depth_registered",
    with_ctes("""SELECT DISTINCT upper(symbol) AS symbol, CAST(0 AS DOUBLE) AS price FROM ticks WHERE upper(symbol) >= 'P'""", "ticks"),
)
def stream_depth_registered(t: Tables):
    """Symbols that a depth feed brings and the price table lacks."""
    path = scratch_dir(t.spark, "stream-depth")
    prices = t.prices.select(F.upper("symbol").alias("symbol"), "price").where("symbol < 'P'")
    messages = t.as_depth(t.as_ticks(event_stream(t)))
    feeds.stream_depth(messages, path, ingest_order=["seq", "id"], prices=prices).awaitTermination()
    return storage.read_log(t.spark, f"{path}/registered", S.PRICES).select("symbol", "price").distinct()


FINISHES = ("2024-01-06 23:59:59", "2024-01-12 06:30:00", "2024-01-20 00:00:00", "2024-03-01 00:00:00")


def _levels_at_sql() -> str:
    books = {f"book_{k}": f"SELECT * FROM book WHERE ptime <= TIMESTAMP '{f}'" for k, f in enumerate(FINISHES)}
    parts = [
        f"SELECT upper(symbol) AS symbol, TIMESTAMP '{f}' AS finish, * EXCLUDE (symbol) FROM ({levels_sql(500).replace('FROM book ', f'FROM book_{k} ')})"
        for k, f in enumerate(FINISHES)
    ]
    return with_ctes(" UNION ALL ".join(parts), "book", extra=books)


@query("support_levels_at", _levels_at_sql())
def support_levels_at(t: Tables):
    """Support at four moments from a feed of three batches, in no order of time, with two snapshots between them."""
    landed, path = scratch_dir(t.spark, "depth"), scratch_dir(t.spark, "stream-depth")
    level = F.pmod(F.xxhash64("symbol", F.date_trunc("second", "ts"), F.round("price", 0)), F.lit(30))
    wrong = t.ticks.where(level % 5 == 0).withColumn("qty", (F.col("qty") + 1).cast(S.PRICE))
    parts = [t.ticks.where(level < 10).unionByName(wrong.where(level >= 10)), t.ticks.where(level.between(10, 19)), t.ticks.where(level > 19)]
    days = {0: dt.date(2024, 1, 10), 1: dt.date(2024, 1, 18)}
    for number, part in enumerate(parts):
        t.as_depth(part).write.mode("append").parquet(landed)
        messages = t.spark.readStream.schema("value string, seq timestamp, id bigint").parquet(landed)
        feeds.stream_depth(messages, path, ingest_order=["seq", "id"]).awaitTermination()
        if number in days:
            feeds.snapshot_stream_levels(t.spark, path, days[number], number)
    found = [
        books.support_levels(feeds.read_stream_book(t.spark, path, f), 500).withColumn("finish", F.lit(f).cast("timestamp"))
        for f in FINISHES
    ]
    return reduce(DataFrame.unionByName, found)


@query("stream_ohlc", with_ctes(OHLC_SQL + "bars_1h", "bars_1h"))
def stream_ohlc(t: Tables):
    path = scratch_dir(t.spark, "stream-ohlc")
    ticks = t.as_ticks(event_stream(t))
    ohlc.stream_ohlc(ticks, S.HOUR_MS, path, order=("ts", "id")).awaitTermination()
    return ohlc.read_ohlc(t.spark, path)


MONTHS_SQL = """SELECT symbol, date_trunc('month', ts) AS period_start, CAST(arg_min(price, row(ts, id)) AS DOUBLE) AS open_price,
  CAST(max(price) AS DOUBLE) AS high_price, CAST(min(price) AS DOUBLE) AS low_price, CAST(arg_max(price, row(ts, id)) AS DOUBLE) AS close_price
FROM ticks GROUP BY ALL"""


@query("stream_ohlc_late", with_ctes(MONTHS_SQL, "ticks"))
def stream_ohlc_late(t: Tables):
    """Months of ticks that come in no order over three batches, a tenth of them twice."""
    landed, path = scratch_dir(t.spark, "ticks"), scratch_dir(t.spark, "stream-ohlc")
    ticks = t.ticks.select("symbol", "ts", "id", "price")
    for part in range(3):
        ticks.where(f"hash(id) % 3 IN ({part}, {-part}) OR id % 10 = 0").coalesce(1).write.mode("append").parquet(landed)
        stream = t.spark.readStream.schema(ticks.schema).parquet(landed)
        ohlc.stream_ohlc(stream, 30 * S.DAY_MS, path, order=("ts", "id")).awaitTermination()
        if part == 1:
            ohlc.compact_ohlc(t.spark, path, part)
    return ohlc.read_ohlc(t.spark, path)


@query("merge_ohlc", with_ctes(OHLC_SQL + "bars_1h", "bars_1h"))
def merge_ohlc(t: Tables):
    """Stored parts of bars, met by the parts of later ticks."""
    cut = lambda rule: ohlc_parts(t.ticks.where(rule), S.HOUR_MS, order=("ts", "id"))
    merged = bars.merge_ohlc(cut("id % 3 = 0").unionByName(cut("id % 3 = 1")))
    return bars.merge_ohlc(merged.unionByName(cut("id % 3 = 2"))).select(*ohlc.OHLC.names)


@query("stream_alerts", with_ctes(ARCHIVE_SQL, "alerts", "prices", extra={"hit": HIT_SQL}))
def stream_alerts(t: Tables):
    path = scratch_dir(t.spark, "stream-alerts")
    prices = t.as_ticks(event_stream(t)).select("symbol", "price", "ts", "id")
    alert_jobs.stream_alerts(
        prices, lambda: t.alerts, path, ingest_order=["ts", "id"], triggered_at=AS_OF_EVENTS
    ).awaitTermination()
    return alert_jobs.fired_alerts(t.spark, path)


MOVES_SQL = """SELECT k, symbol, arg_max(price, row(id % 3, ts, id)) AS price
FROM ticks JOIN (SELECT unnest([0, 1, 2]) AS k) ON id % 3 <= k GROUP BY k, symbol"""
HIT_IN_TURN_SQL = """SELECT * EXCLUDE (k, first_k) FROM (
  SELECT a.*, m.price AS last_price, m.k, min(m.k) OVER (PARTITION BY a.id) AS first_k
  FROM alerts a JOIN moves m USING (symbol)
  WHERE active_since IS NOT NULL AND 3 * a.id <= (m.k + 1) * (SELECT max(id) FROM alerts)
    AND CASE kind WHEN 0 THEN m.price - a.price WHEN 1 THEN a.price - m.price END <= 0)
WHERE k = first_k"""


@query(
    "stream_alerts_moves",
    with_ctes(ARCHIVE_SQL, "alerts", "ticks", extra={"moves": MOVES_SQL, "hit": HIT_IN_TURN_SQL}),
)
def stream_alerts_moves(t: Tables):
    """Prices that move over three batches while alerts are added; those that wait are compacted in between."""
    landed, path = scratch_dir(t.spark, "ticks"), scratch_dir(t.spark, "stream-alerts")
    ticks = t.ticks.select("symbol", "price", "ts", "id")
    last_id = t.alerts.agg(F.max("id")).first()[0] or 0
    for number in range(3):
        ticks.where(F.col("id") % 3 == number).coalesce(1).write.mode("append").parquet(landed)
        stream = t.spark.readStream.schema(ticks.schema).parquet(landed)
        alerts = t.alerts.where(3 * F.col("id") <= last_id * (number + 1))
        alert_jobs.stream_alerts(
            stream, lambda held=alerts: held, path, ingest_order=["ts", "id"], triggered_at=AS_OF_EVENTS
        ).awaitTermination()
        if number == 1:
            alert_jobs.compact_alerts(t.spark, path, number)
    return alert_jobs.fired_alerts(t.spark, path)


def _stream_signals_sql() -> str:
    sizes = S.SIGNAL_PERIOD_MINUTES
    window = "(PARTITION BY symbol, size ORDER BY bar_index ROWS BETWEEN {} PRECEDING AND {})"

    def mean(column: str, oldest: int, newest: int) -> str:
        rows = window.format(oldest, f"{newest} PRECEDING" if newest else "CURRENT ROW")
        return f"CAST(sum({column}) OVER {rows} AS DOUBLE) / {oldest - newest + 1}.0"

    parts = [
        f"""SELECT symbol, size, bar_index, open_time, volume, {long_term} AS long_term, {short_term} AS short_term,
  {mean('close_price', short_term, 2)} AS s1, {mean('close_price', short_term - 1, 1)} AS s2,
  {mean('close_price', long_term, 2)} AS l1, {mean('close_price', long_term - 1, 1)} AS l2,
  {mean('volume', long_term - 1, 0)} AS vol_avg, {mean('volume', 2, 0)} AS vol3_avg FROM folded"""
        for long_term, short_term in PAIRS
    ]
    index = " ".join(f"WHEN {n} THEN {i}" for i, n in enumerate(sizes))
    return with_ctes(
        f"""SELECT open_time, symbol, CASE size {index} END AS period,
  CAST(CASE trade_signal WHEN 'SELL' THEN -1 ELSE 1 END * (long_term * 4096 + short_term) AS INTEGER) AS indicator_id,
  CAST(volume AS DOUBLE) AS volume, vol_avg, vol3_avg
FROM (SELECT *, {RULE_SQL} AS trade_signal FROM pairs WHERE bar_index >= long_term + 2)
WHERE trade_signal IS NOT NULL""",
        "minute_bars",
        extra={"folded": folded_sql(sizes), "pairs": " UNION ALL ".join(parts)},
    )


@query("stream_signals", _stream_signals_sql())
def stream_signals(t: Tables):
    landed, path = scratch_dir(t.spark, "minutes"), scratch_dir(t.spark, "stream-signals")
    t.minute_bars.write.parquet(landed)
    minutes = t.spark.readStream.schema(S.BARS).parquet(landed)
    signal_jobs.stream_signals(minutes, path, PAIRS).awaitTermination()
    return signal_jobs.read_stream_signals(t.spark, path)


def resent_minutes(t: Tables):
    """Three batches: wrong minutes and gaps, then the right ones and newer minutes, then those left out."""
    minutes = t.minute_bars
    late, wrong = F.pmod(F.xxhash64("symbol", "open_time"), F.lit(11)) == 0, F.col("num_trades") % 2 == 0
    early = F.col("open_time") < 1705622400000
    altered = minutes.where(early & ~late).withColumns({c: F.when(wrong, F.col(c) + 1).otherwise(F.col(c)).cast(S.BARS[c].dataType) for c in ("close_price", "volume")})
    yield altered
    yield minutes.where(~late & (~early | wrong))
    yield minutes.where(late)


def drained_signals(t: Tables, **options):
    landed, path = scratch_dir(t.spark, "minutes"), scratch_dir(t.spark, "stream-signals")
    for part in resent_minutes(t):
        part.write.mode("append").parquet(landed)
        minutes = t.spark.readStream.schema(S.BARS).parquet(landed)
        signal_jobs.stream_signals(minutes, path, **options).awaitTermination()
    return signal_jobs.read_stream_signals(t.spark, path)


@query("stream_signals_resent", _stream_signals_sql())
def stream_signals_resent(t: Tables):
    """Signals that are taken back when minutes are sent again or come late."""
    return drained_signals(t, pairs=PAIRS)


@query("stream_grid_resent", ORACLES["mac_grid_signals"])
def stream_grid_resent(t: Tables):
    """The whole grid over re-sent and late minutes, reported like the batch job."""
    return grid_report(drained_signals(t))
