"""Projections, filters and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom import schemas as S
from tickloom.functions import signals, times
from tickloom.functions.sql import register_functions
from tickloom.operators import tickers
from tickloom.plans.fixtures import AS_OF_EVENTS, Tables, with_ctes
from tickloom.plans.queries.base import BAR_SQL, as_double, query


@query(
    "ms_to_ts",
    with_ctes("SELECT symbol, open_time, make_timestamp(open_time * 1000) AS opened FROM minute_bars", "minute_bars"),
)
def ms_to_ts(t: Tables):
    return t.minute_bars.select("symbol", "open_time", times.ms_to_ts(F.col("open_time")).alias("opened"))


@query("ts_to_ms", with_ctes("SELECT id, (epoch_us(ts) + 500) // 1000 AS ms FROM ticks", "ticks"))
def ts_to_ms(t: Tables):
    return t.ticks.select("id", times.ts_to_ms(F.col("ts")).alias("ms"))


@query(
    "time_bounds",
    with_ctes(
        "SELECT id, ts - INTERVAL 1 DAY AS day_ago, ts - INTERVAL 7 DAY AS week_ago FROM ticks", "ticks"
    ),
)
def time_bounds(t: Tables):
    ts = F.col("ts")
    return t.ticks.select("id", times.day_ago(ts).alias("day_ago"), times.week_ago(ts).alias("week_ago"))


_BINS = {"m5": (5 * S.MINUTE_MS, "5 minutes"), "h4": (4 * S.HOUR_MS, "4 hours"), "d3": (3 * S.DAY_MS, "3 days")}
_CALENDAR = {"d1": (S.DAY_MS, "day"), "w1": (7 * S.DAY_MS, "week"), "mon1": (30 * S.DAY_MS, "month")}


@query(
    "start_of_period",
    with_ctes(
        "SELECT id, "
        + ", ".join(
            [f"CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS {n}" for n, (_, unit) in _CALENDAR.items()]
            + [
                f"time_bucket(INTERVAL '{text}', ts, TIMESTAMP '2001-01-01') AS {n}"
                for n, (_, text) in _BINS.items()
            ]
        )
        + " FROM ticks",
        "ticks",
    ),
)
def start_of_period(t: Tables):
    wanted = {**_CALENDAR, **_BINS}
    return t.ticks.select(
        "id", *[times.start_of_period(F.col("ts"), ms).alias(n) for n, (ms, _) in wanted.items()]
    )


@query(
    "symbol_lookup",
    with_ctes(
        """SELECT 'p' || l_orderkey AS name, l_linenumber, i.symbol_id FROM lineitem
LEFT JOIN instruments i ON i.symbol = upper('p' || l_orderkey)""",
        "instruments",
    ),
)
def symbol_lookup(t: Tables):
    rows = t.read("lineitem").select(
        F.concat(F.lit("p"), F.col("l_orderkey").cast("string")).alias("name"), "l_linenumber"
    )
    return tickers.symbol_lookup(rows, t.instruments, "name")


@query(
    "trading_signal",
    """SELECT l_orderkey, l_linenumber, prev, last, CASE WHEN prev <= 15 AND last > 15 THEN 'BUY'
  WHEN prev >= 35 AND last < 35 THEN 'SELL' END AS trade_signal
FROM (SELECT l_orderkey, l_linenumber, l_quantity AS prev, l_quantity + l_discount * 200 - 10 AS last FROM lineitem)""",
)
def trading_signal(t: Tables):
    rows = t.read("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("prev"),
        (F.col("l_quantity") + F.col("l_discount") * 200 - 10).alias("last"),
    )
    rule = signals.trading_signal(F.col("prev"), F.col("last"), F.lit(15), F.lit(35))
    return rows.withColumn("trade_signal", rule)


TEXT_SQL = (
    "rtrim(CAST(close_price AS VARCHAR), '0') || '(' || "
    "CAST(CAST(round(volume, 0) AS BIGINT) AS VARCHAR) || ')'"
)


@query("format_price_volume", with_ctes(f"SELECT symbol, open_time, {TEXT_SQL} AS text FROM bars_1h", "bars_1h"))
def format_price_volume(t: Tables):
    text = signals.format_price_volume(F.col("close_price"), F.col("volume"))
    return t.bars("1h").select("symbol", "open_time", text.alias("text"))


@query(
    "pack_indicator_id",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS long_term, l_linenumber AS short_term, 0 AS kind,
  CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS signal,
  CAST(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * (l_quantity * 4096 + l_linenumber) AS INTEGER) AS indicator_id
FROM lineitem""",
)
def pack_indicator_id(t: Tables):
    sold = F.when(F.col("l_returnflag") == "R", F.lit(signals.SELL)).otherwise(F.lit(signals.BUY))
    packed = signals.pack_indicator_id(
        F.lit(0), F.col("l_quantity").cast("int"), F.col("l_linenumber"), sold
    )
    rows = t.read("lineitem").select("l_orderkey", "l_linenumber", packed.alias("indicator_id"))
    return rows.withColumns(signals.unpack_indicator_id(F.col("indicator_id")))


@query(
    "indicator_name",
    """SELECT l_linenumber - 1 AS kind, CASE l_linenumber WHEN 1 THEN 'MAC' WHEN 2 THEN 'MACD'
  WHEN 3 THEN 'Bollinger' ELSE '' END AS name, count(*) AS lines FROM lineitem GROUP BY l_linenumber""",
)
def indicator_name(t: Tables):
    kind = F.col("l_linenumber") - 1
    rows = t.read("lineitem").select(kind.alias("kind"), signals.indicator_name(kind).alias("name"))
    return rows.groupBy("kind", "name").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "period_duration",
    with_ctes(
        """SELECT symbol, open_time, period, CASE period WHEN '1h' THEN 3600000 WHEN '4h' THEN 14400000
  ELSE 86400000 END AS duration_ms, period AS named FROM (SELECT symbol, open_time, period FROM bars_1h
  UNION ALL SELECT symbol, open_time, period FROM bars_4h
  UNION ALL SELECT symbol, open_time, period FROM bars_1d)""",
        "bars_1h",
        "bars_4h",
        "bars_1d",
    ),
)
def period_duration(t: Tables):
    rows = t.bars("1h").unionByName(t.bars("4h")).unionByName(t.bars("1d"))
    length = S.period_to_ms(F.col("period"))
    return rows.select(
        "symbol", "open_time", "period", length.alias("duration_ms"), S.ms_to_period(length).alias("named")
    )


@query(
    "usd_asset_filter",
    with_ctes(
        "SELECT symbol, base_asset, quote_asset FROM instruments WHERE quote_asset LIKE '%USD%' OR base_asset LIKE '%USD%'",
        "instruments",
    ),
)
def usd_asset_filter(t: Tables):
    either = signals.usd_asset(F.col("quote_asset")) | signals.usd_asset(F.col("base_asset"))
    return t.instruments.filter(either).select("symbol", "base_asset", "quote_asset")


@query(
    "sql_functions",
    with_ctes(
        """SELECT id, (epoch_us(ts) + 500) // 1000 AS ms, make_timestamp((epoch_us(ts) + 500) // 1000 * 1000) AS back,
  ts - INTERVAL 1 DAY AS day_before, ts - INTERVAL 7 DAY AS week_before,
  CAST(date_trunc('week', ts) AS TIMESTAMP) AS week, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month,
  time_bucket(INTERVAL '3 hours', ts, TIMESTAMP '2001-01-01') AS hours3,
  CASE WHEN price <= 10 AND qty > 10 THEN 'BUY' WHEN price >= 90 AND qty < 90 THEN 'SELL' END AS signal
FROM ticks""",
        "ticks",
    ),
)
def sql_functions(t: Tables):
    register_functions(t.spark)
    t.ticks.createOrReplaceTempView("ticks")
    return t.spark.sql(
        """SELECT id, ts2ms(ts) AS ms, ms2ts(ts2ms(ts)) AS back, dayago(ts) AS day_before,
          weekago(ts) AS week_before, start_of_period(ts, INTERVAL '7' DAY) AS week,
          start_of_period(ts, INTERVAL '30' DAY) AS month, start_of_period(ts, INTERVAL '3' HOUR) AS hours3,
          trading_signal(price, qty, 10, 90) AS signal
        FROM ticks"""
    )


_RANGE_FROM = times.to_epoch_ms(AS_OF_EVENTS) - 10 * S.DAY_MS


@query("range_filter", with_ctes(f"SELECT {BAR_SQL} FROM bars_1h WHERE open_time >= {_RANGE_FROM}", "bars_1h"))
def range_filter(t: Tables):
    return t.bars("1h").filter(F.col("open_time") >= _RANGE_FROM)


@query(
    "symbol_volume_series",
    with_ctes(
        f"""SELECT make_timestamp(open_time // 1000 * 1000000) AS added_at, symbol_id, {as_double('volume')}
FROM ticker24h""",
        "ticker24h",
    ),
)
def symbol_volume_series(t: Tables):
    return tickers.symbol_volume_series(t.ticker24h, t.instruments)
