"""Parsers, storage, upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom import schemas as S
from tickloom.functions.times import to_epoch_ms
from tickloom.operators import ingest, keyed
from tickloom.operators.bars import bars_by_clock
from tickloom.operators.crossover import mac_signals
from tickloom.plans.fixtures import AS_OF_EVENTS, Tables, _bars_cte, with_ctes
from tickloom.plans.queries.base import BAR_SQL, as_double, query
from tickloom.plans.queries.windows import PAIRS, mac_sql
from tickloom.session import scratch_dir
from tickloom.sources import messages, storage


@query("parse_bar_pages", with_ctes(f"SELECT {BAR_SQL} FROM bars_1h", "bars_1h"))
def parse_bar_pages(t: Tables):
    return messages.parse_bar_pages(t.bar_pages()).select(*S.BARS.names)


@query("parse_bar_events", with_ctes(f"SELECT {BAR_SQL} FROM bars_1h", "bars_1h"))
def parse_bar_events(t: Tables):
    return messages.parse_bar_events(t.as_bar_events(t.bars("1h"))).select(*S.BARS.names)


DEPTH_SQL = """SELECT upper(symbol) AS symbol, 'bid' AS side, date_trunc('second', ts) AS ptime,
  CAST(round(price, 0) AS DOUBLE) AS price, CAST(qty AS DOUBLE) AS volume FROM ticks
UNION ALL SELECT upper(symbol), 'ask', date_trunc('second', ts),
  CAST(round(price, 0) AS DOUBLE) + 1, CAST(qty AS DOUBLE) FROM ticks"""


@query("parse_depth_updates", with_ctes(DEPTH_SQL, "ticks"))
def parse_depth_updates(t: Tables):
    return messages.parse_depth_updates(t.as_depth(t.ticks)).drop("seq", "id")


TICKER_NUMBERS = tuple(n for n in S.TICKER_24H.names if n not in ("symbol_id", "open_time", "close_time"))
TICKER_DERIVED = {
    "price_change": "last_price - open_price",
    "weighted_avg_price": "high_price",
    "prev_close_price": "open_price",
    "bid_price": "low_price",
    "ask_price": "high_price",
}


@query(
    "parse_ticker_24h",
    with_ctes(
        "SELECT 'P' || symbol_id AS symbol, open_time, close_time, "
        + ", ".join(f"CAST({TICKER_DERIVED.get(n, n)} AS DOUBLE) AS {n}" for n in TICKER_NUMBERS)
        + " FROM ticker24h",
        "ticker24h",
    ),
)
def parse_ticker_24h(t: Tables):
    keys = messages.TICKER_KEYS
    entry = F.struct(
        F.concat(F.lit("P"), F.col("symbol_id").cast("string")).alias("symbol"),
        *[F.col(n).cast("string").alias(key) for n, key in keys.items()],
    )
    # One message per symbol, with its months.
    sent = t.ticker24h.groupBy("symbol_id").agg(F.to_json(F.collect_list(entry)).alias("value"))
    return messages.parse_ticker_24h(sent.select("value"))


@query("parse_price_list", with_ctes(f"SELECT symbol, {as_double('price')} FROM ticks", "ticks"))
def parse_price_list(t: Tables):
    entry = F.struct("symbol", F.col("price").cast("string").alias("price"))
    sent = t.ticks.groupBy(F.floor(F.col("id") / 100)).agg(F.to_json(F.collect_list(entry)).alias("value"))
    return messages.parse_price_list(sent.select("value"))


INSTRUMENT_SQL = """symbol, status, base_asset, base_asset_precision, quote_asset, quote_precision,
  quote_asset_precision, base_commission_precision, quote_commission_precision,
  default_self_trade_prevention_mode"""


def _exchange_info(t: Tables, instruments):
    entry = F.struct(*[F.col(n).alias(key) for n, key in messages.INSTRUMENT_KEYS.items()])
    page = F.floor(F.col("symbol_id") / 500)
    listed = F.to_json(F.collect_list(entry))
    return instruments.groupBy(page).agg(
        F.concat(F.lit('{"timezone":"UTC","symbols":'), listed, F.lit("}")).alias("value")
    ).select("value")


@query("parse_exchange_info", with_ctes(f"SELECT {INSTRUMENT_SQL} FROM instruments", "instruments"))
def parse_exchange_info(t: Tables):
    return messages.parse_exchange_info(_exchange_info(t, t.instruments))


def _stored_bars(t: Tables, *bounds: str):
    path = scratch_dir(t.spark, "bars")
    storage.write_bars(t.bars("1h"), path)
    return storage.read_bars(t.spark, path, *bounds)


SCAN_FROM, SCAN_TO = "2024-01-05T00:00:00", "2024-01-25T12:00:00"


@query(
    "scan_bars",
    with_ctes(
        f"""SELECT {BAR_SQL} FROM bars_1h
WHERE open_time BETWEEN {to_epoch_ms(SCAN_FROM)} AND {to_epoch_ms(SCAN_TO)}""",
        "bars_1h",
    ),
)
def scan_bars(t: Tables):
    return storage.scan_bars(_stored_bars(t, SCAN_FROM, SCAN_TO), "1h", SCAN_FROM, SCAN_TO)


LOOK_BACK_MINUTES = 14 * 1440


@query(
    "scan_bars_lookback",
    with_ctes(
        f"""SELECT {BAR_SQL} FROM bars_1h WHERE open_time
BETWEEN {to_epoch_ms(AS_OF_EVENTS) - LOOK_BACK_MINUTES * S.MINUTE_MS} AND {to_epoch_ms(AS_OF_EVENTS)}""",
        "bars_1h",
    ),
)
def scan_bars_lookback(t: Tables):
    return storage.scan_bars_lookback(_stored_bars(t), AS_OF_EVENTS, LOOK_BACK_MINUTES, period="1h")


# Bars of the ticks that are no taker buys: a part of the keys of all bars.
_SELLS = _bars_cte("1h", "date_trunc('hour', ts)", S.HOUR_MS).replace(
    "FROM ticks", "FROM ticks WHERE NOT taker_buy"
)


def _sell_bars(t: Tables):
    return bars_by_clock(t.ticks.filter(~F.col("taker_buy")), "1h", order=("ts", "id"))


@query(
    "upsert_bars",
    with_ctes(
        f"""SELECT {BAR_SQL} FROM sells
UNION ALL SELECT {BAR_SQL.replace("CAST(volume AS DOUBLE)", "CAST(volume + 1000 AS DOUBLE)")}
FROM bars_1h WHERE NOT EXISTS (SELECT 1 FROM sells s
  WHERE s.symbol = bars_1h.symbol AND s.open_time = bars_1h.open_time)""",
        "bars_1h",
        extra={"sells": _SELLS},
    ),
)
def upsert_bars(t: Tables):
    stored = t.bars("1h").withColumn("volume", (F.col("volume") + 1000).cast(S.VOLUME))
    sells = _sell_bars(t)
    early = sells.withColumns({"volume": F.lit(0).cast(S.VOLUME), "seq": F.lit(1).cast("bigint")})
    late = sells.withColumn("seq", F.lit(2).cast("bigint"))
    return keyed.upsert_bars(stored, early.unionByName(late), ["seq"])


@query(
    "insert_absent",
    with_ctes(
        f"""SELECT {BAR_SQL} FROM sells
UNION ALL SELECT {BAR_SQL} FROM bars_1h WHERE NOT EXISTS (SELECT 1 FROM sells s
  WHERE s.symbol = bars_1h.symbol AND s.open_time = bars_1h.open_time)""",
        "bars_1h",
        extra={"sells": _SELLS},
    ),
)
def insert_absent(t: Tables):
    first = t.bars("1h").withColumn("seq", F.lit(1))
    again = t.bars("1h").withColumns({"volume": F.lit(0).cast(S.VOLUME), "seq": F.lit(2)})
    return keyed.insert_absent(_sell_bars(t), first.unionByName(again), S.BAR_KEY, ["seq"])


@query(
    "upsert_prices",
    with_ctes(
        f"""SELECT symbol, {as_double('price')} FROM prices
UNION ALL SELECT p_brand, max(p_retailprice) FROM part GROUP BY p_brand""",
        "prices",
    ),
)
def upsert_prices(t: Tables):
    brands = t.read("part").groupBy(F.col("p_brand").alias("symbol")).agg(
        F.max("p_retailprice").cast(S.PRICE).alias("price")
    )
    first = t.ticks.groupBy("symbol").agg(F.min("price").alias("price"))
    ticks = t.ticks.select("symbol", "price", "ts", "id")
    return keyed.upsert_prices(brands.unionByName(first), ticks, ["ts", "id"])


@query(
    "upsert_instruments",
    with_ctes(
        """SELECT symbol_id, symbol, CASE WHEN quote_asset = 'PROMO' THEN 'TRADING' ELSE 'BREAK' END AS status,
  base_asset, quote_asset, CASE WHEN quote_asset = 'PROMO' THEN 8 ELSE 2 END AS quote_precision
FROM instruments""",
        "instruments",
    ),
)
def upsert_instruments(t: Tables):
    stored = t.instruments.withColumns(
        {"status": F.lit("BREAK"), "quote_precision": F.lit(2).cast("short")}
    )
    sent = _exchange_info(t, t.instruments.filter(F.col("quote_asset") == "PROMO"))
    fresh = messages.parse_exchange_info(sent).withColumns(
        {"symbol_id": F.lit(None).cast("int"), "seq": F.lit(1)}
    )
    rows = keyed.upsert_instruments(stored, fresh, ["seq"])
    return rows.select("symbol_id", "symbol", "status", "base_asset", "quote_asset", "quote_precision")


@query(
    "upsert_book_levels",
    with_ctes(
        """SELECT symbol, side, ptime, CAST(price AS DOUBLE) AS price, CAST(volume AS DOUBLE) AS volume FROM sent
UNION ALL SELECT upper(symbol), side, ptime, CAST(price AS DOUBLE), CAST(volume + 1 AS DOUBLE) FROM book b
WHERE NOT EXISTS (SELECT 1 FROM sent s WHERE s.symbol = upper(b.symbol) AND s.side = b.side
  AND s.ptime = b.ptime AND s.price = b.price)""",
        "book",
        extra={
            "sent": """SELECT upper(symbol) AS symbol, side, date_trunc('second', ts) AS ptime,
  round(price, 0) + CASE side WHEN 'ask' THEN 1 ELSE 0 END AS price, arg_max(qty, ts) AS volume
FROM ticks, (VALUES ('bid'), ('ask')) sides(side) WHERE NOT taker_buy
GROUP BY ALL"""
        },
    ),
)
def upsert_book_levels(t: Tables):
    stored = t.book.withColumns(
        {"symbol": F.upper("symbol"), "volume": (F.col("volume") + 1).cast(S.NUMERIC)}
    ).select(*S.BOOK.names)
    sent = messages.parse_depth_updates(t.as_depth(t.ticks.filter(~F.col("taker_buy"))))
    return keyed.upsert_book_levels(stored, sent, ["seq", "id"])


@query("append_signals", mac_sql("indicator_id, open_time, symbol, 5 AS period, volume, vol_avg, vol3_avg"))
def append_signals(t: Tables):
    """Two jobs, the first of them run twice: its first run held other rows, which the second replaces."""
    path = scratch_dir(t.spark, "signals")
    found = mac_signals(t.bars("1h"), PAIRS).withColumn("period", F.lit(5))
    early = F.col("open_time") < 1705276800000
    for job, rows in (("early", found.where(~early)), ("early", found.where(early)), ("late", found.where(~early))):
        storage.append_signals(rows, path, job)
    return storage.read_signals(t.spark, path)


@query(
    "ingest_stats",
    with_ctes(
        """SELECT symbol, period, open_time // 86400000 AS page, count(*) AS rows_affected,
  max(close_time) AS last_close_time, max(close_time) + 1 AS next_start, count(*) < 1000 AS finished
FROM bars_1h GROUP BY symbol, period, open_time // 86400000""",
        "bars_1h",
    ),
)
def ingest_stats(t: Tables):
    return ingest.ingest_stats(t.bar_pages())


_PERIOD_VALUES = ", ".join(f"('{n}', {ms}, {months})" for n, ms, months in S.PERIODS)


@query(
    "period_dim",
    with_ctes(
        f"""SELECT symbol, period, duration_ms, duration_months,
  (last_ms - first_ms) // duration_ms + 1 AS periods_spanned
FROM (SELECT symbol, epoch_ms(min(ts)) AS first_ms, epoch_ms(max(ts)) AS last_ms FROM ticks GROUP BY symbol),
  (VALUES {_PERIOD_VALUES}) p(period, duration_ms, duration_months)""",
        "ticks",
    ),
)
def period_dim(t: Tables):
    span = t.ticks.groupBy("symbol").agg(
        F.unix_millis(F.min("ts")).alias("first_ms"), F.unix_millis(F.max("ts")).alias("last_ms")
    )
    named = span.withColumn("period", F.explode(F.array(*[F.lit(n) for n, _, _ in S.PERIODS])))
    rows = named.join(F.broadcast(S.period_dim(t.spark)), "period")
    return rows.selectExpr(
        "symbol",
        "period",
        "duration_ms",
        "duration_months",
        "(last_ms - first_ms) div duration_ms + 1 AS periods_spanned",
    )


@query(
    "register_unknown_symbols",
    with_ctes(
        """SELECT symbol, CAST(price AS DOUBLE) AS price FROM (
  SELECT upper(symbol) AS symbol, price FROM prices WHERE symbol IN ('click', 'view')
  UNION ALL SELECT DISTINCT upper(symbol), 0 FROM ticks WHERE symbol NOT IN ('click', 'view'))""",
        "prices",
    ),
)
def register_unknown_symbols(t: Tables):
    listed = t.prices.filter(F.col("symbol").isin("click", "view"))
    seen = messages.parse_depth_updates(t.as_depth(t.ticks))
    return keyed.register_unknown_symbols(listed.withColumn("symbol", F.upper("symbol")), seen)


@query(
    "track_symbol_period",
    with_ctes(
        f"""SELECT DISTINCT symbol, period FROM ticks, (VALUES {_PERIOD_VALUES}) p(period, d, m)""", "ticks"
    ),
)
def track_symbol_period(t: Tables):
    tracked = t.ticks.select("symbol", F.lit("1h").alias("period")).distinct()
    names = F.explode(F.array(*[F.lit(n) for n, _, _ in S.PERIODS]))
    wanted = t.ticks.select("symbol").distinct().select("symbol", names.alias("period"))
    return keyed.track_symbol_period(tracked, wanted, S.period_dim(t.spark))


UPSERT_FROM = "2024-01-20T00:00:00"


@query(
    "upsert_stored_bars",
    with_ctes(
        f"""SELECT {BAR_SQL.replace("CAST(close_price AS DOUBLE)", f"CAST(CASE WHEN open_time < {to_epoch_ms(UPSERT_FROM)} THEN close_price + 1 ELSE close_price END AS DOUBLE)")}
FROM bars_1h""",
        "bars_1h",
    ),
)
def upsert_stored_bars(t: Tables):
    """All days are stored with other closes; the bars from one day on arrive twice, the last time right."""
    path, bars = scratch_dir(t.spark, "bars"), t.bars("1h")
    wrong = bars.withColumn("close_price", (F.col("close_price") + 1).cast(S.PRICE))
    storage.write_bars(wrong, path)
    late = F.col("open_time") >= to_epoch_ms(UPSERT_FROM)
    incoming = bars.where(late).withColumn("seq", F.lit(2)).unionByName(wrong.where(late).withColumn("seq", F.lit(1)))
    storage.upsert_stored_bars(t.spark, path, incoming, ["seq"], scratch_dir(t.spark, "days"))
    return storage.read_bars(t.spark, path)
