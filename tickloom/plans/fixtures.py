"""Market relations derived from the given tables, for the checked queries.

Each relation is stated twice, as a DataFrame in ``Tables`` and as a SQL common
table expression in ``CTES``, and the two must hold the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas as S
from tickloom.functions.times import to_epoch_ms, ts_to_ms
from tickloom.operators.bars import bars_by_clock
from tickloom.operators.blocks import with_position
from tickloom.operators.keyed import latest_per_key

AS_OF_EVENTS = "2024-01-31T00:00:00"
AS_OF_ORDERS = "2001-12-01T00:00:00"
LINE_START = "2001-01-01T00:00:00"
LINE_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


class Tables:
    """The given tables at one scale and the relations derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @staticmethod
    def as_ticks(events: DataFrame) -> DataFrame:
        return events.select(
            F.col("event_type").alias("symbol"),
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("event_id").alias("id"),
            F.col("user_id"),
            F.col("value").cast(S.PRICE).alias("price"),
            F.get_json_object("props", "$.k").cast(S.PRICE).alias("qty"),
            (F.col("event_id") % 2 == 0).alias("taker_buy"),
        )

    @cached_property
    def ticks(self) -> DataFrame:
        return self.as_ticks(self.read("events"))

    def bars(self, period: str) -> DataFrame:
        return bars_by_clock(self.ticks, period, order=("ts", "id"))

    @cached_property
    def minute_bars(self) -> DataFrame:
        """Minute bars; minutes without ticks are missing, which count bars ignore."""
        return self.bars("1m")

    def line_bars(self, period: str) -> DataFrame:
        """Line items, in shipping order, as a gap-free series per flag and status."""
        lines = self.read("lineitem").select(
            F.concat("l_returnflag", "l_linestatus").alias("symbol"),
            F.lit(period).alias("period"),
            *LINE_ORDER,
            F.col("l_extendedprice").cast(S.PRICE).alias("close_price"),
            F.col("l_quantity").cast(S.VOLUME).alias("volume"),
        )
        numbered = with_position(
            lines,
            keys=("symbol", "period"),
            order=LINE_ORDER,
            # Rises along the order; a day of many orders makes several chunks.
            chunk=F.struct("l_shipdate", F.floor(F.col("l_orderkey") / 2**24)),
        )
        price = F.col("close_price")
        opened = F.lit(to_epoch_ms(LINE_START)) + F.col("position") * S.PERIOD_MS[period]
        return numbered.select(
            "symbol",
            "period",
            opened.alias("open_time"),
            "close_price",
            price.alias("high_price"),
            price.alias("low_price"),
            "volume",
            F.lit(1).cast("bigint").alias("num_trades"),
        )

    @cached_property
    def order_bars(self) -> DataFrame:
        price = F.col("o_totalprice").cast(S.PRICE)
        key = "o_orderkey"
        opened = ts_to_ms(F.col("o_orderdate").cast("timestamp"))
        bars = self.read("orders").groupBy(
            F.col("o_orderpriority").alias("symbol"), opened.alias("open_time")
        ).agg(
            F.min_by(price, key).alias("open_price"),
            F.max(price).alias("high_price"),
            F.min(price).alias("low_price"),
            F.max_by(price, key).alias("close_price"),
            F.count(F.lit(1)).cast(S.VOLUME).alias("volume"),
        )
        return bars.withColumn("period", F.lit("1d"))

    @cached_property
    def book(self) -> DataFrame:
        levels = self.ticks.select(
            "symbol",
            F.lit("bid").alias("side"),
            F.date_trunc("second", F.col("ts")).alias("ptime"),
            F.round("price", 0).cast(S.NUMERIC).alias("price"),
            F.col("qty").cast(S.NUMERIC).alias("volume"),
            "ts",
            "id",
        )
        return latest_per_key(levels, S.BOOK_KEY, ("ts", "id"), keep_order=False)

    @cached_property
    def instruments(self) -> DataFrame:
        part = self.read("part")
        k = F.col("p_partkey") % 20
        traded = F.col("p_type").isin("STANDARD", "PROMO", "LARGE")
        brand = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
        base = (
            F.when((k == 1) & traded, F.col("p_type")).when(k == 2, F.lit("USDC")).otherwise(F.col("p_brand"))
        )
        quote = (
            F.when((k == 0) & (brand % 2 == 0), F.lit("USDT"))
            .when((k == 1) & traded, F.lit("USDT"))
            .otherwise(F.col("p_type"))
        )
        digits = F.lit(8).cast("short")
        return part.select(
            F.col("p_partkey").cast("int").alias("symbol_id"),
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"),
            F.lit("TRADING").alias("status"),
            base.alias("base_asset"),
            F.col("p_size").cast("short").alias("base_asset_precision"),
            quote.alias("quote_asset"),
            *[
                digits.alias(n)
                for n in (
                    "quote_precision",
                    "quote_asset_precision",
                    "base_commission_precision",
                    "quote_commission_precision",
                )
            ],
            F.lit("NONE").alias("default_self_trade_prevention_mode"),
        )

    @cached_property
    def ticker24h(self) -> DataFrame:
        last = F.struct(*LINE_ORDER)
        cents = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100).cast("bigint")
        price = (cents.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(S.NUMERIC)
        month = F.date_trunc("month", F.col("l_shipdate").cast("timestamp"))
        rows = self.read("lineitem").groupBy(
            F.col("l_partkey").cast("int").alias("symbol_id"), ts_to_ms(month).alias("open_time")
        ).agg(
            F.max_by(price, last).alias("last_price"),
            F.min_by(price, last).alias("open_price"),
            F.max(price).alias("high_price"),
            F.min(price).alias("low_price"),
            F.max_by(F.round(F.col("l_discount") * 100).cast(S.NUMERIC), last).alias("price_change_percent"),
            F.max_by(F.col("l_quantity").cast(S.NUMERIC), last).alias("last_qty"),
            F.sum(F.col("l_quantity").cast(S.PRICE)).cast(S.NUMERIC).alias("volume"),
            F.sum(F.col("l_extendedprice").cast(S.PRICE)).cast(S.NUMERIC).alias("quote_volume"),
        )
        return rows.withColumns(
            {
                "price_change": (F.col("last_price") - F.col("open_price")).cast(S.NUMERIC),
                "weighted_avg_price": F.col("high_price"),
                "prev_close_price": F.col("open_price"),
                "bid_price": F.col("low_price"),
                "ask_price": F.col("high_price"),
                "close_time": F.col("open_time") + S.DAY_MS - 1,
            }
        ).select(*S.TICKER_24H.names)

    @cached_property
    def prices(self) -> DataFrame:
        return latest_per_key(
            self.ticks.select("symbol", "price", "ts", "id"), ["symbol"], ("ts", "id"), keep_order=False
        )

    @cached_property
    def alerts(self) -> DataFrame:
        ts = F.col("ts").cast("timestamp")
        return self.read("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").cast("int").alias("user_id"),
            F.col("event_type").alias("symbol"),
            F.col("value").alias("price"),
            (F.col("event_id") % 2).cast("int").alias("kind"),
            ts.alias("created_at"),
            F.when(F.col("event_id") % 7 != 0, ts).alias("active_since"),
        )

    # JSON messages, built from the relations above.

    @staticmethod
    def _quoted(name: str) -> Column:
        return F.concat(F.lit('"'), F.col(name).cast("string"), F.lit('"'))

    def bar_pages(self, period: str = "1h") -> DataFrame:
        """One page per symbol and day, as arrays of numbers and quoted decimals."""
        numbers = ("open_time", "close_time", "num_trades")
        parts = [
            F.col(n).cast("string") if n in numbers else self._quoted(n)
            for n in S.BARS.names
            if n not in ("symbol", "period")
        ]
        row = F.concat(F.lit("["), F.concat_ws(",", *parts, F.lit('"0"')), F.lit("]"))
        rows = F.array_sort(F.collect_list(F.struct("open_time", row.alias("row"))))
        body = F.array_join(F.transform(rows, lambda r: r["row"]), ",")
        day = F.floor(F.col("open_time") / S.DAY_MS)
        return self.bars(period).groupBy("symbol", "period", day.alias("page")).agg(
            F.concat(F.lit("["), body, F.lit("]")).alias("body"), F.lit(200).alias("status")
        )

    @staticmethod
    def as_bar_events(bars: DataFrame) -> DataFrame:
        """Bars as stream envelopes, with their key order as ``seq``."""
        field = {
            "t": F.col("open_time"),
            "T": F.col("close_time"),
            "s": F.col("symbol"),
            "i": F.col("period"),
            "o": F.col("open_price").cast("string"),
            "c": F.col("close_price").cast("string"),
            "h": F.col("high_price").cast("string"),
            "l": F.col("low_price").cast("string"),
            "v": F.col("volume").cast("string"),
            "n": F.col("num_trades"),
            "x": F.lit(False),
            "q": F.col("quote_asset_volume").cast("string"),
            "V": F.col("taker_buy_base_asset_volume").cast("string"),
            "Q": F.col("taker_buy_quote_asset_volume").cast("string"),
        }
        bar = F.to_json(F.struct(*[column.alias(key) for key, column in field.items()]))
        # The envelope is put together as text: a struct cannot hold keys that differ in case only.
        value = F.concat(F.lit('{"stream":"bars","data":{"e":"bar","k":'), bar, F.lit("}}"))
        return bars.select(value.alias("value"), F.col("open_time").alias("seq"))

    @staticmethod
    def as_depth(ticks: DataFrame) -> DataFrame:
        """Ticks as depth messages: one bid at the price, one ask a unit above it."""
        level = F.concat(F.lit('[["'), F.round("price", 0).cast("string"), F.lit('","'), F.col("qty").cast("string"), F.lit('"]]'))
        ask = F.concat(
            F.lit('[["'), (F.round("price", 0) + 1).cast("string"), F.lit('","'), F.col("qty").cast("string"), F.lit('"]]')
        )
        value = F.concat(
            F.lit('{"e":"depthUpdate","E":'),
            ts_to_ms(F.date_trunc("millisecond", F.col("ts"))).cast("string"),
            F.lit(',"s":"'),
            F.col("symbol"),
            F.lit('","U":1,"u":2,"b":'),
            level,
            F.lit(',"a":'),
            ask,
            F.lit("}"),
        )
        return ticks.select(value.alias("value"), F.col("ts").alias("seq"), "id")


def _bars_cte(period: str, bucket: str, duration_ms: int) -> str:
    return f"""SELECT symbol, '{period}' AS period, epoch_ms({bucket}) AS open_time,
      arg_min(price, ts) AS open_price, max(price) AS high_price, min(price) AS low_price,
      arg_max(price, ts) AS close_price, CAST(sum(qty) AS DECIMAL(28,8)) AS volume,
      epoch_ms({bucket}) + {duration_ms - 1} AS close_time,
      CAST(sum(CAST(price AS DECIMAL(20,8)) * qty) AS DECIMAL(28,8)) AS quote_asset_volume, count(*) AS num_trades,
      CAST(sum(CASE WHEN taker_buy THEN qty ELSE 0 END) AS DECIMAL(28,8)) AS taker_buy_base_asset_volume,
      CAST(sum(CASE WHEN taker_buy THEN CAST(price AS DECIMAL(20,8)) * qty ELSE 0 END) AS DECIMAL(28,8))
        AS taker_buy_quote_asset_volume
    FROM ticks GROUP BY symbol, {bucket}"""


def _line_cte(step_ms: int, period: str) -> str:
    return f"""SELECT l_returnflag || l_linestatus AS symbol, '{period}' AS period,
      {to_epoch_ms(LINE_START)} + {step_ms} * (row_number() OVER (
        PARTITION BY l_returnflag || l_linestatus ORDER BY {', '.join(LINE_ORDER)}) - 1) AS open_time,
      CAST(l_extendedprice AS DECIMAL(18,8)) AS close_price,
      CAST(l_quantity AS DECIMAL(28,8)) AS volume, 1 AS num_trades
    FROM lineitem"""


_LAST_LINE = f"row({', '.join(LINE_ORDER)})"
_LINE_PRICE = "CAST(CAST(floor(l_extendedprice / l_quantity * 100) AS BIGINT) AS DECIMAL(18,0)) * 0.01"

# name -> (names of the relations it reads, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ticks": (
        (),
        """SELECT event_type AS symbol, ts, event_id AS id, user_id,
      CAST(value AS DECIMAL(18,8)) AS price,
      CAST(json_extract_string(props, '$.k') AS DECIMAL(18,8)) AS qty,
      event_id % 2 = 0 AS taker_buy FROM events""",
    ),
    "bars_1h": (("ticks",), _bars_cte("1h", "date_trunc('hour', ts)", S.HOUR_MS)),
    "bars_4h": (
        ("ticks",),
        _bars_cte("4h", "time_bucket(INTERVAL '4 hours', ts, TIMESTAMP '2001-01-01')", 4 * S.HOUR_MS),
    ),
    "bars_1d": (("ticks",), _bars_cte("1d", "date_trunc('day', ts)", S.DAY_MS)),
    "minute_bars": (("ticks",), _bars_cte("1m", "date_trunc('minute', ts)", S.MINUTE_MS)),
    "line_bars_1m": ((), _line_cte(S.MINUTE_MS, "1m")),
    "line_bars_1s": ((), _line_cte(1000, "1s")),
    "order_bars": (
        (),
        """SELECT o_orderpriority AS symbol, '1d' AS period, epoch_ms(o_orderdate) AS open_time,
      CAST(arg_min(o_totalprice, o_orderkey) AS DECIMAL(18,8)) AS open_price,
      CAST(max(o_totalprice) AS DECIMAL(18,8)) AS high_price,
      CAST(min(o_totalprice) AS DECIMAL(18,8)) AS low_price,
      CAST(arg_max(o_totalprice, o_orderkey) AS DECIMAL(18,8)) AS close_price,
      CAST(count(*) AS DECIMAL(28,8)) AS volume
    FROM orders GROUP BY o_orderpriority, o_orderdate""",
    ),
    "book": (
        ("ticks",),
        """SELECT symbol, 'bid' AS side, date_trunc('second', ts) AS ptime,
      CAST(round(price, 0) AS DECIMAL(18,0)) AS price, arg_max(qty, ts) AS volume
    FROM ticks GROUP BY symbol, date_trunc('second', ts), round(price, 0)""",
    ),
    "instruments": (
        (),
        """SELECT CAST(p_partkey AS INTEGER) AS symbol_id, 'P' || p_partkey AS symbol, 'TRADING' AS status,
      CASE WHEN p_partkey % 20 = 1 AND p_type IN ('STANDARD','PROMO','LARGE') THEN p_type
           WHEN p_partkey % 20 = 2 THEN 'USDC' ELSE p_brand END AS base_asset,
      p_size AS base_asset_precision,
      CASE WHEN p_partkey % 20 = 0 AND CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) % 2 = 0 THEN 'USDT'
           WHEN p_partkey % 20 = 1 AND p_type IN ('STANDARD','PROMO','LARGE') THEN 'USDT'
           ELSE p_type END AS quote_asset,
      8 AS quote_precision, 8 AS quote_asset_precision, 8 AS base_commission_precision,
      8 AS quote_commission_precision, 'NONE' AS default_self_trade_prevention_mode
    FROM part""",
    ),
    "ticker24h": (
        (),
        f"""SELECT CAST(l_partkey AS INTEGER) AS symbol_id, epoch_ms(date_trunc('month', l_shipdate)) AS open_time,
      arg_max({_LINE_PRICE}, {_LAST_LINE}) AS last_price,
      arg_min({_LINE_PRICE}, {_LAST_LINE}) AS open_price,
      max({_LINE_PRICE}) AS high_price, min({_LINE_PRICE}) AS low_price,
      arg_max(round(l_discount * 100), {_LAST_LINE}) AS price_change_percent,
      arg_max(l_quantity, {_LAST_LINE}) AS last_qty,
      sum(CAST(l_quantity AS DECIMAL(18,2))) AS volume,
      sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS quote_volume,
      epoch_ms(date_trunc('month', l_shipdate)) + {S.DAY_MS - 1} AS close_time
    FROM lineitem GROUP BY l_partkey, date_trunc('month', l_shipdate)""",
    ),
    "prices": (("ticks",), "SELECT symbol, arg_max(price, ts) AS price FROM ticks GROUP BY symbol"),
    "alerts": (
        (),
        """SELECT event_id AS id, user_id, event_type AS symbol, value AS price, event_id % 2 AS kind,
      ts AS created_at, CASE WHEN event_id % 7 <> 0 THEN ts END AS active_since FROM events""",
    ),
    "usd_price": (
        ("ticker24h", "instruments"),
        """SELECT i.base_asset AS asset, arg_min(t.last_price, row(-t.open_time, i.symbol)) AS price
    FROM ticker24h t JOIN instruments i USING (symbol_id)
    WHERE i.quote_asset LIKE '%USD%' AND t.last_price > 0 GROUP BY i.base_asset""",
    ),
    "usd": (
        ("ticker24h", "instruments", "usd_price"),
        """SELECT t.*, i.symbol, CASE WHEN coalesce(t.last_price, 0) = 0 THEN NULL
      WHEN i.quote_asset LIKE '%USD%' THEN CAST(t.quote_volume AS DECIMAL(18,4))
      WHEN i.base_asset LIKE '%USD%' THEN CAST(t.volume AS DECIMAL(18,4))
      WHEN b.price IS NOT NULL THEN CAST(t.volume * b.price AS DECIMAL(18,4))
      WHEN q.price IS NOT NULL THEN CAST(t.quote_volume * q.price AS DECIMAL(18,4)) END AS usd_volume
    FROM ticker24h t JOIN instruments i USING (symbol_id)
    LEFT JOIN usd_price b ON b.asset = i.base_asset LEFT JOIN usd_price q ON q.asset = i.quote_asset""",
    ),
}


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """A SQL text: the named relations and what they read, then ``extra``, then ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in CTES[name][0]:
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    parts = [f"{name} AS ({CTES[name][1]})" for name in ordered]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return f"WITH {', '.join(parts)}\n{body}" if parts else body
