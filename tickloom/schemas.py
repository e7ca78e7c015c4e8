"""Explicit schemas of every table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = T.DecimalType(18, 8)
VOLUME = T.DecimalType(28, 8)
NUMERIC = T.DecimalType(38, 8)

BARS = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("period", T.StringType(), False),
        T.StructField("open_time", T.LongType(), False),
        T.StructField("open_price", PRICE),
        T.StructField("high_price", PRICE),
        T.StructField("low_price", PRICE),
        T.StructField("close_price", PRICE),
        T.StructField("volume", VOLUME),
        T.StructField("close_time", T.LongType()),
        T.StructField("quote_asset_volume", VOLUME),
        T.StructField("num_trades", T.LongType()),
        T.StructField("taker_buy_base_asset_volume", VOLUME),
        T.StructField("taker_buy_quote_asset_volume", VOLUME),
    ]
)
BAR_KEY = ("symbol", "period", "open_time")

TRACKED = T.StructType(
    [T.StructField("symbol", T.StringType(), False), T.StructField("period", T.StringType(), False)]
)

WATCHED = T.StructType(
    [T.StructField("symbol", T.StringType(), False), T.StructField("symbol_id", T.IntegerType())]
)

PRICES = T.StructType([T.StructField("symbol", T.StringType(), False), T.StructField("price", PRICE)])

INSTRUMENTS = T.StructType(
    [
        T.StructField("symbol_id", T.IntegerType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("status", T.StringType()),
        T.StructField("base_asset", T.StringType()),
        T.StructField("base_asset_precision", T.ShortType()),
        T.StructField("quote_asset", T.StringType()),
        T.StructField("quote_precision", T.ShortType()),
        T.StructField("quote_asset_precision", T.ShortType()),
        T.StructField("base_commission_precision", T.ShortType()),
        T.StructField("quote_commission_precision", T.ShortType()),
        T.StructField("default_self_trade_prevention_mode", T.StringType()),
    ]
)

TICKER_24H = T.StructType(
    [T.StructField("symbol_id", T.IntegerType(), False)]
    + [
        T.StructField(name, NUMERIC)
        for name in (
            "price_change",
            "price_change_percent",
            "weighted_avg_price",
            "prev_close_price",
            "last_price",
            "last_qty",
            "bid_price",
            "ask_price",
            "open_price",
            "high_price",
            "low_price",
            "volume",
            "quote_volume",
        )
    ]
    + [T.StructField("open_time", T.LongType(), False), T.StructField("close_time", T.LongType())]
)

BOOK = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("side", T.StringType(), False),
        T.StructField("ptime", T.TimestampType(), False),
        T.StructField("price", NUMERIC, False),
        T.StructField("volume", NUMERIC),
    ]
)
BOOK_KEY = ("symbol", "side", "ptime", "price")

ALERTS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("kind", T.IntegerType(), False),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("active_since", T.TimestampType()),
    ]
)

SIGNALS = T.StructType(
    [
        T.StructField("open_time", T.LongType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("period", T.IntegerType(), False),
        T.StructField("indicator_id", T.IntegerType(), False),
        T.StructField("volume", T.DoubleType()),
        T.StructField("vol_avg", T.DoubleType()),
        T.StructField("vol3_avg", T.DoubleType()),
    ]
)

# The signals of a bar in one row: by long term the volume mean and the ids.
SIGNAL_SETS = T.MapType(
    T.IntegerType(),
    T.StructType([SIGNALS["vol_avg"], T.StructField("indicator_ids", T.ArrayType(T.IntegerType()))]),
)
BAR_SIGNALS = T.StructType(
    [SIGNALS[c] for c in ("open_time", "symbol", "period", "volume", "vol3_avg")] + [T.StructField("signals", SIGNAL_SETS)]
)

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS

# Bar periods, their length in ms and, for calendar periods, in months.
PERIODS = (
    ("1s", 1_000, 0),
    ("1m", MINUTE_MS, 0),
    ("3m", 3 * MINUTE_MS, 0),
    ("5m", 5 * MINUTE_MS, 0),
    ("15m", 15 * MINUTE_MS, 0),
    ("30m", 30 * MINUTE_MS, 0),
    ("1h", HOUR_MS, 0),
    ("2h", 2 * HOUR_MS, 0),
    ("4h", 4 * HOUR_MS, 0),
    ("6h", 6 * HOUR_MS, 0),
    ("8h", 8 * HOUR_MS, 0),
    ("12h", 12 * HOUR_MS, 0),
    ("1d", DAY_MS, 0),
    ("3d", 3 * DAY_MS, 0),
    ("1w", 7 * DAY_MS, 0),
    ("1M", 30 * DAY_MS, 1),
)

# Table suffixes of the running price bars and their length.
PRICE_PERIODS = (
    ("1s", 1_000, 0),
    ("1m", MINUTE_MS, 0),
    ("5m", 5 * MINUTE_MS, 0),
    ("30m", 30 * MINUTE_MS, 0),
    ("hour", HOUR_MS, 0),
    ("day", DAY_MS, 0),
    ("week", 7 * DAY_MS, 0),
    ("month", 30 * DAY_MS, 1),
)

# Bar sizes, in minute bars, the signal job folds minutes into.
SIGNAL_PERIOD_MINUTES = (1, 5, 10, 15, 30, 60, 240, 720, 1440, 4320, 10080)

PERIOD_MS = {name: ms for name, ms, _ in PERIODS}
PERIOD_MONTHS = {name: months for name, _, months in PERIODS}


def period_dim(spark: SparkSession) -> DataFrame:
    """Bar periods as a table (16 rows, so always safe to broadcast)."""
    return spark.createDataFrame(list(PERIODS), "period string, duration_ms bigint, duration_months int")


def price_period_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(PRICE_PERIODS), "suffix string, duration_ms bigint, duration_months int"
    )


def period_to_ms(period: Column) -> Column:
    """Length of a named period in ms; an unknown name is an error."""
    chain = F.when(period == PERIODS[0][0], F.lit(PERIODS[0][1]))
    for name, ms, _ in PERIODS[1:]:
        chain = chain.when(period == name, F.lit(ms))
    message = F.concat(F.lit("unknown period: "), F.coalesce(period, F.lit("NULL")))
    return chain.otherwise(F.raise_error(message).cast("bigint")).cast("bigint")


def ms_to_period(duration_ms: Column) -> Column:
    """Name of the period with this length; an unknown length is an error."""
    chain = F.when(duration_ms == PERIODS[0][1], F.lit(PERIODS[0][0]))
    for name, ms, _ in PERIODS[1:]:
        chain = chain.when(duration_ms == ms, F.lit(name))
    message = F.concat(F.lit("not valid duration: "), F.coalesce(duration_ms.cast("string"), F.lit("NULL")))
    return chain.otherwise(F.raise_error(message).cast("string"))


def check_period(period: str) -> str:
    if period not in PERIOD_MS:
        raise ValueError(f"unknown period: {period}")
    return period
