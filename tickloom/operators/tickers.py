"""24-hour ticker statistics and their volume in US dollars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.exact import product
from tickloom.functions.signals import usd_asset
from tickloom.functions.times import ms_to_ts, seconds_to_ts
from tickloom.operators.keyed import latest_per_key
from tickloom.schemas import PRICE


def usd_prices(ticker: DataFrame, instruments: DataFrame, usd_pattern: str = "%USD%") -> DataFrame:
    """US-dollar price per asset: the newest price above 0 of a pair asset/USD.

    Among pairs with equally new prices the smallest symbol wins. Ticker rows are
    first reduced to one per pair, so only pairs meet in the second step.
    """
    pairs = instruments.filter(usd_asset(F.col("quote_asset"), usd_pattern)).select(
        "symbol_id", "symbol", "base_asset"
    )
    quoted = ticker.filter(F.col("last_price") > 0).select("symbol_id", "open_time", "last_price")
    newest = quoted.join(pairs.select("symbol_id"), "symbol_id", "left_semi").groupBy("symbol_id").agg(
        F.max("open_time").alias("open_time"), F.max_by("last_price", "open_time").alias("last_price")
    )
    best = F.min_by("last_price", F.struct(-F.col("open_time"), F.col("symbol")))
    return newest.join(pairs, "symbol_id").groupBy("base_asset").agg(best.alias("usd_price")).select(
        F.col("base_asset").alias("asset"), "usd_price"
    )


def usd_rules(ticker: DataFrame, instruments: DataFrame, usd_pattern: str = "%USD%") -> DataFrame:
    """Instruments with the rule that turns their volumes into dollars.

    ``usd_side`` says which volume counts and ``usd_factor`` its price. Resolving
    this per instrument keeps the two look-ups by asset, where one quote asset
    can hold most rows, away from the ticker rows.
    """
    prices = usd_prices(ticker, instruments, usd_pattern)
    base = prices.select(F.col("asset").alias("base_asset"), F.col("usd_price").alias("_base"))
    quote = prices.select(F.col("asset").alias("quote_asset"), F.col("usd_price").alias("_quote"))
    rows = (
        instruments.select("symbol_id", "symbol", "base_asset", "quote_asset")
        .join(base, "base_asset", "left")
        .join(quote, "quote_asset", "left")
    )
    in_quote = usd_asset(F.col("quote_asset"), usd_pattern)
    in_base = usd_asset(F.col("base_asset"), usd_pattern)
    has_base = F.col("_base").isNotNull()
    has_quote = F.col("_quote").isNotNull()
    side = (
        F.when(in_quote, F.lit("quote"))
        .when(in_base | has_base, F.lit("base"))
        .when(has_quote, F.lit("quote"))
    )
    factor = (
        F.when(in_quote | in_base, F.lit(1).cast("decimal(38,8)"))
        .when(has_base, F.col("_base"))
        .when(has_quote, F.col("_quote"))
    )
    return rows.select(
        "symbol_id", "symbol", side.alias("usd_side"), factor.cast(PRICE).alias("usd_factor")
    )


def ticker_with_instrument(ticker: DataFrame, instruments: DataFrame) -> DataFrame:
    """Ticker rows of known instruments with a last price above 0, with their symbol."""
    names = instruments.select("symbol_id", "symbol")
    return ticker.filter(F.col("last_price") > 0).join(names, "symbol_id")


def usd_volume(ticker: DataFrame, instruments: DataFrame, usd_pattern: str = "%USD%") -> DataFrame:
    """Ticker rows of known instruments with ``symbol`` and their ``usd_volume``.

    Rules in order: no last price, no result; quote asset in dollars, its volume;
    base asset in dollars, its volume; a dollar pair of the base asset; a dollar
    pair of the quote asset; else NULL.
    """
    return usd_volume_of(ticker, ticker, instruments, usd_pattern)


def symbol_usd_volume(ticker: DataFrame, instruments: DataFrame) -> DataFrame:
    """The ticker view with dollar volume, rows without a price left out."""
    rows = usd_volume(ticker.filter(F.col("last_price") > 0), instruments)
    return rows.select(
        "symbol", "open_time", "price_change_percent", "last_price", "volume", "quote_volume", "usd_volume"
    )


def max_usd_volume(ticker: DataFrame, instruments: DataFrame) -> DataFrame:
    """Per symbol: greatest dollar volume and mean price change, biggest first."""
    rows = symbol_usd_volume(ticker, instruments).filter(F.col("usd_volume").isNotNull())
    change = F.col("price_change_percent").cast("decimal(28,8)")
    mean = F.sum(change) / F.count(change)
    return rows.groupBy("symbol").agg(
        F.round(F.max("usd_volume"), 0).alias("max_usd_volume"),
        F.round(mean, 3).alias("price_change"),
    ).orderBy(F.desc_nulls_first("max_usd_volume"), "symbol")


def most_popular(ticker: DataFrame, instruments: DataFrame, k: int) -> DataFrame:
    """The k symbols with the greatest dollar volume (top-k without a full sort)."""
    return max_usd_volume(ticker, instruments).limit(k)


def last_snapshot(ticker: DataFrame, instruments: DataFrame) -> DataFrame:
    """Newest ticker row per symbol with its symbol, time and dollar volume.

    Dollar prices come from the whole table, as for any other row.
    """
    newest = latest_per_key(ticker, ["symbol_id"], ["open_time"])
    rows = usd_volume_of(newest, ticker, instruments)
    return rows.withColumn("open_time_tz", ms_to_ts(F.col("open_time")))


def usd_volume_of(
    rows: DataFrame, ticker: DataFrame, instruments: DataFrame, usd_pattern: str = "%USD%"
) -> DataFrame:
    """Dollar volume of some ticker rows, priced from the whole ticker table."""
    rules = usd_rules(ticker, instruments, usd_pattern)
    volume = F.when(F.col("usd_side") == "quote", F.col("quote_volume")).when(
        F.col("usd_side") == "base", F.col("volume")
    )
    priced = F.coalesce("last_price", F.lit(0)) != 0
    value = F.when(priced, product(volume, F.col("usd_factor")))
    return rows.join(rules, "symbol_id").withColumn("usd_volume", value).drop("usd_side", "usd_factor")


def latest_usd_volume(
    ticker: DataFrame, instruments: DataFrame, symbol: str | None = None
) -> DataFrame:
    """Dollar volume of the newest ticker row, of one symbol or of every symbol."""
    wanted = instruments if symbol is None else instruments.filter(F.col("symbol") == symbol)
    rows = ticker.join(wanted.select("symbol_id"), "symbol_id", "left_semi")
    newest = latest_per_key(rows, ["symbol_id"], ["open_time"])
    return usd_volume_of(newest, ticker, instruments).select("symbol", "open_time", "usd_volume")


def symbol_lookup(rows: DataFrame, instruments: DataFrame, name: str = "symbol") -> DataFrame:
    """Add ``symbol_id`` for a symbol text in any case; NULL when unknown."""
    known = instruments.select(F.col("symbol").alias("_symbol"), "symbol_id")
    return rows.join(known, F.upper(F.col(name)) == F.col("_symbol"), "left").drop("_symbol")


def symbol_volume_series(
    ticker: DataFrame, instruments: DataFrame, symbol: str | None = None
) -> DataFrame:
    """Volume over time (whole seconds), of one symbol or of every symbol."""
    rows = ticker.select("symbol_id", "open_time", "volume")
    if symbol is not None:
        named = instruments.filter(F.col("symbol") == symbol.upper()).select("symbol_id")
        rows = rows.join(named, "symbol_id", "left_semi")
    return rows.select(seconds_to_ts(F.col("open_time")).alias("added_at"), "symbol_id", "volume")


def avg_volume_by_hour(series: DataFrame) -> DataFrame:
    """Mean volume per hour of the day, rounded to five digits, biggest first."""
    volume = F.col("volume").cast("decimal(28,8)")
    mean = F.sum(volume) / F.count(volume)
    return (
        series.groupBy(F.hour("added_at").alias("hour_of_day"))
        .agg(F.round(mean, 5).alias("avg_volume"))
        .orderBy(F.desc("avg_volume"))
    )
