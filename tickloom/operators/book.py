"""Order-book support levels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.times import as_utc
from tickloom.operators.blocks import running_total
from tickloom.schemas import PRICE


def price_chunk(price: Column) -> Column:
    """Bucket of a price by its first four significant digits, rising with the price.

    It splits the levels of one symbol by a rule that needs no statistics: prices
    quoted to eight digits put at most 10 000 levels into one bucket.
    """
    value = price.cast("double")
    exponent = F.floor(F.log10(value))
    lead = F.floor(value / F.pow(F.lit(10.0), exponent - 3))
    return F.when(price > 0, exponent * 100_000 + lead).otherwise(F.lit(-(10**9)))


def latest_levels(
    book: DataFrame, finish: dt.datetime | str | None = None, side: str = "bid"
) -> DataFrame:
    """Latest volume per (symbol, price) of one side of the book, up to ``finish``."""
    if "side" in book.columns:
        book = book.filter(F.col("side") == side)
    if finish is not None:
        book = book.filter(F.col("ptime") <= F.lit(as_utc(finish)))
    return book.groupBy("symbol", "price").agg(
        F.max_by("volume", "ptime").alias("volume"), F.max("ptime").alias("ptime")
    )


def running_volume(levels: DataFrame, split_volume: float) -> DataFrame:
    """Running volume in price order per symbol, and the part it falls into.

    The running sum is added up per price bucket first, so no task holds the
    whole book of a symbol.
    """
    rows = running_total(
        levels,
        "volume",
        keys=["symbol"],
        order=["price"],
        chunk=price_chunk(F.col("price")),
        name="running_volume",
    )
    part = F.round(F.col("running_volume") / F.lit(split_volume), 0).cast("int")
    return rows.withColumn("part", part)


def support_levels(
    book: DataFrame, split_volume: int, finish: dt.datetime | str | None = None
) -> DataFrame:
    """Price levels of each symbol in parts of about ``split_volume``, at ``finish``.

    Removed levels (volume 0) take part in the running sum, where they add
    nothing, but not in the statistics.
    """
    rows = running_volume(latest_levels(book, finish), split_volume).filter(F.col("volume") > 0)
    weighted = F.sum(F.col("price").cast(PRICE) * F.col("volume").cast("decimal(24,8)"))
    return rows.groupBy("symbol", "part").agg(
        (weighted.cast("double") / F.sum("volume").cast("double")).alias("price_support"),
        (F.sum("price").cast("double") / F.count("price")).alias("price_avg"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("count_prices"),
        F.min("ptime").alias("min_time"),
        F.max("ptime").alias("max_time"),
    )


def top_support(
    book: DataFrame, split_volume: int, finish: dt.datetime | str | None = None, k: int = 20
) -> DataFrame:
    """The k highest parts of each symbol."""
    highest = Window.partitionBy("symbol").orderBy(F.desc("part"))
    ranked = support_levels(book, split_volume, finish).withColumn("rank", F.row_number().over(highest))
    return ranked.filter(F.col("rank") <= k)


def rounded_support(levels: DataFrame, volume_digits: int) -> DataFrame:
    """Prices to two digits and volume to ``volume_digits``, under short names."""

    def to(name: str, digits: int, alias: str) -> Column:
        return F.round(F.col(name).cast("decimal(38,12)"), digits).alias(alias)

    return levels.select(
        "symbol",
        "part",
        to("price_support", 2, "support"),
        to("price_avg", 2, "avg"),
        to("price_min", 2, "min"),
        to("price_max", 2, "max"),
        to("total_volume", volume_digits, "volume"),
        F.col("count_prices").alias("count"),
        "min_time",
        "max_time",
    )
