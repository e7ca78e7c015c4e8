"""Price batches in, fired alerts out.

Alerts wait in a table laid out by kind and price band. An alert that waits has not been met at the last price of its
symbol, so a batch reads the bands between the last price and the new one, and in them the thresholds in between.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.alerts import FALLS_TO, RISES_TO, alerts_archived, alerts_hit, alerts_remaining
from tickloom.operators.keyed import latest_per_key
from tickloom.schemas import ALERTS, PRICE, PRICES
from tickloom.sources.logged import LoggedTable
from tickloom.sources.storage import read_log, write_batch
from tickloom.streaming.feeds import run_batches

ARCHIVE = T.StructType(
    [
        *ALERTS.fields,
        T.StructField("last_price", PRICE),
        T.StructField("triggered_at", T.TimestampType()),
    ]
)
WAITING = T.StructType([*ALERTS.fields, T.StructField("waits", T.BooleanType(), False)])
MET = T.StructType([*ALERTS.fields, T.StructField("last_price", PRICE), T.StructField("held", T.BooleanType())])
SEEN = T.StructType([T.StructField("last_id", T.LongType())])
#: Bands of prices from 1e-9 on, nine for each power of ten up to 1e20; the first and the last take all beyond.
FIRST_BAND, LAST_BAND = -81, 180


def price_band(price: Column) -> Column:
    """Number of the band a price lies in, by its power of ten and first digit; it never falls as the price rises."""
    value = price.cast("double")
    exponent = F.floor(F.log10(value))
    digit = F.least(F.greatest(F.floor(value / F.pow(F.lit(10.0), exponent)), F.lit(1)), F.lit(9))
    band = F.when(value >= 1e20, LAST_BAND).when(value >= 1e-9, exponent * 9 + digit - 1).otherwise(FIRST_BAND)
    return F.when(price.isNotNull(), band).cast("int")


def waiting_table(path: str) -> LoggedTable:
    """Alerts that wait for their price, by kind and price band; those that fired or were removed no longer wait."""
    parts = {"side": F.col("kind"), "band": price_band(F.col("price"))}
    # In order of thresholds, so that statistics cut a read of a band down to symbols and prices as well.
    return LoggedTable(f"{path}/waiting", WAITING, ("id",), parts, live=F.col("waits"), order=("symbol", "price"))


def active_alerts(spark: SparkSession, alerts: DataFrame, path: str) -> DataFrame:
    """Alerts of the table that have not fired, active or not."""
    return alerts_remaining(alerts, fired_alerts(spark, path))


def waiting_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alerts that have been loaded and neither fired nor were found to be removed."""
    return waiting_table(path).read(spark).select(*ALERTS.names)


def compact_alerts(spark: SparkSession, path: str, upto: int) -> None:
    """Rewrite the bands that batches up to ``upto`` have touched; what no longer waits is left out for good."""
    waiting_table(path).compact(spark, upto)


def price_moves(held: DataFrame | None, newest: DataFrame) -> DataFrame:
    """``symbol``, ``last_price``, and the price ``before`` it, NULL if there was none; moves by nothing are left out."""
    moved = newest.select("symbol", F.col("price").alias("last_price")).where("last_price IS NOT NULL")
    if held is None:
        return moved.withColumn("before", F.lit(None).cast(PRICE))
    before = held.select("symbol", F.col("price").alias("before"))
    return moved.join(before, "symbol", "left").where(~F.col("before").eqNullSafe(F.col("last_price")))


def bands_crossed(moves: DataFrame) -> Column:
    """The condition on ``side`` and ``band`` of the bands between old and new prices, as one literal per side.

    At most two for each of the bands reach the driver, whatever the number of symbols.
    """
    before, last = price_band(F.col("before")), price_band(F.col("last_price"))
    rises = F.when(
        F.col("before").isNull() | (F.col("before") < F.col("last_price")),
        F.sequence(F.coalesce(before, F.lit(FIRST_BAND)), last),
    )
    falls = F.when(
        F.col("before").isNull() | (F.col("before") > F.col("last_price")),
        F.sequence(last, F.coalesce(before, F.lit(LAST_BAND))),
    )
    crossed = F.lit(False)
    for side, bands in ((RISES_TO, rises), (FALLS_TO, falls)):
        met = [r[0] for r in moves.select(F.explode(bands)).distinct().collect()]
        if met:
            crossed = crossed | ((F.col("side") == side) & F.col("band").isin(*sorted(met)))
    return crossed


def thresholds_crossed(waiting: DataFrame, moves: DataFrame) -> DataFrame:
    """Waiting alerts whose condition holds at ``last_price`` and did not hold ``before``."""
    price, before, last = F.col("price"), F.col("before"), F.col("last_price")
    rises = (F.col("kind") == RISES_TO) & (price <= last) & (before.isNull() | (price > before))
    falls = (F.col("kind") == FALLS_TO) & (price >= last) & (before.isNull() | (price < before))
    return waiting.join(moves, "symbol").where(rises | falls).drop("before")


def stream_alerts(
    price_rows: DataFrame,
    load_alerts: Callable[[], DataFrame],
    path: str,
    *,
    ingest_order: Sequence[str],
    triggered_at: dt.datetime | str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Fire the alerts that the newest prices of each micro-batch reach.

    ``price_rows`` has symbol, price and the ``ingest_order`` columns. ``load_alerts`` gives the alert table as it is;
    ids rise with each alert added to it, and rows do not change. A batch takes from it the alerts with ids above those
    seen, tests them at the price of their symbol, and keeps those that wait in ``path/waiting``; an alert that is not
    active then never fires. Of those kept it reads the bands between old and new prices only. An alert that is reached
    but no longer in the table was removed: it leaves without firing.

    Fired alerts go to ``path/archive`` and wait no more, so each fires once, also if a batch runs twice; the archive is
    never read. A NULL price is no price; a symbol without one fires nothing. ``compact_alerts`` between runs keeps the
    number of batches that a read meets small.
    """

    # Adaptive execution is off in a stream's own session: joins run in the caller's.
    spark = price_rows.sparkSession
    waiting = waiting_table(path)

    def landed(rows: DataFrame, name: str, schema: T.StructType, number: int) -> DataFrame:
        write_batch(rows.select(*schema.names), f"{path}/{name}", number)
        return spark.read.schema(schema).parquet(f"{path}/{name}/batch={number}")

    def left_by(name: str, schema: T.StructType, number: int) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{path}/{name}/batch={number}")

    def handle(batch: DataFrame, number: int) -> None:
        priced = batch.where(F.col("price").isNotNull())
        newest = latest_per_key(priced, ["symbol"], ingest_order, keep_order=False)
        newest = landed(newest, "fresh", PRICES, number)
        held, seen, prices = None, None, newest
        if number > 0:
            # Each batch leaves the whole price table, one row per symbol, and the last id to the next.
            held = left_by("prices", PRICES, number - 1)
            seen = left_by("seen", SEEN, number - 1).first()[0]
            prices = held.join(newest.select("symbol"), "symbol", "left_anti").unionByName(newest)
        prices = landed(prices, "prices", PRICES, number)

        alerts = load_alerts()
        added = alerts if seen is None else alerts.where(F.col("id") > seen)
        added = landed(added, "added", ALERTS, number)
        last = added.agg(F.max("id").alias("last_id"))
        landed(last.select(F.coalesce("last_id", F.lit(seen).cast("long")).alias("last_id")), "seen", SEEN, number)

        met = alerts_hit(added, prices).select(*ALERTS.names, "last_price", F.lit(True).alias("held"))
        if number > 0:
            moves = price_moves(held, newest)
            kept = waiting.read(spark, bands_crossed(moves), before=number).select(*ALERTS.names)
            crossed = thresholds_crossed(kept, moves)
            here = alerts.select("id", F.lit(True).alias("held"))
            met = met.unionByName(crossed.join(here, "id", "left").select(*MET.names))
        met = landed(met, "met", MET, number)

        moment = triggered_at or dt.datetime.now(dt.timezone.utc)
        archive = alerts_archived(met.where("held"), moment)
        write_batch(archive.select(*ARCHIVE.names), f"{path}/archive", number)
        active = added.where(F.col("active_since").isNotNull())
        staying = active.join(met.select("id"), "id", "left_anti").withColumn("waits", F.lit(True))
        leaving = met.join(added.select("id"), "id", "left_anti").withColumn("waits", F.lit(False))
        waiting.append(staying.unionByName(leaving.select(*WAITING.names)), number)

    return run_batches(price_rows, handle, f"{path}/checkpoint", available_now=available_now)


def fired_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All alerts fired so far, in the layout of the archive."""
    return read_log(spark, f"{path}/archive", ARCHIVE).select(*ARCHIVE.names)
