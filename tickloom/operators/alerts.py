"""Price alerts: arming, firing, archiving."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import as_utc

# What an alert waits for.
FALLS_TO, RISES_TO = 0, 1


def alerts_hit(alerts: DataFrame, prices: DataFrame) -> DataFrame:
    """Active alerts whose condition holds at the current price, with ``last_price``.

    One price per symbol: Spark broadcasts the prices while they are small; with
    more symbols than that it shuffles, and AQE splits a symbol with many alerts.
    """
    current = prices.select("symbol", F.col("price").alias("last_price"))
    last = F.col("last_price")
    met = ((F.col("kind") == FALLS_TO) & (F.col("price") >= last)) | (
        (F.col("kind") == RISES_TO) & (F.col("price") <= last)
    )
    return alerts.filter(F.col("active_since").isNotNull()).join(current, "symbol").filter(met)


def alerts_fired(alerts: DataFrame, prices: DataFrame) -> DataFrame:
    return alerts_hit(alerts, prices).select("user_id", "symbol", F.col("last_price").alias("price"), "kind")


def alerts_remaining(alerts: DataFrame, hit: DataFrame) -> DataFrame:
    """Alerts left after those in ``hit`` are removed by id."""
    return alerts.join(hit.select("id"), "id", "left_anti").select(*alerts.columns)


def alerts_archived(hit: DataFrame, triggered_at: dt.datetime | str) -> DataFrame:
    """Archive rows of fired alerts; the id is kept so that a replay can be recognised."""
    return hit.select(
        "id",
        "user_id",
        "symbol",
        "price",
        "kind",
        "created_at",
        "active_since",
        "last_price",
        F.lit(as_utc(triggered_at)).alias("triggered_at"),
    )


def arm_alerts(requests: DataFrame, prices: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """New alerts, active only if their condition does not hold yet.

    At an equal or unknown price ``active_since`` stays NULL, and the alert never
    fires.
    """
    current = prices.select("symbol", F.col("price").alias("_current"))
    waiting = ((F.col("kind") == RISES_TO) & (F.col("_current") < F.col("price"))) | (
        (F.col("kind") == FALLS_TO) & (F.col("_current") > F.col("price"))
    )
    since = F.when(waiting, F.lit(as_utc(as_of)))
    return requests.join(current, "symbol", "left").withColumn("active_since", since).drop("_current")
