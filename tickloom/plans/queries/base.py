"""Registration of checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.plans.fixtures import Tables
from tickloom.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BAR_VALUES = (
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "volume",
    "quote_asset_volume",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
)


def presented(df: DataFrame) -> DataFrame:
    """Result columns in types both engines print alike: no decimals, no zoned times."""
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def query(name: str, sql: str | None = None):
    """Register ``function(tables)`` under ``name``, with the SQL that checks it."""

    def add(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presented(function(Tables(prepare(spark), sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def as_double(*names: str, table: str = "") -> str:
    prefix = f"{table}." if table else ""
    return ", ".join(f"CAST({prefix}{n} AS DOUBLE) AS {n}" for n in names)


BAR_SQL = f"symbol, period, open_time, close_time, num_trades, {as_double(*BAR_VALUES)}"
