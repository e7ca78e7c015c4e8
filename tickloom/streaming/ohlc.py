"""Running open/high/low/close per symbol and clock bucket, of ticks of any lateness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.bars import merge_ohlc, ohlc_parts
from tickloom.schemas import PRICE
from tickloom.sources.logged import LoggedTable, logged
from tickloom.streaming.feeds import run_batches

OHLC = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("period_start", T.TimestampType(), False),
        *[T.StructField(f"{n}_price", PRICE) for n in ("open", "high", "low", "close")],
    ]
)
OHLC_KEY = ("symbol", "period_start")


def ohlc_table(path: str, order: T.StructType) -> LoggedTable:
    """Parts of bars by day of their bucket; ``order`` is the type of a tick's order."""
    parts = T.StructType([*OHLC.fields, T.StructField("open_order", order), T.StructField("close_order", order)])
    return logged(f"{path}/ohlc", parts, OHLC_KEY, merge_ohlc, day=F.to_date("period_start"))


def order_type(ticks: DataFrame, order: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, ticks.schema[c].dataType) for c in order])


def stream_ohlc(
    ticks: DataFrame,
    duration_ms: int,
    path: str,
    *,
    order: Sequence[str] = ("ts",),
    available_now: bool = True,
) -> StreamingQuery:
    """Ticks (symbol, ts, price) to bars that grow as ticks arrive, in ``path/ohlc``.

    Each batch adds a part for every symbol and bucket it touches, aggregated map-side before the shuffle; parts are
    merged when read, and by ``compact_ohlc`` once for all. Nothing else is kept, so there is no watermark: a tick
    counts however late it is, and one that is sent again changes nothing. Any period will do, months included. Ticks
    without a symbol or a time are left out.
    """
    table = ohlc_table(path, order_type(ticks, order))

    def handle(batch: DataFrame, number: int) -> None:
        dated = batch.where("symbol IS NOT NULL AND ts IS NOT NULL")
        table.append(ohlc_parts(dated, duration_ms, order=order), number)

    return run_batches(ticks, handle, f"{path}/checkpoint", available_now=available_now)


def _orders(spark: SparkSession, path: str) -> T.StructType:
    """The type of the order, from the files' own schema."""
    return spark.read.parquet(f"{path}/ohlc").schema["open_order"].dataType


def read_ohlc(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The bars; ``where`` on ``day`` reads only the days asked for."""
    return ohlc_table(path, _orders(spark, path)).read(spark, where).select(*OHLC.names)


def compact_ohlc(spark: SparkSession, path: str, upto: int) -> None:
    """Merge the parts of the days that batches up to ``upto`` have touched."""
    ohlc_table(path, _orders(spark, path)).compact(spark, upto)
