"""Message feeds into keyed tables: bars and order-book levels."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.keyed import latest_per_key, register_unknown_symbols
from tickloom.schemas import BAR_KEY, BARS, BOOK, BOOK_KEY
from tickloom.sources.logged import LoggedTable, logged
from tickloom.sources.messages import (
    bar_event_rejects,
    depth_counts,
    depth_element_rejects,
    depth_rejects,
    parse_bar_events,
    parse_depth_updates,
)
from tickloom.sources.snapshots import Snapshots
from tickloom.sources.storage import write_batch


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    available_now: bool = True,
    mode: str = "append",
) -> StreamingQuery:
    """Start ``handle(batch, number)`` on a stream; by default drain it and stop."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(handle).start()


def bars_table(path: str) -> LoggedTable:
    """Streamed bars by period and day."""
    day = F.to_date(F.timestamp_millis("open_time"))
    return logged(f"{path}/bars", BARS, BAR_KEY, period=F.col("period"), day=day)


def read_stream_bars(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The bars as of the last batch; ``where`` on ``period`` and ``day`` reads only the partitions asked for."""
    return bars_table(path).read(spark, where)


def compact_stream_bars(spark: SparkSession, path: str, upto: int) -> None:
    """Compact the days that batches up to ``upto`` have touched, and no others."""
    bars_table(path).compact(spark, upto)


def levels_table(path: str) -> LoggedTable:
    """Streamed book levels by day."""
    return logged(f"{path}/levels", BOOK, BOOK_KEY, day=F.to_date("ptime"))


def read_stream_levels(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The book levels as of the last batch; ``where`` on ``day`` reads only the days asked for."""
    return levels_table(path).read(spark, where)


def book_snapshots(path: str) -> Snapshots:
    return Snapshots(levels_table(path), ("symbol", "side", "price"), "ptime")


def snapshot_stream_levels(spark: SparkSession, path: str, day: dt.date, upto: int) -> None:
    """Keep the book as it was at the start of ``day``, as batches up to ``upto`` tell it."""
    book_snapshots(path).take(spark, day, upto)


def read_stream_book(spark: SparkSession, path: str, finish: dt.datetime | str) -> DataFrame:
    """The book at ``finish``: the latest level per (symbol, side, price), removed ones (volume 0) included.

    It reads the last snapshot before ``finish``, the days from it on and the levels that came late, and equals the
    reduction of all levels up to ``finish``, so ``support_levels`` may be given either.
    """
    return book_snapshots(path).at(spark, finish)


def stream_bars(
    messages: DataFrame,
    path: str,
    *,
    ingest_order: Sequence[str],
    available_now: bool = True,
) -> StreamingQuery:
    """Bar events (``value`` and the ``ingest_order`` columns) into ``path/bars``.

    The last message of a key wins, whenever it arrives: there is no watermark,
    so a bar sent again days later still replaces the stored one. Messages that
    hold no bar go to ``path/rejects``. The table is laid out by period and day
    (``read_stream_bars``, ``compact_stream_bars``).
    """

    def handle(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            rows = latest_per_key(parse_bar_events(batch), BAR_KEY, ingest_order, keep_order=False)
            bars_table(path).append(rows, number)
            write_batch(bar_event_rejects(batch), f"{path}/rejects", number)
        finally:
            batch.unpersist()

    return run_batches(messages, handle, f"{path}/checkpoint", available_now=available_now)


def stream_depth(
    messages: DataFrame,
    path: str,
    *,
    ingest_order: Sequence[str],
    prices: DataFrame | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Depth messages into ``path/levels``, and bids and asks per message into ``path/counts``.

    Unreadable messages go to ``path/rejects``, unreadable levels to ``path/level_rejects``. With a table of
    ``prices`` the symbols it lacks go to ``path/registered``, with price 0. The levels of a batch are parsed once, into
    ``path/incoming``.
    """
    spark = messages.sparkSession

    def handle(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            # Adaptive execution is off in a stream's own session: there each of its many shuffle partitions would write
            # a file for every day. Landed levels are reduced in the caller's session.
            parsed = parse_depth_updates(batch)
            write_batch(parsed, f"{path}/incoming", number)
            incoming = spark.read.schema(parsed.schema).parquet(f"{path}/incoming/batch={number}")
            rows = latest_per_key(incoming, BOOK_KEY, ingest_order, keep_order=False)
            levels_table(path).append(rows, number)
            write_batch(depth_counts(batch), f"{path}/counts", number)
            write_batch(depth_rejects(batch), f"{path}/rejects", number)
            write_batch(depth_element_rejects(batch), f"{path}/level_rejects", number)
            if prices is not None:
                listed = prices.select("symbol", "price")
                unknown = register_unknown_symbols(listed, depth_counts(batch)).join(
                    listed.select("symbol"), "symbol", "left_anti"
                )
                write_batch(unknown, f"{path}/registered", number)
        finally:
            batch.unpersist()

    return run_batches(messages, handle, f"{path}/checkpoint", available_now=available_now)
