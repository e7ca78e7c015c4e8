"""Ordered windows that no single hot series can overload.

``Window.partitionBy(symbol, period)`` puts a whole series into one task. Here a
series is cut into blocks of about ``block_rows`` consecutive rows, and every
block also receives copies of the rows its frames reach into. Windows then run
over ``(series, block)``, and the copies are dropped afterwards, so the result
is exactly that of the unsplit window.

Rows are first mapped to chunks, any bucketing that never decreases along the
order (for bars: a fixed number of periods of clock time). Only the small table
of rows per chunk is ordered as a whole, to give each chunk its start position;
it holds one row per ``chunk_rows`` periods of a series. Blocks follow from row
positions, not from clock time, so gaps in a series neither unbalance them nor
shorten a frame.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schemas import period_to_ms

SERIES = ("symbol", "period")
UNBOUNDED = Window.unboundedPreceding


@dataclass(frozen=True)
class Blocks:
    """How finely to cut: rows per chunk (at most, for regular bars) and per block.

    With ``counts_dir``, a folder all executors can reach, the chunk table is
    written there first. It costs a stage of its own, but then Spark knows the
    table's size when it plans the join: a small table is broadcast and the rows
    are shuffled once, not twice. Left out, the size is only known after the rows
    have been shuffled for a sort-merge join.
    """

    chunk_rows: int = 4096
    block_rows: int = 131072
    counts_dir: str | None = None


DEFAULT_BLOCKS = Blocks()


@dataclass(frozen=True)
class BlockedRows:
    """Rows with their block, the window over it and the position in the whole series."""

    df: DataFrame
    window: WindowSpec
    position: Column

    def owned(self, df: DataFrame) -> DataFrame:
        """Drop the copies lent to neighbouring blocks, and the helper columns."""
        return df.filter("_own").drop("_own", "_block", "_start", "_chunk")


def bar_chunk(blocks: Blocks = DEFAULT_BLOCKS) -> Column:
    """Chunk of a bar: ``chunk_rows`` periods of clock time."""
    return F.floor(F.col("open_time") / (period_to_ms(F.col("period")) * blocks.chunk_rows))


def chunk_starts(df: DataFrame, keys: Sequence[str], chunk: Column, *totals: Column) -> DataFrame:
    """Rows per chunk and the position of its first row; ``totals`` are further aggregates."""
    per_chunk = df.groupBy(*keys, chunk.alias("_chunk")).agg(F.count(F.lit(1)).alias("_rows"), *totals)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(UNBOUNDED, -1)
    return per_chunk.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def _stored(starts: DataFrame, blocks: Blocks) -> DataFrame:
    if blocks.counts_dir is None:
        return starts
    path = f"{blocks.counts_dir.rstrip('/')}/chunks-{uuid.uuid4().hex}"
    starts.write.parquet(path)
    return starts.sparkSession.read.schema(starts.schema).parquet(path)


def _lend(df: DataFrame, own: Column, first: Column, last: Column, lends: bool) -> DataFrame:
    if not lends:
        return df.withColumns({"_block": own, "_own": F.lit(True)})
    copies = df.withColumn("_block", F.explode(F.sequence(first, last)))
    return copies.withColumn("_own", F.col("_block") == own)


def split_series(
    df: DataFrame,
    *,
    keys: Sequence[str] = SERIES,
    order: Sequence[str] = ("open_time",),
    before: int = 0,
    after: int = 0,
    chunk: Column | None = None,
    totals: Mapping[str, Column] | None = None,
    blocks: Blocks = DEFAULT_BLOCKS,
) -> BlockedRows:
    """Cut series into blocks whose windows see ``before`` and ``after`` further rows.

    Cost: one aggregation to the chunk table, one join with it (Spark broadcasts
    it while it is small, else it shuffles on the chunk, which is never hot) and
    one shuffle of the rows, plus the copies. ``totals`` are sums or counts wanted
    over the whole series; they are added up from the chunks and put on every row.
    """
    chunk = bar_chunk(blocks) if chunk is None else chunk
    totals = totals or {}
    size = max(blocks.block_rows, before + after + 1)
    starts = chunk_starts(df, keys, chunk, *[total.alias(name) for name, total in totals.items()])
    whole = Window.partitionBy(*keys)
    if after:
        starts = starts.withColumn("_largest", F.max("_rows").over(whole))
        reach_back = F.greatest(F.col("_start") - after - F.col("_largest"), F.lit(0))
    else:
        reach_back = F.col("_start")
    starts = starts.select(
        *keys,
        "_chunk",
        "_start",
        *[F.sum(name).over(whole).alias(name) for name in totals],
        F.floor(F.col("_start") / size).alias("_home"),
        F.floor(reach_back / size).alias("_first"),
        F.floor((F.col("_start") + F.col("_rows") - 1 + before) / size).alias("_last"),
    )
    starts = _stored(starts, blocks)
    rows = df.withColumn("_chunk", chunk).join(starts, [*keys, "_chunk"])
    rows = _lend(
        rows, F.col("_home"), F.col("_first"), F.col("_last"), bool(before or after)
    ).drop("_first", "_last", "_home")
    window = Window.partitionBy(*keys, "_block").orderBy(*order)
    # A block holds whole, consecutive chunks, so counting on from its first start is exact.
    position = F.first("_start").over(window.rowsBetween(UNBOUNDED, 0)) + F.row_number().over(window) - 1
    return BlockedRows(rows, window, position)


def split_positions(
    df: DataFrame,
    *,
    position: str,
    keys: Sequence[str] = SERIES,
    before: int = 0,
    after: int = 0,
    blocks: Blocks = DEFAULT_BLOCKS,
) -> BlockedRows:
    """As ``split_series`` for rows that already carry their 0-based position: no join."""
    size = max(blocks.block_rows, before + after + 1)
    at = F.col(position)
    rows = _lend(
        df,
        F.floor(at / size),
        F.floor(F.greatest(at - after, F.lit(0)) / size),
        F.floor((at + before) / size),
        bool(before or after),
    )
    return BlockedRows(rows, Window.partitionBy(*keys, "_block").orderBy(position), at)


def with_position(
    df: DataFrame,
    *,
    keys: Sequence[str] = SERIES,
    order: Sequence[str] = ("open_time",),
    chunk: Column | None = None,
    name: str = "position",
    blocks: Blocks = DEFAULT_BLOCKS,
) -> DataFrame:
    """Number the rows of each series from 0 in order."""
    cut = split_series(df, keys=keys, order=order, chunk=chunk, blocks=blocks)
    return cut.owned(cut.df.withColumn(name, cut.position))


def first_rows(
    df: DataFrame,
    n: int,
    *,
    keys: Sequence[str] = SERIES,
    order: Sequence[str] = ("open_time",),
    chunk: Column | None = None,
    name: str = "row_number",
    blocks: Blocks = DEFAULT_BLOCKS,
) -> DataFrame:
    """The first ``n`` rows of each series in order, numbered from 1.

    The chunk that holds the n-th row is found in the table of counts, chunks after it are not shuffled, and rows are
    ranked within their chunk alone: any ``n`` costs one aggregation and a shuffle of n rows and one chunk a series.
    """
    chunk = bar_chunk(blocks) if chunk is None else chunk
    reached = chunk_starts(df, keys, chunk).where(F.col("_start") < n).select(*keys, "_chunk", "_start")
    rows = df.withColumn("_chunk", chunk).join(_stored(reached, blocks), [*keys, "_chunk"])
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    ranked = rows.withColumn(name, (F.col("_start") + F.row_number().over(inside)).cast("int"))
    return ranked.where(F.col(name) <= n).drop("_chunk", "_start")


def running_total(
    df: DataFrame,
    value: str,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    name: str,
) -> DataFrame:
    """Running sum along each series: sum inside the chunk plus the sum of earlier chunks.

    ``value`` is decimal; the total keeps its scale.
    """
    starts = chunk_starts(df, keys, chunk, F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(UNBOUNDED, -1)
    starts = starts.select(*keys, "_chunk", F.sum("_sum").over(before).alias("_before"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(UNBOUNDED, 0)
    rows = df.withColumn("_chunk", chunk).join(starts, [*keys, "_chunk"])
    # One digit below the maximum on both sides, so that adding them rounds nothing away.
    exact = T.DecimalType(37, df.schema[value].dataType.scale)
    earlier = F.coalesce("_before", F.lit(0)).cast(exact)
    total = earlier + F.sum(value).over(inside).cast(exact)
    return rows.withColumn(name, total).drop("_chunk", "_before")
