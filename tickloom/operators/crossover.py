"""Moving-average crossover: one pair, a few pairs, or the whole grid of pairs.

All averages are differences of one running sum of closes, so a bar costs the
same for a long average as for a short one. Sums are decimal, hence exact; they
become double just before the division.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.signals import BUY, SELL, crossover_signal, pack_indicator_id
from tickloom.operators.bars import resample_by_count
from tickloom.operators.blocks import (
    DEFAULT_BLOCKS,
    SERIES,
    UNBOUNDED,
    BlockedRows,
    Blocks,
    split_positions,
    split_series,
)
from tickloom.schemas import SIGNAL_PERIOD_MINUTES, SIGNALS

# The grid of terms and the code of this indicator.
LONG_TERMS = (10, 100)
SHORT_TERMS = (6, 66)
MAC = 0

# The grid turns each bar into thousands of pairs in the window's own stage, so its
# blocks are small: work per task stays even, for five percent of copied rows.
GRID_BLOCKS = Blocks(block_rows=2048)
GRID_ROWS = 4096


def _since(total: str, newest: int, rows: int, window) -> Column:
    """Sum of ``rows`` bars ending ``newest`` bars back, from the running sum."""
    end = F.lag(total, newest).over(window) if newest else F.col(total)
    return end - F.coalesce(F.lag(total, newest + rows).over(window), F.lit(0))


def _mean(total: str, newest: int, rows: int, window) -> Column:
    """Mean of the values there are among ``rows`` bars; NULL if there is none."""
    count = _since(f"{total}_n", newest, rows, window)
    return F.try_divide(_since(total, newest, rows, window).cast("double"), count.cast("double"))


def _totals(column: str, name: str, running) -> dict[str, Column]:
    """Running sum and number of the values that are not NULL."""
    total = F.coalesce(F.sum(column).over(running), F.lit(0).cast("decimal(38,8)"))
    return {name: total, f"{name}_n": F.count(column).over(running)}


def moving_average_pair(bars: DataFrame, n: int, *, blocks: Blocks = DEFAULT_BLOCKS) -> DataFrame:
    """For the n+1 bars up to each bar: mean of the first n and mean of the last n.

    NULL while there are fewer than n+1 bars. For n <= 0 the first mean is -1 and
    the second 0, the marks of "no average".
    """
    slim = bars.select(*SERIES, "open_time", "close_price")
    if n <= 0:
        return slim.withColumns({"avg1": F.lit(-1.0), "avg2": F.lit(0.0)})
    cut = split_series(slim, before=n + 1, blocks=blocks)
    w = cut.window
    rows = cut.df.withColumns(
        {"_at": cut.position, **_totals("close_price", "_total", w.rowsBetween(UNBOUNDED, 0))}
    ).withColumns({"avg1": _mean("_total", 1, n, w), "avg2": _mean("_total", 0, n, w)})
    full = F.col("_at") >= n
    return cut.owned(rows).select(
        *SERIES,
        "open_time",
        "close_price",
        F.when(full, F.col("avg1")).alias("avg1"),
        F.when(full, F.col("avg2")).alias("avg2"),
    )


def mac_crossover(
    bars: DataFrame, long_term: int, short_term: int, *, blocks: Blocks = DEFAULT_BLOCKS
) -> DataFrame:
    """The bare rule on the last ``long_term`` bars up to and including each bar.

    An average "over n" covers n-1 bars: the first or the last n-1 of those n.
    """
    slim = bars.select(*SERIES, "open_time", "close_price")
    cut = split_series(slim, before=long_term + 1, blocks=blocks)
    w = cut.window
    rows = cut.df.withColumns(
        {"_at": cut.position, **_totals("close_price", "_total", w.rowsBetween(UNBOUNDED, 0))}
    )

    def pair(term: int) -> tuple[Column, Column]:
        if term <= 1:
            return F.lit(-1.0), F.lit(0.0)
        return _mean("_total", 1, term - 1, w), _mean("_total", 0, term - 1, w)

    s1, s2 = pair(short_term)
    l1, l2 = pair(long_term)
    rows = cut.owned(rows.withColumns({"s1": s1, "s2": s2, "l1": l1, "l2": l2}))
    rule = crossover_signal(F.col("s1"), F.col("s2"), F.col("l1"), F.col("l2"))
    return rows.filter(F.col("_at") >= long_term - 1).select(
        *SERIES, "open_time", "close_price", "s1", "s2", "l1", "l2", rule.alias("trade_signal")
    )


def _running(cut: BlockedRows, kept: Sequence[str]) -> DataFrame:
    running = cut.window.rowsBetween(UNBOUNDED, 0)
    return cut.df.select(
        *kept,
        "_own",
        "_block",
        cut.position.alias("_at"),
        *[c.alias(n) for n, c in _totals("close_price", "_closes", running).items()],
        *[c.alias(n) for n, c in _totals("volume", "_volumes", running).items()],
    )


def _check_terms(long_term: int, short_term: int) -> None:
    if not 1 < short_term < long_term:
        raise ValueError("a crossover needs 1 < short term < long term")


def mac_signals(
    bars: DataFrame,
    pairs: Sequence[tuple[int, int]],
    *,
    position: str | None = None,
    keys: Sequence[str] = SERIES,
    blocks: Blocks = DEFAULT_BLOCKS,
    only: str | None = None,
    by_bar: bool = False,
) -> DataFrame:
    """Crossover signals of a few (long, short) pairs, all pairs in one pass.

    The averages at a bar use earlier bars only (the bar itself is excluded); an
    average "over n" covers n-1 bars. A bar needs more than ``long + 1`` bars
    before it. Volume means include the bar. One row per bar and signalling pair;
    ``only`` and ``by_bar`` as in ``mac_grid``.
    """
    for long_term, short_term in pairs:
        _check_terms(long_term, short_term)
    longest = max(long_term for long_term, _ in pairs)
    if position is None:
        cut = split_series(bars, keys=keys, before=longest + 2, blocks=blocks)
    else:
        cut = split_positions(bars, position=position, keys=keys, before=longest + 2, blocks=blocks)
    w = cut.window
    named = [c for c in (position, only) if c is not None]
    rows = _running(cut, [*keys, "open_time", "volume", *named])
    means: dict[str, Column] = {"vol3_avg": _mean("_volumes", 0, 3, w)}
    for term in sorted({t for pair in pairs for t in pair}):
        means[f"_first{term}"] = _mean("_closes", 2, term - 1, w)
        means[f"_last{term}"] = _mean("_closes", 1, term - 1, w)
    for term in sorted({long_term for long_term, _ in pairs}):
        means[f"_volume{term}"] = _mean("_volumes", 0, term, w)
    rows = cut.owned(rows.withColumns(means))
    if only is not None:
        rows = rows.filter(only)

    def signal(long_term: int, short_term: int) -> Column:
        rule = crossover_signal(
            F.col(f"_first{short_term}"),
            F.col(f"_last{short_term}"),
            F.col(f"_first{long_term}"),
            F.col(f"_last{long_term}"),
        )
        return F.when(F.col("_at") >= long_term + 2, rule)

    if by_bar:
        sets = []
        for term in sorted({long_term for long_term, _ in pairs}):
            shorts = sorted({short_term for long_term, short_term in pairs if long_term == term})
            ids = F.array(*[_indicator_id(F.lit(term), F.lit(s), signal(term, s)) for s in shorts])
            sets.append(_signal_set(F.lit(term), F.col(f"_volume{term}"), F.filter(ids, lambda i: i.isNotNull())))
        shortest = min(long_term for long_term, _ in pairs)
        return _bar_rows(rows.filter(F.col("_at") >= shortest + 2), F.array(*sets), keys)
    found = [
        F.struct(
            F.lit(long_term).alias("long_term"),
            F.lit(short_term).alias("short_term"),
            signal(long_term, short_term).alias("trade_signal"),
            F.col(f"_volume{long_term}").alias("vol_avg"),
        )
        for long_term, short_term in pairs
    ]
    return _signal_rows(rows.select(*keys, "open_time", "volume", "vol3_avg", F.inline(F.array(*found))), keys)


def _signal_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    rows = rows.filter(F.col("trade_signal").isNotNull())
    return rows.select(
        *keys,
        "open_time",
        pack_indicator_id(
            F.lit(MAC), F.col("long_term"), F.col("short_term"), F.col("trade_signal")
        ).alias("indicator_id"),
        "long_term",
        "short_term",
        "trade_signal",
        F.col("volume").cast("double").alias("volume"),
        "vol_avg",
        "vol3_avg",
    )


def _indicator_id(long_term: Column, short_term: Column, signal: Column) -> Column:
    """The id of a signal; NULL where there is none."""
    return F.when(signal.isNotNull(), pack_indicator_id(F.lit(MAC), long_term, short_term, signal))


def _signal_set(long_term: Column, vol_avg: Column, ids: Column) -> Column:
    """The signals of a bar that share a long term and so their volume mean: an entry of ``signals``."""
    held = F.struct(vol_avg.alias("vol_avg"), ids.alias("indicator_ids"))
    return F.struct(long_term.alias("long_term"), held.alias("held"))


def _bar_rows(rows: DataFrame, sets: Column, keys: Sequence[str]) -> DataFrame:
    held = F.filter(sets, lambda s: F.size(s["held"]["indicator_ids"]) > 0)
    volume = F.col("volume").cast("double").alias("volume")
    return rows.select(*keys, "open_time", volume, "vol3_avg", F.map_from_entries(held).alias("signals"))


def signal_rows(by_bar: DataFrame) -> DataFrame:
    """One row for each signal of rows per bar, all other columns kept."""
    kept = [c for c in by_bar.columns if c != "signals"]
    sets = by_bar.select(*kept, F.explode("signals").alias("_long", "_held"))
    return sets.select(*kept, F.col("_held.vol_avg").alias("vol_avg"), F.explode("_held.indicator_ids").alias("indicator_id"))


def mac_grid(
    bars: DataFrame,
    *,
    position: str,
    keys: Sequence[str],
    long_terms: tuple[int, int] = LONG_TERMS,
    short_terms: tuple[int, int] = SHORT_TERMS,
    blocks: Blocks = GRID_BLOCKS,
    partitions: int | None = None,
    only: str | None = None,
    by_bar: bool = False,
) -> DataFrame:
    """Crossover signals of every pair with short < long, for numbered bars.

    One window pass puts the recent running sums of a bar into an array; the array
    becomes one mean pair per term, computed once; then terms are expanded long by
    short inside generated code and only signalling pairs survive. No shuffle
    follows the window.

    The output grows by up to one row for each pair, some thousands, per bar.
    ``partitions`` is the number of tasks; by default one for GRID_ROWS bars, counted
    from the input, and no fewer than the shuffle setting. A stated number keeps AQE
    from merging partitions that hold few bytes but thousands of pairs per row. A NULL
    close or volume counts as no value.

    ``only`` names a flag: bars without it are seen by the averages of others alone.
    ``by_bar`` gives one row for each bar with enough bars before it, its signals in the
    map ``signals``: for each long term that has any, the volume mean and the indicator ids
    (``signal_rows`` makes rows of them).
    """
    low, high = long_terms
    short_low, short_high = short_terms
    _check_terms(low, short_low)
    flags = [] if only is None else [only]
    slim = bars.select(*keys, position, "open_time", "close_price", "volume", *flags)
    cut = split_positions(slim, position=position, keys=keys, before=high + 2, blocks=blocks)
    if partitions is None:
        least = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = max(least, -(-slim.count() // GRID_ROWS))
    cut = replace(cut, df=cut.df.repartition(partitions, *keys, "_block"))
    w = cut.window
    rows = _running(cut, [*keys, "open_time", "volume", position, *flags])
    recent = w.rowsBetween(-(high + 1), 0)
    rows = rows.withColumns(
        {
            name: F.collect_list(name).over(recent) for name in ("_closes", "_closes_n", "_volumes", "_volumes_n")
        }
    )
    # A term n needs position n + 2 at least; so the arrays hold n + 2 sums or more.
    rows = cut.owned(rows).filter(F.col("_at") >= low + 2)
    if only is not None:
        rows = rows.filter(only)
    size = F.size("_closes")

    def mean(name: str, newest: int, oldest: Column | int) -> Column:
        """Mean of the values there are after ``oldest`` bars back, up to ``newest`` bars back."""
        since = lambda x: F.get(x, size - 1 - newest) - F.get(x, size - 1 - oldest)
        return F.try_divide(since(name).cast("double"), since(f"{name}_n").cast("double"))

    def term_means(n: Column) -> Column:
        return F.struct(
            n.alias("n"),
            mean("_closes", 2, n + 1).alias("m1"),
            mean("_closes", 1, n).alias("m2"),
            mean("_volumes", 0, n).alias("v"),
        )

    last_term = F.least(F.lit(high), (F.col("_at") - 2).cast("int"))
    rows = rows.select(
        *keys,
        "open_time",
        F.col("volume").cast("double").alias("volume"),
        mean("_volumes", 0, 3).alias("vol3_avg"),
        F.transform(F.sequence(F.lit(short_low), last_term), term_means).alias("_means"),
    )
    kept = [*keys, "open_time", "volume", "vol3_avg"]
    long_part = F.slice("_means", low - short_low + 1, high - low + 1)
    if by_bar:
        # The rule of ``crossover_signal``; what depends on the short term alone is looked at once for all long ones.
        shorts = F.slice("_means", 1, short_high - short_low + 1)
        valid = lambda s: (s["m1"] >= 0) & (s["m2"] >= 0)
        up = F.filter(shorts, lambda s: (s["m1"] < s["m2"]) & valid(s))
        down = F.filter(shorts, lambda s: (s["m1"] > s["m2"]) & valid(s))
        rows = rows.select(*kept, long_part.alias("_longs"), up.alias("_up"), down.alias("_down"))

        def crossing(name: str, long: Column, crosses, signal: str) -> Column:
            shorter = F.when(long["n"] > short_high, F.col(name)).otherwise(F.filter(name, lambda s: s["n"] < long["n"]))
            return F.transform(F.filter(shorter, crosses), lambda s: _indicator_id(long["n"], s["n"], F.lit(signal)))

        def signal_set(long: Column) -> Column:
            buys = crossing("_up", long, lambda s: (s["m1"] < long["m1"]) & (s["m2"] > long["m2"]), BUY)
            sells = crossing("_down", long, lambda s: (s["m1"] > long["m1"]) & (s["m2"] < long["m2"]), SELL)
            return _signal_set(long["n"], long["v"], F.concat(buys, sells))

        return _bar_rows(rows, F.transform("_longs", signal_set), keys)
    # ``inline`` turns the fields of a term into plain variables of the generated loop.
    rows = rows.select(*kept, "_means", F.inline(long_part).alias("long_term", "_l1", "_l2", "vol_avg"))
    count = F.least(F.col("long_term") - short_low, F.lit(short_high - short_low + 1))
    short_part = F.slice("_means", F.lit(1), count)
    rows = rows.select(
        *kept, "long_term", "_l1", "_l2", "vol_avg", F.inline(short_part).alias("short_term", "_s1", "_s2", "_v")
    )
    rule = crossover_signal(F.col("_s1"), F.col("_s2"), F.col("_l1"), F.col("_l2"))
    rows = rows.select(*kept, "long_term", "short_term", "vol_avg", rule.alias("trade_signal"))
    return _signal_rows(rows, keys)


def mac_grid_signals(
    minute_bars: DataFrame,
    *,
    sizes: Sequence[int] = SIGNAL_PERIOD_MINUTES,
    long_terms: tuple[int, int] = LONG_TERMS,
    short_terms: tuple[int, int] = SHORT_TERMS,
    blocks: Blocks = DEFAULT_BLOCKS,
) -> DataFrame:
    """The signal job: minute bars folded into every size, and the whole grid on each.

    ``period`` in the result is the index of the bar size in the list of sizes.
    Each bar is evaluated once.
    """
    folded = resample_by_count(minute_bars, sizes, blocks=blocks)
    # Counted on the minutes: counting the folded bars would fold them twice.
    least = int(minute_bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bars = minute_bars.count() * sum(1 / size for size in sizes)
    grid = mac_grid(
        folded,
        position="bar_index",
        keys=("symbol", "size"),
        long_terms=long_terms,
        short_terms=short_terms,
        partitions=max(least, math.ceil(bars / GRID_ROWS)),
    )
    return as_signals(grid, sizes)


def as_signals(
    rows: DataFrame, sizes: Sequence[int] = SIGNAL_PERIOD_MINUTES, columns: Sequence[str] = SIGNALS.names
) -> DataFrame:
    """Rows per (symbol, size) in the layout of the signal table, or with other ``columns``."""
    listed = F.array(*[F.lit(n) for n in sizes])
    index = (F.array_position(listed, F.col("size")) - 1).cast("int")
    return rows.withColumn("period", index).select(*columns)
