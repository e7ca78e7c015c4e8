"""Crossover signals from a stream of minute bars that are re-sent, late or new: signals can be taken back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.bars import SUMMED, fold_positions
from tickloom.operators.blocks import DEFAULT_BLOCKS, SERIES, Blocks, split_positions, with_position
from tickloom.operators.crossover import LONG_TERMS, SHORT_TERMS, as_signals, mac_grid, mac_signals, signal_rows
from tickloom.operators.keyed import latest_per_key
from tickloom.schemas import BAR_SIGNALS, BARS, SIGNAL_PERIOD_MINUTES, SIGNAL_SETS, SIGNALS
from tickloom.session import shuffles_dropped
from tickloom.sources.logged import LoggedTable, logged
from tickloom.sources.storage import write_batch
from tickloom.streaming.feeds import run_batches

SIGNAL_BAR = ("symbol", "period", "open_time")
BAR_OF = ("symbol", "size")
NUMBERED = T.StructType([*BARS.fields, T.StructField("position", T.LongType(), False)])
FOLDED = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("size", T.IntegerType(), False),
        T.StructField("bar_index", T.LongType(), False),
        *[BARS[c] for c in ("open_time", "open_price", "high_price", "low_price", "close_price", "close_time")],
        *[BARS[c] for c in SUMMED],
    ]
)
STARTS = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("chunk", T.LongType(), False),
        T.StructField("first_open", T.LongType(), False),
    ]
)
STATED = T.StructType([*SIGNALS.fields, T.StructField("withdrawn", T.BooleanType(), False)])
SIGNAL_CODEC = "zstd"
MINUTE_CHUNK = 1 << 14
BAR_CHUNK = 1 << 12


def minutes_table(path: str, chunk: int = MINUTE_CHUNK) -> LoggedTable:
    """Minutes with their position in the series, by runs of positions."""
    return logged(f"{path}/minutes", NUMBERED, ("symbol", "position"), chunk=F.floor(F.col("position") / chunk))


def starts_table(path: str) -> LoggedTable:
    """The first minute of each run of positions: one row for thousands of minutes."""
    return logged(f"{path}/starts", STARTS, ("symbol", "chunk"), part=F.floor(F.col("chunk") / 4096))


def folded_table(path: str) -> LoggedTable:
    return logged(
        f"{path}/folded", FOLDED, (*BAR_OF, "bar_index"), size=F.col("size"), part=F.floor(F.col("bar_index") / BAR_CHUNK)
    )


def signals_table(path: str) -> LoggedTable:
    """The signals, one row for each bar; a row without any says that its bar has none any more."""
    parts = {"period": F.col("period"), "day": F.to_date(F.timestamp_millis("open_time"))}
    return LoggedTable(f"{path}/signals", BAR_SIGNALS, SIGNAL_BAR, parts, live=F.size("signals") > 0, codec=SIGNAL_CODEC)


def stream_signals(
    minute_bars: DataFrame,
    path: str,
    pairs: Sequence[tuple[int, int]] | None = None,
    *,
    sizes: Sequence[int] = SIGNAL_PERIOD_MINUTES,
    long_terms: tuple[int, int] = LONG_TERMS,
    short_terms: tuple[int, int] = SHORT_TERMS,
    ingest_order: Sequence[str] = ("close_time", "num_trades"),
    blocks: Blocks = DEFAULT_BLOCKS,
    minute_chunk: int = MINUTE_CHUNK,
    available_now: bool = True,
) -> StreamingQuery:
    """Minute bars to crossover signals that equal the batch job's after every batch, whatever the order of arrival.

    ``pairs`` are (long, short) terms; without them the whole grid is evaluated. A minute that comes again replaces the
    stored one; one that is older than others takes its place among them, and all later positions move. Of equal
    minutes in a batch the last by ``ingest_order`` counts. Minutes without a symbol or time are left out.

    Kept are four tables, laid out so that a batch reads only what it touches: the numbered minutes, the first minute
    of each run of positions, the folded bars, and the signals. A batch reads the minutes from the run of its oldest
    minute on, numbers and folds them again from there, and evaluates the bars whose averages reach a bar that has
    changed: work grows with how far back its oldest minute lies, not with the history, and the feed's usual case, new
    minutes and the open one again, reads the last runs alone.

    ``path/changes`` gets, per batch, the signals that are ``withdrawn`` and those that are new, a row each; ``path/signals``
    is the table they add up to (``read_stream_signals``), a row for each bar: batches are compared, moved and written by
    bar. A replayed batch replaces its own rows everywhere.
    """
    if minute_chunk < max(sizes):
        raise ValueError("a run of positions must hold a bar of the largest size")
    longest = max(long_term for long_term, _ in pairs) if pairs is not None else long_terms[1]
    shortest = min(long_term for long_term, _ in pairs) if pairs is not None else long_terms[0]
    reach = longest + 2
    spark = minute_bars.sparkSession
    minutes, starts = minutes_table(path, minute_chunk), starts_table(path)
    folded, signals = folded_table(path), signals_table(path)
    ordered = [c for c in ingest_order if c not in BARS.names]

    def landed(rows: DataFrame, name: str, number: int) -> DataFrame:
        # Adaptive execution is off in a stream's own session; written rows are read in the caller's, with their size.
        write_batch(rows, f"{path}/{name}", number)
        return spark.read.schema(rows.schema).parquet(f"{path}/{name}/batch={number}")

    def evaluated(bars: DataFrame) -> DataFrame:
        kept = {"position": "bar_index", "keys": BAR_OF, "only": "_affected", "by_bar": True}
        if pairs is not None:
            return mac_signals(bars, pairs, blocks=blocks, **kept)
        return mac_grid(bars, long_terms=long_terms, short_terms=short_terms, **kept)

    def handle(batch: DataFrame, number: int) -> None:
        named = batch.select(*BARS.names, *ordered).where("symbol IS NOT NULL AND open_time IS NOT NULL")
        order = [F.col(c).alias(f"_order{i}") for i, c in enumerate(ingest_order)]
        arrivals = named.select(*BARS.names, *order)
        last = latest_per_key(arrivals, ("symbol", "open_time"), [f"_order{i}" for i in range(len(order))], keep_order=False)
        incoming = landed(last.select(*BARS.names), "incoming", number)

        # 1. where each touched symbol begins to change, as a run of positions
        touched = incoming.groupBy("symbol").agg(F.min("open_time").alias("_first"))
        known = starts.read(spark, before=number).join(touched, "symbol")
        run = F.max(F.when(F.col("first_open") <= F.col("_first"), F.col("chunk")))
        begins = known.groupBy("symbol").agg(F.greatest(F.coalesce(run, F.lit(0)) - 1, F.lit(0)).alias("_run"))
        begins = touched.join(begins, "symbol", "left").select("symbol", F.coalesce("_run", F.lit(0)).alias("_run"))
        begins = landed(begins, "begins", number)
        least = begins.agg(F.min("_run")).first()[0]
        if least is None:
            for table in (minutes, starts, folded, signals):
                table.append(spark.createDataFrame([], table.schema), number)
            write_batch(spark.createDataFrame([], STATED), f"{path}/changes", number)
            return

        # 2. the minutes from there on, numbered anew
        stored = minutes.read(spark, F.col("chunk") >= least, before=number).join(begins, "symbol")
        stored = stored.where(F.col("position") >= F.col("_run") * minute_chunk).drop("_run")
        both = stored.withColumn("_new", F.lit(False)).unionByName(
            incoming.withColumns({"position": F.lit(None).cast("bigint"), "_new": F.lit(True)})
        )
        values = [c for c in BARS.names if c not in ("symbol", "open_time")]
        one = both.groupBy("symbol", "open_time").agg(
            F.max_by(F.struct(*values), "_new").alias("_row"), F.max("position").alias("_old"), F.max("_new").alias("_new")
        )
        one = one.select("symbol", "open_time", "_row.*", "_old", "_new").join(begins, "symbol")
        numbered = with_position(one, keys=SERIES, blocks=blocks)
        numbered = numbered.withColumn("position", F.col("position") + F.col("_run") * minute_chunk)
        moved = F.col("_new") | ~F.col("position").eqNullSafe(F.col("_old"))
        merged = landed(numbered.select(*NUMBERED.names, moved.alias("_changed")), "merged", number)
        minutes.append(merged.where("_changed"), number)
        runs = merged.groupBy("symbol", F.floor(F.col("position") / minute_chunk).alias("chunk"))
        starts.append(runs.agg(F.min("open_time").alias("first_open")), number)

        # 3. bars that hold a changed minute; the first of them begins within the minutes read
        refolded = fold_positions(merged, sizes, greatest=["_changed"]).where("_changed")
        refolded = landed(refolded.select(*FOLDED.names), "refolded", number)
        folded.append(refolded, number)

        # 4. the bars around them: those that reach back to a changed bar, and what these reach back to
        lowest = refolded.groupBy(*BAR_OF).agg((F.min("bar_index") - reach).alias("_low"))
        lowest = landed(lowest, "lowest", number)
        by_size = lowest.groupBy("size").agg(F.floor(F.min("_low") / BAR_CHUNK).alias("part")).collect()
        near = F.lit(False)
        for r in by_size:  # one for each size of bars
            near = near | ((F.col("size") == r["size"]) & (F.col("part") >= r["part"]))
        before = folded.read(spark, near, before=number).join(lowest, list(BAR_OF)).where("bar_index >= _low").drop("_low")
        fresh = refolded.withColumn("_changed", F.lit(True))
        bars = before.join(refolded.select(*BAR_OF, "bar_index"), [*BAR_OF, "bar_index"], "left_anti")
        bars = bars.withColumn("_changed", F.lit(False)).unionByName(fresh)
        cut = split_positions(bars, position="bar_index", keys=BAR_OF, before=reach, after=reach, blocks=blocks)
        flagged = cut.df.withColumns(
            {
                "_affected": F.max("_changed").over(cut.window.rowsBetween(-reach, 0)),
                "_needed": F.max("_changed").over(cut.window.rowsBetween(-reach, reach)),
            }
        )
        around = landed(cut.owned(flagged).where("_needed").select(*FOLDED.names, "_affected"), "around", number)

        # 5. their signals now; bars that are no longer there have none
        affected = around.where("_affected").select(*BAR_OF, "bar_index", "open_time")
        had_bars = before.join(affected.select(*BAR_OF, "bar_index"), [*BAR_OF, "bar_index"], "left_semi")
        had_bars = landed(as_bars(had_bars, sizes), "had", number)
        now_bars = as_bars(affected.where(F.col("bar_index") >= shortest + 2), sizes)
        emptied = landed(had_bars.join(now_bars, list(SIGNAL_BAR), "left_anti"), "emptied", number)
        nothing = {c: F.lit(None).cast(BAR_SIGNALS[c].dataType) for c in ("volume", "vol3_avg", "signals")}
        now = as_signals(evaluated(around), sizes, BAR_SIGNALS.names)
        signals.append(now.unionByName(emptied.withColumns(nothing)), number)

        # 6. what that takes back and what it adds
        now = signals.batches(spark, F.col("batch") == number).select(*BAR_SIGNALS.names)
        earliest = had_bars.agg(F.to_date(F.timestamp_millis(F.min("open_time")))).first()[0]
        if earliest is None:
            changes = signal_rows(now).withColumn("withdrawn", F.lit(False))
        else:
            changes = changed_signals(signals.read(spark, F.col("day") >= F.lit(earliest), before=number), now)
        write_batch(changes.select(*STATED.names), f"{path}/changes", number, SIGNAL_CODEC)

    def handle_and_clean(batch: DataFrame, number: int) -> None:
        with shuffles_dropped(spark):  # every step is written once, and read from there
            handle(batch, number)

    return run_batches(minute_bars, handle_and_clean, f"{path}/checkpoint", available_now=available_now)


def changed_signals(had: DataFrame, now: DataFrame) -> DataFrame:
    """Signals of the bars in ``now`` that it lacks (``withdrawn``) and those it has anew or with other values.

    Both hold a bar once, with all its signals, so that only bars are joined.
    """
    earlier = had.select(*SIGNAL_BAR, *[F.col(c).alias(f"_{c}") for c in ("volume", "vol3_avg", "signals")])
    both = now.join(earlier, list(SIGNAL_BAR), "left")
    same = F.col("volume").eqNullSafe(F.col("_volume")) & F.col("vol3_avg").eqNullSafe(F.col("_vol3_avg"))
    sets = lambda name: F.coalesce(F.col(name), F.create_map().cast(SIGNAL_SETS))
    ids = lambda held: F.coalesce(held["indicator_ids"], F.array().cast("array<int>"))

    def turned(_: Column, old: Column, new: Column) -> Column:
        added = F.when(same & old["vol_avg"].eqNullSafe(new["vol_avg"]), F.array_except(ids(new), ids(old))).otherwise(ids(new))
        return F.array(
            F.struct(F.lit(True).alias("withdrawn"), old["vol_avg"].alias("vol_avg"), F.array_except(ids(old), ids(new)).alias("_ids")),
            F.struct(F.lit(False).alias("withdrawn"), new["vol_avg"].alias("vol_avg"), added.alias("_ids")),
        )

    values = ("volume", "vol3_avg")
    kept = [*SIGNAL_BAR, *values, *[f"_{c}" for c in values]]
    rows = both.select(*kept, F.explode(F.map_zip_with(sets("_signals"), sets("signals"), turned)).alias("_long", "_turned"))
    rows = rows.select(*kept, F.inline("_turned"))
    rows = rows.select(*kept, "withdrawn", "vol_avg", F.explode("_ids").alias("indicator_id"))
    return rows.withColumns({c: F.when(F.col("withdrawn"), F.col(f"_{c}")).otherwise(F.col(c)) for c in values})


def as_bars(rows: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(symbol, period, open_time) of bars, the period as an index like that of their signals."""
    listed: Column = F.array(*[F.lit(n) for n in sizes])
    return rows.select("symbol", (F.array_position(listed, F.col("size")) - 1).cast("int").alias("period"), "open_time")


def read_stream_signals(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The signals as of the last batch; ``where`` on ``period`` and ``day`` reads only the partitions asked for."""
    return signal_rows(signals_table(path).read(spark, where)).select(*SIGNALS.names)


def compact_stream_signals(spark: SparkSession, path: str, upto: int, minute_chunk: int = MINUTE_CHUNK) -> None:
    """Compact the partitions of all tables that batches up to ``upto`` have touched."""
    for table in (minutes_table(path, minute_chunk), starts_table(path), folded_table(path), signals_table(path)):
        table.compact(spark, upto)
