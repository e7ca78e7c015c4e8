"""Parquet storage of bars, logs and signals, and readers of landed files."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.times import to_epoch_ms
from tickloom.operators.keyed import latest_per_key, upsert
from tickloom.schemas import BAR_KEY, BARS, MINUTE_MS, SIGNALS, check_period
from tickloom.sources.logged import path_exists


def read_landed_text(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON documents, one per file, as ``value``."""
    return spark.read.text(path, wholetext=True)


def stream_landed_text(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed files of one message per line as a stream of ``value`` and ``seq``.

    ``seq`` is the time of the file. Messages of one key in one file tie on it:
    order those by the time they carry (``messages.with_event_time``).
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("value", F.col("_metadata.file_modification_time").alias("seq"))


def stream_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A Kafka topic as ``value``, ``partition`` and ``offset`` (the arrival order of a key).

    Needs the Kafka connector on the class path.
    """
    reader = spark.readStream.format("kafka").options(**options)
    feed = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return feed.select(F.col("value").cast("string").alias("value"), "partition", "offset")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True)


def with_day(bars: DataFrame) -> DataFrame:
    return bars.withColumn("day", F.to_date(F.timestamp_millis("open_time")))


def write_bars(bars: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Bars as Parquet by period and day, range-partitioned so that files are even in size
    whatever the symbol, and so that row-group statistics prune symbol and time."""
    order = ("period", "day", "symbol", "open_time")
    ordered = with_day(bars.select(*BARS.names)).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.mode(mode).partitionBy("period", "day").parquet(path)


def read_bars(
    spark: SparkSession, path: str, start: dt.datetime | str | None = None, end: dt.datetime | str | None = None
) -> DataFrame:
    """Stored bars; with ``start`` or ``end`` only the days between them are read, whole days."""
    rows = _stored(spark, path)
    for bound, keep in ((start, F.col("day").__ge__), (end, F.col("day").__le__)):
        if bound is not None:
            rows = rows.filter(keep(F.to_date(F.timestamp_millis(F.lit(to_epoch_ms(bound))))))
    return rows.select(*BARS.names)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType([*BARS.fields, T.StructField("day", T.DateType())])).parquet(path)


def upsert_stored_bars(
    spark: SparkSession, path: str, incoming: DataFrame, ingest_order: Sequence[str], scratch: str
) -> None:
    """Overwrite stored bars by incoming ones, the last of a key wins; only days with incoming bars are rewritten.

    The new days are written to ``scratch`` first and then put in place of the old ones, so a run that fails before
    that leaves the store as it was, and one that fails during it can be repeated.
    """
    arriving = with_day(incoming)
    touched = arriving.select("period", "day").distinct()
    stored = _stored(spark, path).join(touched, ["period", "day"], "left_semi")  # prunes directories at run time
    merged = upsert(stored.select(*BARS.names), arriving.select(*BARS.names, *ingest_order), BAR_KEY, ingest_order)
    write_bars(merged, scratch)
    new = spark.read.parquet(scratch)
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period", "day").parquet(path)


def scan_bars(
    bars: DataFrame,
    period: str,
    start: dt.datetime | str,
    end: dt.datetime | str,
    symbol: str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Bars opened from ``start`` to ``end``, both included; sorted by time and symbol only if ``ordered``.

    On stored bars the period prunes directories and the bounds reach the scan; give
    ``read_bars`` the same bounds to prune days as well.
    """
    rows = bars.filter(
        (F.col("period") == check_period(period))
        & F.col("open_time").between(to_epoch_ms(start), to_epoch_ms(end))
    )
    if symbol is not None:
        rows = rows.filter(F.col("symbol") == symbol)
    return rows.orderBy("open_time", "symbol") if ordered else rows


def scan_bars_lookback(
    bars: DataFrame, as_of: dt.datetime | str, minutes: int, *, period: str = "1m", symbol: str | None = None
) -> DataFrame:
    """Bars of the last ``minutes`` minutes up to ``as_of``."""
    end = to_epoch_ms(as_of)
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    start = epoch + dt.timedelta(milliseconds=end - minutes * MINUTE_MS)
    return scan_bars(bars, period, start, as_of, symbol)


def append_signals(signals: DataFrame, path: str, run: str | None = None) -> None:
    """Append the indicator signals of one job; a job repeated under the same ``run`` replaces its own rows.

    Each attempt writes a directory of its own, by period, and ``path``_runs names the one that counts once it is
    complete: readers never see half a job, and one that fails can be repeated. Without ``run`` every call is a new one.
    """
    attempt = uuid.uuid4().hex
    run = run or attempt
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
        raise ValueError(f"a run is named by letters, digits, '_', '.' and '-', not {run!r}")
    signals.select(*SIGNALS.names).write.partitionBy("period").parquet(f"{path}/run={run}/attempt={attempt}")
    counts = signals.sparkSession.range(1).select(F.lit(run).alias("run"), F.lit(attempt).alias("attempt"))
    counts.write.mode("overwrite").parquet(f"{path}_runs/job={run}")


def read_signals(spark: SparkSession, path: str) -> DataFrame:
    """The signals of the last complete attempt of every run."""
    if not path_exists(spark, f"{path}_runs"):
        return spark.createDataFrame([], SIGNALS)
    counts = spark.read.schema("run string, attempt string").parquet(f"{path}_runs")
    layout = T.StructType([*SIGNALS.fields, T.StructField("run", T.StringType()), T.StructField("attempt", T.StringType())])
    return spark.read.schema(layout).parquet(path).join(counts, ["run", "attempt"], "left_semi").select(*SIGNALS.names)


def write_batch(rows: DataFrame, path: str, batch: int, codec: str | None = None) -> None:
    """Write one micro-batch to its own directory; a replay of the batch replaces it."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}", compression=codec)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches of a log, with their number as ``batch``."""
    logged = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(logged).parquet(path)


def latest_from_log(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = BAR_KEY
) -> DataFrame:
    """The keyed table a log stands for: per key the row of the latest batch.

    Each batch holds a key once, so the batch number alone orders a key's rows.
    """
    return latest_per_key(read_log(spark, path, schema), keys, ["batch"], keep_order=False)


def compact_log(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], target: str
) -> None:
    """Write the latest rows of a log as batch 0 of a new log; the old one is kept."""
    write_batch(latest_from_log(spark, path, schema, keys), target, 0)
