"""The state of a logged table at any moment: daily snapshots, and the rows that came after them.

The table holds every change of a state key with its time, laid out by ``day`` of that time. A snapshot of a day holds the
newest change of each key before that day, as far as batches up to a number know. The state at a moment is the newest
snapshot before it, met by the changes from its day on, and by older changes that later batches brought: a read costs the
state, one day's changes per day since the snapshot, and what came late, whatever the history.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.times import as_utc
from tickloom.sources.logged import LoggedTable, path_exists

BATCHES = 10**10


@dataclass(frozen=True)
class Snapshots:
    """Snapshots of ``table``, whose keys are ``keys`` and ``time``, and whose parts are ``day`` of that time.

    ``keys`` say which changes replace each other: of them the newest by ``time`` counts, and of those at one time the
    newest batch's. They lie in ``path``_state, one directory for each day and newest batch; ``path``_state_marks lists
    the complete ones, so a snapshot that fails half way is never read and can be taken again.
    """

    table: LoggedTable
    keys: tuple[str, ...]
    time: str

    @property
    def _schema(self) -> T.StructType:
        return T.StructType([*self.table.schema.fields, T.StructField("batch", T.LongType())])

    def _newest(self, rows: DataFrame) -> DataFrame:
        """One row per key: time and batch are packed into one number, so that Spark aggregates by hashing."""
        at = F.unix_micros(self.time).cast("decimal(20,0)") * F.lit(BATCHES).cast("decimal(11,0)")
        order = (at + F.col("batch").cast("decimal(11,0)")).cast("decimal(38,0)")
        values = [n for n in self._schema.names if n not in self.keys]
        found = rows.withColumn("_order", order).groupBy(*self.keys)
        return found.agg(*[F.max_by(n, "_order").alias(n) for n in values]).select(*self._schema.names)

    def taken(self, spark: SparkSession) -> list[tuple[dt.date, int]]:
        """(day, newest batch) of all complete snapshots, in order: one row for each snapshot."""
        path = f"{self.table.path}_state_marks"
        if not path_exists(spark, path):
            return []
        return sorted((r.day, r.upto) for r in spark.read.schema("day date, upto bigint").parquet(path).collect())

    def _start(self, spark: SparkSession, day: dt.date, upto: int | None) -> tuple[dt.date, int] | None:
        fit = [s for s in self.taken(spark) if s[0] <= day and (upto is None or s[1] <= upto)]
        return fit[-1] if fit else None

    def _changes(self, spark: SparkSession, until: Column, day: dt.date, upto: int | None) -> DataFrame:
        """The newest changes with a time that meets ``until``, all of them on ``day`` or before."""
        start = self._start(spark, day, upto)
        days = F.col("day") <= F.lit(day)
        before = None if upto is None else upto + 1
        if start is None:
            rows = self.table.read(spark, days, before=before).withColumn("batch", F.lit(0).cast("bigint"))
            return self._newest(rows.where(until))
        at, known = start
        held = spark.read.schema(self._schema).parquet(f"{self.table.path}_state/day={at}/upto={known}")
        later = self.table.read(spark, days & (F.col("day") >= F.lit(at)), before=before)
        parts = held.unionByName(later.where(until).withColumn("batch", F.lit(0).cast("bigint")))
        late = self.table.batches(spark, (F.col("batch") > known) & (F.col("day") < F.lit(at)))
        if late is not None:
            late = late.where(until) if before is None else late.where(until & (F.col("batch") < before))
            parts = parts.unionByName(late.select(*self._schema.names))
        return self._newest(parts)

    def take(self, spark: SparkSession, day: dt.date, upto: int) -> None:
        """Write the state at the start of ``day`` as batches up to ``upto`` tell it, from the snapshot before it.

        A snapshot of the same day with a newer batch takes the place of an older one in reads.
        """
        eve = day - dt.timedelta(days=1)
        found = self._changes(spark, F.lit(True), eve, upto)
        where = f"day={day}/upto={upto}"
        found.write.mode("overwrite").parquet(f"{self.table.path}_state/{where}")
        mark = spark.range(1).select(F.lit(day).alias("day"), F.lit(upto).cast("bigint").alias("upto"))
        mark.write.mode("overwrite").parquet(f"{self.table.path}_state_marks/snapshot={day}-{upto}")

    def at(self, spark: SparkSession, moment: dt.datetime | str) -> DataFrame:
        """The newest change of each key at ``moment``, that moment's own changes included."""
        moment = as_utc(moment).astimezone(dt.timezone.utc)
        until = F.col(self.time) <= F.lit(moment)
        return self._changes(spark, until, moment.date(), None).select(*self.table.schema.names)
