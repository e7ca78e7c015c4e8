"""Keyed tables kept as a log of batches and compacted partitions, read by partition.

A table lies in three folders: ``path`` has one directory per batch, ``path``_base one per compaction, which holds
whole partitions, and ``path``_marks says which compaction has the newest version of a partition. All are laid out by
the same partition columns, so a filter on these prunes directories in each of them: a read costs what it asks for,
whatever the history.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.keyed import latest_per_key

LONG = T.LongType()


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


@dataclass(frozen=True)
class LoggedTable:
    """``parts`` are the partition columns, each an expression of the row's other columns that does not change for a key.
    Neither they nor the keys are NULL.

    Rows of a key are reduced to one by ``combine`` (given the rows with their ``batch``); by default the newest
    batch's row wins. Combining must not depend on how often or in which groups rows are combined. A batch holds a key
    at most once, or ``combine`` reduces such rows as well.

    ``live`` is a condition on a row's columns: rows for which it does not hold say that their key is gone. Reads leave
    them out, and a compaction does so for good. Within a file rows are in the order of ``order``, by default of the keys.
    ``codec`` is the compression of the files, by default that of the session.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    parts: dict[str, Column]
    combine: Callable[[DataFrame], DataFrame] | None = None
    live: Column | None = None
    order: tuple[str, ...] = ()
    codec: str | None = None

    def _layout(self, spark: SparkSession) -> T.StructType:
        probe = spark.createDataFrame([], self.schema).select(*[c.alias(n) for n, c in self.parts.items()])
        return T.StructType([*self.schema.fields, *[f for f in probe.schema.fields if f.name not in self.schema.names]])

    def _folder(self, spark: SparkSession, suffix: str, version: str) -> DataFrame | None:
        path = f"{self.path}{suffix}"
        if not path_exists(spark, path):
            return None
        layout = self._layout(spark)
        if suffix == "_marks":
            layout = T.StructType([f for f in layout.fields if f.name in self.parts])
        return spark.read.schema(T.StructType([*layout.fields, T.StructField(version, LONG)])).parquet(path)

    def append(self, rows: DataFrame, batch: int) -> None:
        """Write one batch to its own directory; a replay of the batch replaces it."""
        placed = rows.select(*self.schema.names).withColumns(self.parts)
        if self.order:
            placed = self._ordered(placed)
        placed.write.mode("overwrite").partitionBy(*self.parts).parquet(f"{self.path}/batch={batch}", compression=self.codec)

    def batches(self, spark: SparkSession, where: Column) -> DataFrame | None:
        """The rows as they came, with their ``batch``; ``where`` on ``batch`` and partition columns prunes directories."""
        rows = self._folder(spark, "", "batch")
        return None if rows is None else rows.where(where)

    def compacted_to(self, spark: SparkSession) -> int:
        """Number of the newest batch that is part of the compacted partitions; -1 if none is."""
        marks = self._folder(spark, "_marks", "upto")
        newest = marks.agg(F.max("upto")).first()[0] if marks is not None else None
        return -1 if newest is None else newest

    def _ordered(self, placed: DataFrame) -> DataFrame:
        order = [*self.parts, *[k for k in self.order or self.keys if k not in self.parts]]
        return placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def read(self, spark: SparkSession, where: Column | None = None, before: int | None = None) -> DataFrame:
        """One row per key; ``where`` is a condition on partition columns, ``before`` leaves out batches from there on.

        Rows of compacted partitions are unique already: only those of later batches are combined among themselves,
        and keys that these bring anew replace or meet the compacted row.
        """
        rows = self._read(spark, where, before)
        return rows if self.live is None else rows.where(self.live)

    def _read(self, spark: SparkSession, where: Column | None, before: int | None) -> DataFrame:
        upto = self.compacted_to(spark)
        if before is not None and upto >= before:
            raise ValueError(f"batches up to {upto} are compacted; the table as of batch {before} is gone")
        tail = self._folder(spark, "", "batch")
        wanted = F.lit(True) if where is None else where
        if tail is not None:
            tail = tail.where(wanted & (F.col("batch") > upto))
            if before is not None:
                tail = tail.where(F.col("batch") < before)
        base = self._base(spark, wanted)
        names = self.schema.names
        if tail is None:
            return (base if base is not None else spark.createDataFrame([], self._layout(spark))).select(*names)
        fresh = self._combined(tail.select(*names, "batch"))
        if base is None:
            return fresh
        base = base.select(*names)
        if self.combine is None:
            return base.join(fresh.select(*self.keys), list(self.keys), "left_anti").unionByName(fresh)
        met = base.join(fresh.select(*self.keys), list(self.keys), "left_semi")
        apart = base.join(fresh.select(*self.keys), list(self.keys), "left_anti")
        both = met.unionByName(fresh).withColumn("batch", F.lit(0).cast(LONG))
        return apart.unionByName(self._combined(both))

    def _combined(self, rows: DataFrame) -> DataFrame:
        if self.combine is not None:
            return self.combine(rows).select(*self.schema.names)
        return latest_per_key(rows, self.keys, ["batch"], keep_order=False).select(*self.schema.names)

    def _base(self, spark: SparkSession, wanted: Column) -> DataFrame | None:
        marks = self._folder(spark, "_marks", "upto")
        base = self._folder(spark, "_base", "upto") if marks is not None else None
        if base is None:
            return None
        newest = marks.where(wanted).groupBy(*self.parts).agg(F.max("upto").alias("upto"))
        return base.where(wanted).join(newest, [*self.parts, "upto"], "left_semi")

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Write the partitions that batches up to ``upto`` touch since the last compaction anew, and no others.

        The new versions count from the moment their marks are written; a compaction that fails before can be repeated.
        """
        tail, last = self._folder(spark, "", "batch"), self.compacted_to(spark)
        if tail is None or upto <= last:
            return
        touched = tail.where((F.col("batch") > last) & (F.col("batch") <= upto)).select(*self.parts).distinct()
        found = self.read(spark, before=upto + 1).withColumns(self.parts).join(touched, list(self.parts), "left_semi")
        placed = self._ordered(found)
        placed.write.mode("overwrite").partitionBy(*self.parts).parquet(f"{self.path}_base/upto={upto}", compression=self.codec)
        touched.write.mode("overwrite").parquet(f"{self.path}_marks/upto={upto}")


def logged(
    path: str, schema: T.StructType, keys: Sequence[str], combine: Callable[[DataFrame], DataFrame] | None = None, **parts: Column
) -> LoggedTable:
    return LoggedTable(path, schema, tuple(keys), parts, combine)
