"""What the operators share: cutting Arrow batches by bytes, row samples, written tables."""

from __future__ import annotations

import sys
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import scratch_dir

SLICE_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read back: a cut in the lineage that outlives executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_slices(batches, column: int = 0, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows whose texts together hold about ``limit`` bytes; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


def held_bytes(texts: Collection[str]) -> int:
    """What texts take at most as keys of a cache; those beyond ASCII keep their UTF-8 form once it was asked for."""
    wide = [t for t in texts if not t.isascii()]
    chars = len("".join(wide))
    narrow = sys.getsizeof("") * (len(texts) - len(wide)) + len("".join(texts)) - chars  # one byte a character
    return narrow + sum(map(sys.getsizeof, wide)) + 140 * len(texts) + 4 * chars


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def sampled(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """About ``rows`` rows at most, the same ones in every run: those whose key hashes lowest. All if there are fewer."""
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < int((1 << 30) * rows / total))


def packed(docs: DataFrame) -> DataFrame:
    """Whole rows as ``_row``, beside their id and text hash: joins with decisions meet no other column's name."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("doc_id").alias("_id"),
        F.xxhash64("text").alias("_hash"),
    )
