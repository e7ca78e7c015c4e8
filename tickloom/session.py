"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the run-time settings that decide results: UTC time and ANSI errors."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # A union of parts shuffled alike keeps their partitions apart, not one of each part in one task.
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    # Plans show their filters whole; by default they are cut at 100 characters, which depends on the ids of columns.
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a query go when the query has ended, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP_KEY, "false")
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_KEY, before)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path for tables written between stages.

    On a cluster it lies in the shared folder named by ``spark.checkpoint.dir``,
    so that it outlives any executor. Only a local master, where driver and
    executors share one disk, falls back to a temporary folder.
    """
    base = spark.conf.get(CHECKPOINT_DIR_KEY, None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
            raise RuntimeError(f"set {CHECKPOINT_DIR_KEY} to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tickloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
