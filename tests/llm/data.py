"""Small documents with every odd case: NULLs, empty and very long texts, repeats, clashing column names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = "time year people way day man thing woman life child world school state family student group country".split()
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    long = prose(1, 6000)
    base = prose(2, 200)
    near = base.rsplit(" ", 3)[0] + " x y z"
    rows = [
        (1, base),
        (2, near),
        (3, base),
        (3, base),  # a row twice
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "short text"),
        (8, "Short TEXT"),
        (9, long),
        (10, "Ab1 " * 3000),
        (11, "x" * 20_000),
        (12, PASSAGE + " and more"),
        (13, "Say: " + PASSAGE.upper().replace(" ", "; ") + "."),
        (14, "mail jo.doe+x@mail.example.org or +1 (614) 555-8001, card 4111 1111 1111 1111, ip 10.0.0.255."),
        (15, "Licensed under the Apache License, Version 2.0. Released under the MIT License."),
        (16, "naïve ΣΑΣ İstanbul 中文 <|endoftext|> tail 's don't é"),
        (17, 'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b" end'),
        (None, "no id here"),
        (None, base),
        (18, prose(3, 40)),
        (18, prose(4, 40)),  # an id with two texts
    ]
    return rows + [(100 + i, prose(100 + i, 30 + i)) for i in range(30)]


def documents(spark: SparkSession, rows=None) -> DataFrame:
    """The rows with the other columns of documents, and columns named as operators name their own."""
    df = spark.createDataFrame(texts() if rows is None else rows, "doc_id bigint, text string")
    return df.select(
        "doc_id",
        "text",
        F.when(F.col("doc_id") % 3 == 0, None).otherwise(F.lit("en")).alias("lang"),
        F.lit("src0").alias("source"),
        F.length("text").cast("bigint").alias("n_chars"),
        *[F.lit("clash").alias(c) for c in ("score", "w", "vertex", "text_hash", "n_words", "label", "_hash", "_id", "h", "at")],
    )


def benchmark(spark: SparkSession, rows=None) -> DataFrame:
    rows = [(1, PASSAGE), (2, None), (3, ""), (4, "tail 's don"), (4, "tail 's don"), (None, PASSAGE)] if rows is None else rows
    return spark.createDataFrame(rows, "item_id bigint, text string")
