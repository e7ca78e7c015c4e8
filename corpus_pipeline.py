"""From documents to token ids: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import bpe, decontaminate, language, near_dups, pii
from tickloom.llm.common import read_table
from tickloom.llm.queries import tokenizer
from tickloom.session import prepare, scratch_dir

#: Share of letters that the best language must label; with the four languages at hand an even mix has 0.25.
LEAST_SHARE = 0.3
#: SQL cannot state the learned stages; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter or without a leading language go."""
    model = language.train_language(docs)
    return language.accepted(docs, model, LEAST_SHARE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dups.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark passage contaminates."""
    return decontaminate.without_documents(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redacted_documents(docs, pii.train_pii(docs))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, packed, and digests of the round trip."""
    return bpe.bpe_round_trip(docs, tokenizer("word_bpe_49k.json"), pack_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written and read again."""
    docs = read_table(prepare(spark), sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return last(spark, docs, sf_dir)
