"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import byte_slices, remainder, sampled

BITS = 18
MAX_TRAIN_ROWS = 24_000
SHARD_ROWS = 4_000
EPOCHS = 5
CACHE_BYTES = 96 << 20
CACHED_CHUNK = 100
SAME = np.uint64(1)
_TOKEN = re.compile(r"\w+|[^\w\s]+")


@dataclass(frozen=True)
class Model:
    """Weights by hashed feature (float32) and the bias."""

    weights: np.ndarray
    bias: float


class Features:
    """Texts to sparse vectors: counts of hashed word 1- and 2-grams, scaled to length 1."""

    def __init__(self) -> None:
        self.chunks: dict[str, tuple[int, ...]] = {}
        self.held = 0

    def tokens(self, chunk: str) -> tuple[int, ...]:
        """Token hashes of a word; kept while all that is kept takes about CACHE_BYTES, but not for long words."""
        found = tuple(zlib.crc32(t.encode("utf-8", "replace")) for t in _TOKEN.findall(chunk.lower()))
        if len(chunk) <= CACHED_CHUNK:
            if self.held > CACHE_BYTES:
                self.chunks.clear()
                self.held = 0
            self.chunks[chunk] = found
            self.held += 200 + 4 * len(chunk) + 40 * len(found)
        return found

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        ids: list[int] = []
        seen = self.chunks
        for chunk in (text or "").split():
            found = seen.get(chunk)
            ids.extend(self.tokens(chunk) if found is None else found)
        one = np.array(ids, dtype=np.uint64)
        with np.errstate(over="ignore"):
            two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
            two[one[:-1] == one[1:]] = SAME  # whichever word is said twice
            grams = np.concatenate([one + np.uint64(0x51ED270B), two]) * np.uint64(0xD6E8FEB86659FD93)
        index, counts = np.unique(grams >> np.uint64(64 - BITS), return_counts=True)
        values = np.sqrt(counts)  # damped, so that one repeated line does not hide the rest
        return index.astype(np.int64), values / max(1e-9, float(np.sqrt((values**2).sum())))


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def ftrl(rows, epochs: int, alpha: float = 2.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-3) -> Model:
    """FTRL-proximal over (index, values, label) rows; the bias is not regularised."""
    z, n, bias_z, bias_n = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0

    def weights(i):
        shrunk = np.sign(z[i]) * l1 - z[i]
        return np.where(np.abs(z[i]) <= l1, 0.0, shrunk / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for index, values, label in rows:
            w, bias = weights(index), -bias_z * alpha / (beta + bias_n**0.5)
            error = sigmoid(float(w @ values) + bias) - label
            g = error * values
            z[index] += g - (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / alpha * w
            n[index] += g * g
            bias_z += error - ((bias_n + error**2) ** 0.5 - bias_n**0.5) / alpha * bias
            bias_n += error**2
    return Model(weights(np.arange(1 << BITS)).astype(np.float32), -bias_z * alpha / (beta + bias_n**0.5))


def train_quality(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, held_out: tuple[int, int] = (4, 2)
) -> Model:
    """Fit on labelled documents outside the held-out fold (crc32 of the id mod ``held_out[0]`` equal to the other).

    ``max_rows`` bounds the labelled rows used: of more, those whose ids hash lowest. The rows are dealt to shards of
    about SHARD_ROWS, each fits a model, and the models are averaged by their rows: what reaches the driver is one weight
    vector per shard. Labels that repeat count once; ids with contradictory labels, NULL ids and NULL labels are left out. Without
    labelled rows all weights are 0, so every score is 0.5.
    """
    modulus, fold = held_out
    known = (
        labels.where(F.col("quality").isin(0, 1) & (remainder("doc_id", modulus) != fold))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("_most"))
        .where(F.col("label") == F.col("_most"))
        .select("doc_id", "label")
    )
    known = sampled(known, max_rows, "doc_id")
    shards = max(1, round(known.count() / SHARD_ROWS))
    dealt = (
        docs.select("doc_id", "text")
        .join(F.broadcast(known), "doc_id")  # at most about max_rows rows of two numbers
        .select("text", "label", F.xxhash64("doc_id").alias("at"))
        .withColumn("shard", F.pmod("at", F.lit(shards)).cast("int"))
    )
    fitted = fitted_shards(dealt, shards).collect()
    total = sum(r.rows for r in fitted)
    weights, bias = np.zeros(1 << BITS), 0.0
    for r in sorted(fitted, key=lambda r: r.shard):
        weights += np.frombuffer(r.weights, np.float32) * (r.rows / total)
        bias += r.bias * (r.rows / total)
    return Model(weights.astype(np.float32), bias)


def fitted_shards(dealt: DataFrame, shards: int) -> DataFrame:
    """(shard, rows, weights, bias): one model for each ``shard`` of (text, label, at, shard), each in a task of its own.

    A shard is fitted by itself even where a partition should hold several of them.
    """
    rows = dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "at", F.xxhash64("text"))

    def fit(batches):
        features, kept, current = Features(), [], None

        def model():
            fitted = ftrl(kept, EPOCHS)
            columns = [[current], [len(kept)], [fitted.weights.tobytes()], [fitted.bias]]
            types = [pa.int32(), pa.int64(), pa.binary(), pa.float64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["shard", "rows", "weights", "bias"])

        for batch in byte_slices(batches):
            for text, label, shard in zip(*(batch.column(n).to_pylist() for n in ("text", "label", "shard")), strict=True):
                if shard != current:
                    if kept:
                        yield model()
                    current, kept = shard, []
                index, values = features(text)
                kept.append((index.astype(np.int32), values.astype(np.float32), float(label)))
        if kept:
            yield model()

    return rows.mapInArrow(fit, "shard int, rows bigint, weights binary, bias double")


def quality_scores(docs: DataFrame, model: Model, threshold: float = 0.7, held_out: tuple[int, int] = (4, 2)) -> DataFrame:
    """Score of every whole text: the sparse dot product with the weights, as a probability of label 1.

    Columns: ``doc_id``, ``held_out``, ``score``, ``predicted`` (1 from ``threshold`` on). One row per input row. A
    NULL text scores as an empty one: the bias alone. A NULL id is not held out. Only id and text are read.
    """
    modulus, fold = held_out
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # 2**BITS weights
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def score(batches):
        features, (weights, bias) = Features(), shared.value
        for batch in byte_slices(batches, column=1):
            found = []
            for text in batch.column(1).to_pylist():
                index, values = features(text)
                found.append(sigmoid(float(weights[index] @ values) + bias))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {id_type}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", modulus) == fold, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
