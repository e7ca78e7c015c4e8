"""Language ID: script ranges narrow the candidates, Viterbi with a switching penalty labels spans."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import byte_slices, held_bytes, remainder, sampled

BITS = 16
MAX_TRAIN_ROWS = 16_000
PENALTY = 6.0
SCRIPT_SHARE = 0.02
CACHE_BYTES = 64 << 20
SLICE = 4 << 20
# First code points of script blocks, and the script that starts there.
SCRIPTS = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "devanagari"),
    (0x0980, "indic"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "latin"),
    (0xFB07, "other"),
    (0xFF21, "latin"),
    (0xFF5B, "other"),
    (0x20000, "han"),
    (0x32000, "other"),
)
NAMES = tuple(dict.fromkeys(name for _, name in SCRIPTS))
_STARTS = [start for start, _ in SCRIPTS]
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_LETTERS = re.compile(r"[^\W\d_]+")


def script_of(letter: str) -> int:
    return NAMES.index(SCRIPTS[bisect.bisect_right(_STARTS, ord(letter)) - 1][1])


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words, all at once: (features, number of the word each belongs to).

    A word has itself and its character 2- to 4-grams with marked ends.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    starts = np.cumsum(sizes) - sizes
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max(initial=1)), _FACTOR, np.uint64))
        whole = np.add.reduceat(codes * powers[np.arange(len(codes)) - starts[owner]], starts) if words else codes
        hashes, owners = [whole], [np.arange(len(words))]
        for n in (2, 3, 4):
            inside = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
            total = np.full(len(inside), n, np.uint64)
            for k in range(n):
                total = (total + codes[inside + k]) * _FACTOR
            hashes.append(total)
            owners.append(owner[inside])
        joined = np.concatenate(hashes)
        joined = (joined ^ (joined >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (joined >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


def letters(chunk: str) -> str:
    return "".join(x for x in _LETTERS.findall(chunk.lower()) if x.isalpha())


@dataclass(frozen=True)
class Model:
    """Languages in order, log-probabilities (feature, language), and the scripts (script, language) each one uses."""

    langs: tuple[str, ...]
    logp: np.ndarray
    scripts: np.ndarray


def train_language(docs: DataFrame, max_rows: int = MAX_TRAIN_ROWS, held_out: tuple[int, int] = (5, 0)) -> Model:
    """Count features per language over labelled documents outside the held-out fold.

    ``max_rows`` bounds the documents used: of more, those whose ids hash lowest, whole texts. What reaches the driver
    is one count per language and feature (2**BITS of them). NULL ids, texts and languages are left out. With nothing
    to learn from, the model has no language.
    """
    modulus, fold = held_out
    known = docs.select("text", "lang", "doc_id").where(F.col("lang").isNotNull() & (remainder("doc_id", modulus) != fold))
    rows = sampled(known, max_rows, "doc_id").where(F.col("text").isNotNull())

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in byte_slices(batches):
            words: dict[str, dict[str, int]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = words.setdefault(lang, {})
                for chunk in text.split():
                    own[chunk] = own.get(chunk, 0) + 1
            for lang, own in words.items():
                table = total.setdefault(lang, np.zeros((1 << BITS) + len(NAMES), np.int64))
                named = [(word, times) for chunk, times in own.items() if (word := letters(chunk))]
                found, owner = grams([word for word, _ in named])
                weights = np.array([times for _, times in named], np.int64)
                table[: 1 << BITS] += np.bincount(found, weights[owner], 1 << BITS).astype(np.int64)
                scripts = [script_of(word[0]) for word, _ in named]
                table[1 << BITS :] += np.bincount(scripts, weights, len(NAMES)).astype(np.int64)
        for lang, table in total.items():
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(table[at])], ["lang", "feature", "n"]
            )

    counted = (
        rows.mapInArrow(count, "lang string, feature int, n bigint").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    ).toArrow()
    langs = tuple(sorted(set(counted["lang"].to_pylist())))
    table = np.zeros(((1 << BITS) + len(NAMES), len(langs)))
    if langs:
        columns = np.searchsorted(np.array(langs, dtype=object), np.array(counted["lang"].to_pylist(), dtype=object))
        table[counted["feature"].to_numpy(), columns] = counted["n"].to_numpy()
    features, scripts = table[: 1 << BITS], table[1 << BITS :]
    logp = np.log((features + 0.5) / (features.sum(axis=0, keepdims=True) + 0.5 * (1 << BITS)))
    share = scripts / np.maximum(scripts.sum(axis=0, keepdims=True), 1)
    return Model(langs, logp.astype(np.float32), share >= SCRIPT_SHARE)


class Scorer:
    """Rows of per-language scores by chunk of a text; cached chunks share one growing table, emptied at CACHE_BYTES."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.table = np.zeros((0, len(self.model.langs)), np.float32)
        self.weight = np.zeros(0, np.int32)
        self.seen = np.zeros(0, np.int32)

    def learn(self, chunks: list[str]) -> None:
        """Score new chunks: log-probabilities relative to the best candidate of the script, -30 at least."""
        words = [letters(c) for c in chunks]
        lettered = np.array([i for i, w in enumerate(words) if w], np.int64)
        own = [words[i] for i in lettered]
        found, owner = grams(own)
        logp = self.model.logp
        score = np.stack([np.bincount(owner, logp[found, k], len(own)) for k in range(len(self.model.langs))], axis=1)
        allowed = self.model.scripts[[script_of(w[0]) for w in own]].reshape(score.shape)
        known = allowed.any(axis=1)  # else no learned language writes in this script: no evidence
        best = np.where(allowed, score, -np.inf).max(axis=1, initial=-np.inf)
        relative = np.maximum(np.where(allowed, score - np.where(known, best, 0)[:, None], -30.0), -30.0)
        table = np.zeros((len(chunks), score.shape[1]), np.float32)
        weight, seen = np.zeros(len(chunks), np.int32), np.zeros(len(chunks), np.int32)
        table[lettered] = np.where(known[:, None], relative, 0)
        weight[lettered] = [len(w) for w in own]
        seen[lettered] = np.where(known, weight[lettered], 0)
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks)), strict=True))
        self.table = np.concatenate([self.table, table])
        self.weight = np.concatenate([self.weight, weight])
        self.seen = np.concatenate([self.seen, seen])

    def predict(self, texts: list[str | None], penalty: float, with_spans: bool = True):
        """Language, share of letters and spans of each text."""
        langs = self.model.langs
        if self.held > CACHE_BYTES:
            self.reset()
        cut = [t.split() if t and langs else [] for t in texts]
        if new := set().union(*cut) - self.known.keys():
            self.learn(sorted(new))
            self.held += held_bytes(new)
        known = self.known.__getitem__
        rows = [np.fromiter(map(known, chunks), np.int32, len(chunks)) for chunks in cut]
        ends = np.cumsum([len(r) for r in rows], dtype=np.int64)
        sizes = np.diff(ends, prepend=0)
        every = np.concatenate([*rows, np.zeros(0, np.int32)])
        labels = viterbi(self.table[every], sizes, penalty) if langs else np.zeros(0, np.int16)
        weights, read = self.weight[every], self.seen[every]
        names, shares, spans = [], [], []
        for text, size, end in zip(texts, sizes, ends, strict=True):
            own = labels[end - size : end]
            total = int(weights[end - size : end].sum())
            by = np.bincount(own, weights=read[end - size : end], minlength=max(1, len(langs)))
            names.append(langs[int(by.argmax())] if total else "und")
            shares.append(float(by.max() / total) if total else 0.0)
            spans.append(spans_of(text, own, langs) if total and with_spans else [])
        return names, shares, spans


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each row of ``scores``; the rows are sequences of ``sizes`` rows, one after the other.

    All sequences step together, longest first, so that the running ones are always a prefix.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    ordered = sizes[order]
    labels = np.zeros(len(scores), np.int16)
    if not len(scores):
        return labels
    back = np.zeros(scores.shape, np.int16)
    steps = int(ordered[0])
    running = np.searchsorted(-ordered, -np.arange(1, steps + 1), side="right")  # sequences longer than t
    value = scores[starts[: running[0]]].astype(np.float32)
    final = np.zeros(running[0], np.int16)
    own = np.arange(scores.shape[1], dtype=np.int16)[None, :]
    for t in range(1, steps + 1):
        k = int(running[t]) if t < steps else 0
        if k < len(value):
            final[k : len(value)] = value[k:].argmax(axis=1)
            value = value[:k]
        if not k:
            break
        best = value.argmax(axis=1)
        switched = value[np.arange(k), best] - penalty
        stay = value >= switched[:, None]
        at = starts[:k] + t
        back[at] = np.where(stay, own, best[:, None].astype(np.int16))
        value = np.where(stay, value, switched[:, None]) + scores[at]
    state = final.copy()
    for t in range(steps - 1, -1, -1):
        k = int(running[t])
        at = starts[:k] + t
        labels[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return labels


def spans_of(text: str, labels: np.ndarray, langs: tuple[str, ...]) -> list[dict]:
    """Runs of equal labels as code-point spans."""
    if not len(labels):
        return []
    edges = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1]])
    if len(edges) == 1:
        return [{"start": 0, "end": len(text), "lang": langs[labels[0]]}]
    wanted, starts = set(edges.tolist()), []
    for i, found in enumerate(re.finditer(r"\S+", text)):
        if i in wanted:
            starts.append(found.start())
    starts[0] = 0
    return [
        {"start": s, "end": e, "lang": langs[labels[i]]}
        for i, s, e in zip(edges, starts, [*starts[1:], len(text)], strict=True)
    ]


def languages(
    docs: DataFrame, model: Model, penalty: float = PENALTY, held_out: tuple[int, int] = (5, 0)
) -> DataFrame:
    """Language of every whole text and its spans.

    Columns: ``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``spans`` (start, end in code points, lang). The
    prediction is the language that labels most letters, the score its share of them, times the share of letters in a
    script that some learned language uses. ``und`` with score 0 for a NULL text, a text without a letter, or a
    model without languages. Letters of unknown scripts alone give the first language with score 0. Ties go to the
    first language by name. One row per input row; a NULL id is not held out; only id and text are read.
    """
    modulus, fold = held_out
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x 2**BITS numbers
    id_type = docs.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def predict(batches):
        scorer = Scorer(shared.value)
        for batch in byte_slices(batches, column=1, limit=SLICE):
            names, shares, spans = scorer.predict(batch.column(1).to_pylist(), penalty)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array(spans, span_type)],
                ["doc_id", "lang_pred", "score", "spans"],
            )

    found = docs.select("doc_id", "text").mapInArrow(
        predict,
        f"doc_id {id_type}, lang_pred string, score double, spans array<struct<start: bigint, end: bigint, lang: string>>",
    )
    return found.withColumn("held_out", F.coalesce(remainder("doc_id", modulus) == fold, F.lit(False)))


def accepted(docs: DataFrame, model: Model, least_share: float, penalty: float = PENALTY) -> DataFrame:
    """The documents whose best language labels at least ``least_share`` of the letters, all columns as they were.

    Documents without a letter (``und``) go. A model without languages accepts nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def accept(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for array in arrays:
            found: list[bool] = []
            for batch in byte_slices([pa.RecordBatch.from_arrays([array], ["text"])], limit=SLICE):
                names, shares, _ = scorer.predict(batch.column(0).to_pylist(), penalty, with_spans=False)
                found += [n != "und" and s >= least_share for n, s in zip(names, shares, strict=True)]
            yield pa.array(found, pa.bool_())

    accept.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.where(F.arrow_udf(accept, "boolean")(F.col("text")))
