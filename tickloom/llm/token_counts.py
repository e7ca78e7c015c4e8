"""Token counts: Arrow functions that return lengths only."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import byte_slices, held_bytes

PIECE_BYTES = 1 << 19
CACHE_BYTES = 80 << 20

# A single space between two visible characters always starts a pre-token of a byte-level tokenizer, and no
# special string holds a space, so a text can be cut before it.
_EDGE = re.compile(r"\s[^\S ]|[^\S ]\s|  |^\s|\s$")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def pieces(text: str) -> list[str]:
    """The text cut at every safe boundary; joined they are the text."""
    if _EDGE.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[f" {x}" for x in rest]]


class Lengths:
    """Token counts of pieces, encoded in batches of about equal bytes; each distinct piece once while it is cached.

    The cache is emptied before it takes more than CACHE_BYTES and the pieces of one slice of texts.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}
        self.held = 0

    def learn(self, new) -> None:
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.held = 0
            return
        self.held += held_bytes(new)
        batch, held = [], 0
        for piece in new:
            batch.append(piece)
            held += len(piece)
            if held >= PIECE_BYTES:
                self.encode(batch)
                batch, held = [], 0
        self.encode(batch)

    def encode(self, batch: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
        self.known.update(zip(batch, map(len, found), strict=True))

    def count(self, texts: list[str | None]) -> list[int]:
        cut = [pieces(t) if t else [] for t in texts]
        wanted = set().union(*cut)
        if missing := wanted - self.known.keys():
            self.learn(missing)
            if missing := wanted - self.known.keys():  # the cache was emptied
                self.learn(missing)
        known = self.known.__getitem__
        return [sum(map(known, x)) for x in cut]


def token_counts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512
) -> DataFrame:
    """Tokens of every text, as the tokenizer file's own library counts them, without added tokens.

    Columns: the id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens). One row per input
    row, repeated rows included. A NULL text counts as empty: 0 bytes, 0 tokens. A text of any length is counted
    whole; one without a safe boundary is encoded in one piece. Other columns of the input are not read.
    """

    def count(arrays):
        lengths = Lengths(tokenizer)
        for array in arrays:
            batch = pa.RecordBatch.from_arrays([array], ["text"])
            found = [pa.array(lengths.count(x.column(0).to_pylist()), pa.int64()) for x in byte_slices([batch])]
            yield pa.concat_arrays(found) if found else pa.array([], pa.int64())

    count.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = rows.select(
        F.col(id_col), F.octet_length("text").cast("bigint").alias("n_bytes"), F.arrow_udf(count, "bigint")("text").alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
