"""Licence scans: an index of rare licence words by position, alignments, mandatory key phrases."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import byte_slices

RARE_WORDS = 4
SLACK = 12
MIN_MATCH = 0.8

# Base phrases, each with its label.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Sentences of public licences: label, mandatory key phrases, text.
TEMPLATES = (
    ("agpl", ("gnu affero general public license",), "gnu affero general public license"),
    ("apache", ("except in compliance with the license",),
     "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    ("artistic", ("artistic license 2 0",), "artistic license 2 0"),
    ("boost", ("boost software license",), "boost software license version 1 0"),
    ("bsd", ("redistribution and use in source and binary forms",),
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met"),
    ("cc-by", ("creative commons attribution",), "creative commons attribution"),
    ("cc-by-nc", ("cc by nc",), "cc by nc"),
    ("cc-by-nd", ("cc by nd",), "cc by nd"),
    ("cc-by-sa", ("cc by sa",), "cc by sa"),
    ("cc0", ("cc0 1 0 universal",), "cc0 1 0 universal"),
    ("epl", ("eclipse public license",), "eclipse public license"),
    ("gpl", ("this program is free software", "redistribute it and or modify"),
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation"),
    ("isc", ("with or without fee is hereby granted",),
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", ("gnu lesser general public license",), "gnu lesser general public license"),
    ("mit", ("permission is hereby granted free of charge",),
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction"),
    ("mpl", ("mozilla public license",), "subject to the terms of the mozilla public license v 2 0"),
    ("mpl", ("mozilla public license version 2 0",), "mozilla public license version 2 0"),
    ("unlicense", ("free and unencumbered software",),
     "this is free and unencumbered software released into the public domain"),
    ("zlib", ("provided as is without any express or implied warranty",),
     "this software is provided as is without any express or implied warranty in no event will the authors be held "
     "liable for any damages arising from the use of this software"),
)

# Bytes of a word stay (ASCII digits, lower-case letters, all of UTF-8 beyond ASCII), upper case falls, the rest parts.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def _split(text: str) -> tuple[bytes, ...]:
    return tuple(text.encode().split())


@dataclass
class Index:
    """Postings of each template's rarest words: word -> (template, position)."""

    idf: dict[bytes, float]
    rare_words: int = RARE_WORDS
    templates: list[tuple[str, tuple[bytes, ...], tuple[tuple[bytes, ...], ...], bool]] = field(default_factory=list)
    postings: dict[bytes, list[tuple[int, int]]] = field(default_factory=lambda: defaultdict(list))
    need: list[float] = field(default_factory=list)

    def __post_init__(self) -> None:
        for phrase, label in BASE:
            self.add(label, _split(phrase), (_split(phrase),), True)
        for label, keys, text in TEMPLATES:
            self.add(label, _split(text), tuple(map(_split, keys)), False)

    def add(self, label, words, keys, base) -> None:
        at = len(self.templates)
        self.templates.append((label, words, keys, base))
        top = self.idf.get
        order = sorted(range(len(words)), key=lambda i: (-top(words[i], 0.0), i))
        chosen = order[:1] if base else order[: self.rare_words]
        for i in chosen:
            self.postings[words[i]].append((at, i))
        self.need.append(math.ceil(len(chosen) / 2))


def vocabulary() -> frozenset[bytes]:
    return frozenset(w for x in (*(p for p, _ in BASE), *(t for _, _, t in TEMPLATES)) for w in _split(x))


def inverse_frequencies(docs: DataFrame) -> dict[bytes, float]:
    """IDF of every licence word over all documents. What reaches the driver is one count per licence word."""
    wanted = vocabulary()

    def count(batches):
        found, total = Counter(), 0
        for batch in byte_slices(batches):
            total += batch.num_rows
            for text in batch.column(0).to_pylist():
                found.update(wanted.intersection(words_of(text)))
        found[b""] = total
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"]
        )

    counted = docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r.word.encode(): r.n for r in counted.collect()}
    total = counts.pop(b"", 0)
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in wanted}


def matched(words: list[bytes], start: int, template: tuple[bytes, ...]) -> float:
    """Share of the template's words found in order from ``start`` on, a few words of drift allowed."""
    at, hits = max(start, 0), 0
    for word in template:
        try:
            at = words.index(word, at, at + 4) + 1
            hits += 1
        except ValueError:
            at += 1
    return hits / len(template)


def stands(words: list[bytes], phrase: tuple[bytes, ...], low: int, high: int) -> int:
    """First place from ``low`` to before ``high`` where the phrase's words stand consecutively, or -1."""
    n, at = len(phrase), max(low, 0)
    while True:
        try:
            at = words.index(phrase[0], at, min(high, len(words) - n + 1))
        except ValueError:
            return -1
        if tuple(words[at : at + n]) == phrase:
            return at
        at += 1


def find(index: Index, words: list[bytes]) -> list[tuple[int, int, float]]:
    """(template, first word, share of its words) of each verified alignment."""
    postings = index.postings
    if postings.keys().isdisjoint(words):
        return []
    votes: Counter[tuple[int, int]] = Counter()
    for i, word in enumerate(words):
        for template, at in postings.get(word, ()):
            votes[template, i - at] += 1
    near: Counter[tuple[int, int]] = Counter()
    found = []
    for (template, start), n in sorted(votes.items()):
        _, body, keys, base = index.templates[template]
        if base:
            if start >= 0 and tuple(words[start : start + len(body)]) == body:
                found.append((template, start, 1.0))
            continue
        # inserted and left-out words move later votes by a few places
        n = sum(votes.get((template, start + d), 0) for d in range(-2, 3))
        if n < index.need[template] or near.get((template, start // SLACK)):
            continue
        share = matched(words, start, body)
        high = start + len(body) + SLACK
        if share >= MIN_MATCH and all(stands(words, k, start - SLACK, high) >= 0 for k in keys):
            near[template, start // SLACK] += 1
            found.append((template, start, share))
    return found


def license_scan(docs: DataFrame) -> DataFrame:
    """Licences named or quoted in every whole text.

    Columns: ``doc_id``, ``n_words``, ``n_base`` (places of base phrases), ``first_word``, ``last_word`` (smallest and
    largest start of a base phrase), ``base_labels``, ``labels`` (base ones and those of aligned templates), ``score``
    (best share of a template's words; 0 without a finding), ``findings`` (label, start, share, base). Word frequencies
    come from all documents. One row per input row. A NULL or empty text has no words: counts 0, labels empty, places
    NULL. Only id and text are read.
    """
    idf = inverse_frequencies(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    finding = pa.list_(
        pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64()), ("base", pa.bool_())])
    )

    def scan(batches):
        index = Index(idf)
        for batch in byte_slices(batches, column=1):
            n_words, findings = [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                n_words.append(len(words))
                findings.append(
                    [
                        {"label": index.templates[t][0], "start": max(s, 0), "share": x, "base": index.templates[t][3]}
                        for t, s, x in find(index, words)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(findings, finding)],
                ["doc_id", "n_words", "findings"],
            )

    rows = docs.select("doc_id", "text").mapInArrow(
        scan,
        f"doc_id {id_type}, n_words bigint, "
        "findings array<struct<label: string, start: bigint, share: double, base: boolean>>",
    )
    base = F.filter("findings", lambda x: x["base"])
    joined = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["label"]))), ",")
    return rows.withColumn("_base", base).select(
        "doc_id",
        "n_words",
        F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("_base", lambda x: x["start"])).alias("first_word"),
        F.array_max(F.transform("_base", lambda x: x["start"])).alias("last_word"),
        joined(F.col("_base")).alias("base_labels"),
        joined(F.col("findings")).alias("labels"),
        F.coalesce(F.array_max(F.transform("findings", lambda x: x["share"])), F.lit(0.0)).alias("score"),
        "findings",
    )
