"""Collocations against a plain count of every phrase, at small thresholds, and the score's exact arithmetic."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests import oracle
from tests.llm import data
from tickloom.llm import phrases
from tickloom.llm.queries import ORACLES, QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, most, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, most + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    found = []
    for lang, f in counts.items():
        chosen = {g: n for g, n in f.items() if len(g) > 1 and n >= least}
        inner = defaultdict(int)
        for g, n in chosen.items():
            for i in range(len(g)):
                for j in range(i + 1, len(g) + 1):
                    if j - i < len(g):
                        inner[g[i:j]] = max(inner[g[i:j]], n)
        kept = []
        for g, a in chosen.items():
            if inner[g] >= a:
                continue
            score, _, left, right = min(
                (1000 * a * totals[lang] // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g))
            )
            kept.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, g, left, right) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, g.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    docs = docs.select("*", *[F.lit("clash").alias(c) for c in ("phrase", "prefix", "next", "n", "f", "a", "rest", "k", "longer")])
    return sorted(map(tuple, phrases.collocations(docs, **options).collect()))


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    words = ["A", "b", "ab", "É", "é", "c\x00", "中文", "\x1f", "d-e"]
    glue = [" ", " ", " ", "  ", "\t", ". ", "\n", "\r", "\x0b", "!", " , "]
    rows = [
        (rng.choice(["en", "en", "en", "fr", None, "und", ""]), "".join(rng.choice(words) + rng.choice(glue) for _ in range(rng.randrange(60))))
        for _ in range(60)
    ]
    rows += [("en", None), (None, ""), ("en", " \t\n ..."), ("fr", "a b c d e f g. " * 5)]
    for least, top in ((2, 2000), (4, 7)):
        assert run(spark, rows, least=least, top=top) == plain(rows, least, 5, top)
    assert run(spark, rows, least=3, most_words=3) == plain(rows, 3, 3, 2000)


def test_the_filter_only_prunes(spark):
    rows = [("en", data.prose(k % 7, 50) + " one two three") for k in range(30)]
    wanted = plain(rows, 4, 5, 2000)
    assert len(wanted) > 50
    for bits in (14, 18, 27):
        assert run(spark, rows, least=4, bucket_bits=bits) == wanted


def test_counts_sent_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "byte_slices", lambda batches, column: (b.slice(i, 1) for b in batches for i in range(b.num_rows)))
    monkeypatch.setattr(phrases, "HELD_BUCKETS", 20)
    monkeypatch.setattr(phrases, "HELD_ELEMENTS", 20)
    rows = [("en" if k % 3 else "fr", data.prose(k % 7, 50)) for k in range(40)]
    assert run(spark, rows, least=4) == plain(rows, 4, 5, 2000)
    rows = [("en", "a b c. " * 50)] * 12
    assert run(spark, rows, least=300) == plain(rows, 300, 5, 2000) != []


def test_a_hot_prefix_and_a_long_text(spark):
    rows = [("en", " ".join(f"the w{k % 40}" for k in range(20_000)))] + [("en", "the the the the")] * 30
    assert run(spark, rows, least=20) == plain(rows, 20, 5, 2000)


def test_nothing(spark):
    assert run(spark, []) == []
    assert run(spark, [("en", None), (None, "one word. each piece.")]) == []
    with pytest.raises(ValueError, match="2 to 5"):
        run(spark, [], most_words=6)


def test_scores_beyond_a_long(spark):
    cases = [(10**14, 10**16, 10**15 + 1, 10**15 + 3), (999_999_999_999_999, 99_999_999_999_999_999, 10**16, 10**16 - 1), (100, 10**12, 100, 100)]
    df = spark.createDataFrame(cases, "a bigint, n bigint, l bigint, r bigint")
    found = [r[0] for r in df.selectExpr(phrases.SCORE).collect()]
    assert found == [1000 * a * n // (left * right) for a, n, left, right in cases]


def test_sql(spark, sf_dir):
    assert oracle.compare(spark, oracle.connect(sf_dir), QUERIES["op12_phrases"], ORACLES["op12_phrases"], sf_dir)[1] == ""
