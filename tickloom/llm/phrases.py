"""Phrase collocation mining with stripes: each prefix keys an associative counter of its next words."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import byte_slices, written
from tickloom.llm.near_dups import mixed

LEAST_COUNT = 100
MOST_WORDS = 5
TOP = 2000
FILTER_BITS = 26  # a filter has 8 MB
CHUNK_BITS = 8
WORDS_A_BUCKET = 8
FILTERED_WORDS = 3
HELD_BUCKETS = 6_000_000
HELD_ELEMENTS = 1_000_000
SALTS = 256
NO_LANGUAGE = "und"
_U = np.uint64
_BREAK = b"\n"
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c == 9 else 10 if c in b".,;:!?\n\v\f\r" else c for c in range(256)
)  # A-Z folded, tabs to spaces, every separator of pieces to a line feed
_PLACES = np.random.default_rng(20250117).integers(1, 1 << 63, MOST_WORDS, dtype=np.uint64) * _U(2) + _U(1)


class _Numbers(dict):
    """Numbers of words in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _hashes(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _buckets(hashes: list[np.ndarray], lang: str, bits: int) -> np.ndarray:
    """The bucket, one of 2 ** bits, of phrases whose words have these hashes."""
    total = np.full(len(hashes[0]), xxhash.xxh64_intdigest(lang.encode()), np.uint64)
    for place, h in zip(_PLACES, hashes, strict=False):
        total += h * place
    return (mixed(total) >> _U(64 - bits)).astype(np.int64)


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(language, distinct words, word numbers) of a batch; number 0 stands between pieces and between texts."""
    langs = batch.column(0).to_pylist()
    texts = batch.column(1).cast(pa.binary()).to_pylist()
    for lang in dict.fromkeys(langs):
        whole = _BREAK.join([t for own, t in zip(langs, texts, strict=True) if own == lang and t])
        parts = whole.translate(_TABLE).replace(_BREAK, b" \n ").split(b" ")
        numbers = _Numbers({_BREAK: 0})
        ids = np.fromiter(map(numbers.__getitem__, filter(None, parts)), np.int64)
        if len(numbers) > 1:
            yield lang, list(numbers), ids


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, f) of all single words."""

    def sent(held: dict[str, dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            columns = [pa.array([lang] * len(counts), pa.string()), _strings(list(counts)), pa.array(list(counts.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f"])

    def count(batches):
        held: dict[str, dict[bytes, int]] = {}
        for batch in byte_slices(batches, column=1):
            for lang, words, ids in _tokens(batch):
                own = held.setdefault(lang, {})
                for word, n in zip(words[1:], np.bincount(ids, minlength=len(words))[1:].tolist(), strict=True):
                    own[word] = own.get(word, 0) + n
            if sum(map(len, held.values())) > HELD_ELEMENTS:
                yield from sent(held)
                held = {}
        yield from sent(held)

    counted = _texts(docs).mapInArrow(count, "lang string, phrase string, f bigint")
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


class Filter:
    """A bit for the bucket of every phrase that may be frequent: of fixed size, without false negatives."""

    def __init__(self, flags: DataFrame, words: int, bits: int) -> None:
        self.words, self.bits, self.shift = words, bits, max(0, bits - FILTER_BITS)
        found = flags.groupBy("slot").agg(F.bit_or("flags").alias("flags")).toArrow()
        self.table = np.zeros(1 << (bits - self.shift - 6), np.uint64)
        self.table[found["slot"].to_numpy()] = found["flags"].to_numpy().view(np.uint64)

    def passes(self, ids: np.ndarray, hashes: np.ndarray, lang: str) -> np.ndarray:
        """Whether the phrase at each place lies within one piece and passes."""
        size = max(0, len(ids) - self.words + 1)
        places = _buckets([hashes[t : t + size] for t in range(self.words)], lang, self.bits) >> self.shift
        good = (self.table[places >> 6] >> (places & 63).astype(np.uint64)) & _U(1) > 0
        for t in range(self.words):
            good &= ids[t : t + size] > 0
        return good


def _flags(buckets: np.ndarray, bits: int) -> pa.RecordBatch:
    places = buckets >> max(0, bits - FILTER_BITS)
    flags = np.left_shift(_U(1), (places & 63).astype(np.uint64)).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(places >> 6), pa.array(flags)], ["slot", "flags"])


def word_filter(frequent: DataFrame, bits: int) -> Filter:
    """The filter of the words (lang, phrase)."""

    def place(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                langs = np.array(batch.column(0).to_pylist(), object)
                words = _hashes([w.encode() for w in batch.column(1).to_pylist()])
                for lang in dict.fromkeys(langs.tolist()):
                    yield _flags(_buckets([words[langs == lang]], lang, bits), bits)

    return Filter(frequent.select("lang", "phrase").mapInArrow(place, "slot bigint, flags bigint"), 1, bits)


def phrase_filter(docs: DataFrame, before: Filter, least: int) -> Filter:
    """The filter of phrases one word longer, from hashed counts: a bucket of fewer than ``least`` has no frequent phrase.

    Only phrases whose first and last words pass the filter ``before`` are counted. Each task sends the counts of its
    buckets in CHUNKS or more runs of consecutive buckets, packed as differences and capped counts; a run's counters
    are added up in an array of fixed size, one run after the other.
    """
    bits, words = before.bits, before.words + 1
    run_bits = min(22, bits - CHUNK_BITS)
    kind = np.dtype(np.uint8 if least < 256 else np.uint32)

    def packed(buckets: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        runs = buckets >> run_bits
        edges = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
        gaps, widths = [], []
        within = buckets & ((1 << run_bits) - 1)
        ends = np.r_[edges[1:], len(buckets)]
        for start, end in zip(edges, ends, strict=True):
            steps = np.diff(within[start:end], prepend=0)
            width = 1 if steps.max() < 1 << 8 else 2 if steps.max() < 1 << 16 else 4
            widths.append(width)
            gaps.append(steps.astype(f"<u{width}").tobytes())
        counts = np.minimum(counts, least).astype(kind)
        columns = [
            pa.array(runs[edges], pa.int64()),
            pa.array(widths, pa.int32()),
            pa.array(gaps, pa.binary()),
            pa.array([counts[i:j].tobytes() for i, j in zip(edges, ends, strict=True)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["run", "width", "gaps", "counts"])

    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def gathered():
            buckets, at = np.unique(np.concatenate([b for b, _ in held]), return_inverse=True)
            return buckets, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

        with np.errstate(over="ignore"):
            for batch in byte_slices(batches, column=1):
                for lang, known, ids in _tokens(batch):
                    hashes = _hashes(known)[ids]
                    good = before.passes(ids, hashes, lang)
                    starts = np.flatnonzero(good[:-1] & good[1:])
                    if len(starts):
                        found = _buckets([hashes[starts + t] for t in range(words)], lang, bits)
                        held.append(np.unique(found, return_counts=True))
                if sum(len(b) for b, _ in held) > HELD_BUCKETS:
                    yield packed(*gathered())
                    held = []
            if held:
                yield packed(*gathered())

    def add_up(batches):
        run, totals = None, np.zeros(1 << run_bits, np.uint32)

        def frequent():
            return _flags((run << run_bits) + np.flatnonzero(totals >= least), bits)

        for batch in batches:
            for at, width, gaps, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != run:
                    if run is not None:
                        yield frequent()
                        totals[:] = 0
                    run = at
                places = np.cumsum(np.frombuffer(gaps, f"<u{width}"), dtype=np.int64)
                totals[places] = np.minimum(totals[places] + np.frombuffer(counts, kind), least)
        if run is not None:
            yield frequent()

    counted = _texts(docs).mapInArrow(count, "run bigint, width int, gaps binary, counts binary")
    dealt = counted.repartition("run").sortWithinPartitions("run")
    return Filter(dealt.mapInArrow(add_up, "slot bigint, flags bigint"), words, bits)


def stripes(docs: DataFrame, filters: list[Filter], most_words: int, least: int) -> DataFrame:
    """(lang, phrase, prefix, rest, f): the phrases of ``least`` occurrences or more; ``rest`` is without the first word.

    A prefix keys a stripe, the counter of its next words. Only phrases that pass the filter of their length are
    counted, longer ones if all their parts of the longest filtered length pass. Each task adds up its stripes element
    by element and sends them in as many runs as counters were sent (see phrase_filter). A run holds the elements of
    one hash range, so that a prefix with any number of next words is dealt out over all runs; within a run stripes
    are added up element by element again.
    """
    bits = filters[-1].bits
    runs = 1 << (bits - min(22, bits - CHUNK_BITS))

    def sent(held: dict[tuple[str, bytes], dict[bytes, int]]) -> pa.RecordBatch:
        dealt: dict[int, list[list]] = {}
        for (lang, prefix), stripe in held.items():
            own: dict[int, list[tuple[bytes, int]]] = {}
            for following, n in stripe.items():
                own.setdefault(xxhash.xxh64_intdigest(prefix + b" " + following) % runs, []).append((following, n))
            for run, elements in own.items():
                row = dealt.setdefault(run, [[], [], [], [], []])
                row[0].append(lang)
                row[1].append(prefix)
                row[2].append(len(elements))
                row[3] += [w for w, _ in elements]
                row[4] += [n for _, n in elements]
        kinds = [pa.string(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
        columns = [pa.array([row[i] for row in dealt.values()], pa.list_(kind)) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([pa.array(list(dealt), pa.int64()), *columns], ["run", "langs", "prefixes", "sizes", "words", "counts"])

    def add(held, known, lang, ids, starts, words: int) -> int:
        """Add the phrases at these places of one slice; returns the number of elements touched."""
        if not len(starts):
            return 0
        code = ids[starts]
        for t in range(1, words):  # an exact number for each phrase
            code = np.unique(code, return_inverse=True)[1] * len(known) + ids[starts + t]
        _, first, counts = np.unique(code, return_index=True, return_counts=True)
        for at, n in zip(starts[first].tolist(), counts.tolist(), strict=True):
            *prefix, following = (known[i] for i in ids[at : at + words].tolist())
            stripe = held.setdefault((lang, b" ".join(prefix)), {})
            stripe[following] = stripe.get(following, 0) + n
        return len(first)

    def count(batches):
        held: dict[tuple[str, bytes], dict[bytes, int]] = {}
        touched = 0
        with np.errstate(over="ignore"):
            for batch in byte_slices(batches, column=1):
                for lang, known, ids in _tokens(batch):
                    hashes = _hashes(known)[ids]
                    for own in filters:
                        good = own.passes(ids, hashes, lang)
                        touched += add(held, known, lang, ids, np.flatnonzero(good), own.words)
                    for words in range(filters[-1].words + 1, most_words + 1):
                        good = good[:-1] & good[1:]
                        touched += add(held, known, lang, ids, np.flatnonzero(good), words)
                if touched > HELD_ELEMENTS:
                    yield sent(held)
                    held, touched = {}, 0
        if held:
            yield sent(held)

    def add_up(batches):
        run, totals = None, {}

        def frequent():
            rows = [(lang, prefix, w, n) for (lang, prefix), stripe in totals.items() for w, n in stripe.items() if n >= least]
            phrases = [prefix + b" " + w for _, prefix, w, _ in rows]
            columns = [
                pa.array([r[0] for r in rows], pa.string()),
                _strings(phrases),
                _strings([r[1] for r in rows]),
                _strings([p.split(b" ", 1)[1] for p in phrases]),
                pa.array([r[3] for r in rows], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "prefix", "rest", "f"])

        for batch in batches:
            for at, langs, prefixes, sizes, words, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != run:
                    if run is not None:
                        yield frequent()
                        totals.clear()
                    run = at
                elements = zip(words, counts, strict=True)
                for lang, prefix, size in zip(langs, prefixes, sizes, strict=True):
                    stripe = totals.setdefault((lang, prefix), {})
                    for following, n in itertools.islice(elements, size):
                        stripe[following] = stripe.get(following, 0) + n
        if run is not None:
            yield frequent()

    parts = "langs array<string>, prefixes array<binary>, sizes array<bigint>, words array<binary>, counts array<bigint>"
    counted = _texts(docs).mapInArrow(count, f"run bigint, {parts}")
    dealt = counted.repartition("run").sortWithinPartitions("run")
    return dealt.mapInArrow(add_up, "lang string, phrase string, prefix string, rest string, f bigint")


def _cuts(phrase: str) -> Column:
    """The places where a phrase can be cut in two: (k, first k words, the others)."""
    join = "array_join(slice({0}, {1}, {2}), ' ')"
    first, rest = join.format(phrase, 1, "k"), join.format(phrase, "k + 1", f"size({phrase}) - k")
    return F.expr(f"transform(sequence(1, size({phrase}) - 1), k -> struct(k, {first} AS first, {rest} AS rest))")


#: floor(1000 * a * n / (l * r)), exactly: products have up to 38 digits.
SCORE = (
    "(cast(1000 AS decimal(4,0)) * cast(a AS decimal(15,0)) * cast(n AS decimal(17,0))) "
    "div (cast(l AS decimal(17,0)) * cast(r AS decimal(17,0)))"
)


def collocations(
    docs: DataFrame, least: int = LEAST_COUNT, most_words: int = MOST_WORDS, top: int = TOP, bucket_bits: int | None = None
) -> DataFrame:
    """The strongest phrases of 2 to ``most_words`` words of every language.

    Columns: ``lang``, ``rank`` (from 1), ``phrase`` (words joined by a space), ``a`` (its occurrences), ``l`` and ``r``
    (those of its two parts), ``n`` (words of the language), ``score``: floor(1000 * a * n / (l * r)) at the cut where it
    is least, of equals the first one. Phrases occur ``least`` times or more; one that lies within a longer one of as
    many occurrences is left out. Per language the ``top`` first by score, occurrences, phrase in byte order.

    A-Z are folded; ``.,;:!?`` and line ends part pieces, spaces and tabs part words, and no phrase passes the end of a
    piece or text. A NULL text counts as empty, a NULL language as ``und``; repeated rows count each. No words, or an
    empty table, give no rows. Only lang and text are read.

    A part of a frequent phrase is frequent, and so is the bucket that a hash puts it into: for each length, hashed
    counts of the phrases whose parts pass the filter of the length before give the filter of this one, up to
    FILTERED_WORDS; then all phrases that pass are counted exactly, in stripes. There are about as many buckets as an eighth of the words of the
    corpus (2 ** bucket_bits if given); filters have a fixed size, and one too small for a corpus only prunes less.
    """
    if not 2 <= most_words <= MOST_WORDS:
        raise ValueError(f"phrases have 2 to {MOST_WORDS} words")
    every = written(word_counts(docs), "words")
    totals = written(every.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    frequent = written(every.where(F.col("f") >= least), "frequent")
    all_words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = bucket_bits or max(FILTER_BITS, (all_words // WORDS_A_BUCKET).bit_length())
    filters = [word_filter(frequent, bits)]
    while len(filters) < min(most_words, FILTERED_WORDS):
        filters.append(phrase_filter(docs, filters[-1], least))
    found = written(stripes(docs, filters[1:], most_words, least), "stripes")
    counts = frequent
    counts = counts.unionByName(found.select("lang", "phrase", "f"))

    # the largest count of a phrase one word longer, on either side; longer ones have no more
    around = found.select("lang", F.explode(F.array_distinct(F.array("prefix", "rest"))).alias("phrase"), "f")
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = found.join(around, ["lang", "phrase"], "left").where("longer IS NULL OR longer < f")

    cut = kept.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("spelled"))
    cut = cut.select("lang", "phrase", "a", F.inline(_cuts("spelled")).alias("k", "first", "rest"))
    for part, name in (("first", "l"), ("rest", "r")):
        cut = cut.join(counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    cut = cut.join(totals, "lang")
    best = cut.groupBy("lang", "phrase").agg(
        F.min(F.expr(f"struct({SCORE} AS score, k, l, r)")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n")
    )
    scored = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))  # so that no task sorts a whole language
    partly = scored.withColumn("salt", salt).withColumn("at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    ranked = partly.where(F.col("at") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("bigint"), "phrase", "a", "l", "r", "n", "score")
