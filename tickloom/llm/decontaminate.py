"""Benchmark decontamination: hashed test windows, a scan of all training windows, verification, removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import packed

WINDOW_WORDS = 13
BROADCAST_WINDOWS = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# the same in a text as it is: there A-Z belong to words
_GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_WORD_OR_GAP = "[^" + _GAP[1:] + "|" + _GAP


def folded(text: Column) -> Column:
    """A-Z lowered, nothing else: on an ASCII text ``lower`` does just that."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """Words of the folded text; none for NULL."""
    return F.array_remove(F.split(F.coalesce(folded(text), F.lit("")), _BETWEEN), "")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Distinct (hash, size, gram, item_id): every ``window`` consecutive words, or all of a shorter item."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    rows = rows.where("size(w) > 0").withColumn("size", F.least(F.size("w"), F.lit(window)))
    cut = rows.select("item_id", "size", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("at"))
    return (
        cut.select("item_id", "size", F.slice("w", F.col("at"), F.col("size")).alias("gram"))
        .select(F.xxhash64("gram").alias("hash"), "size", "gram", "item_id")
        .distinct()
    )


def _scanned(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """Per document: one summary row (``at`` NULL, ``n_words``) and a row for each place and item of a window.

    Summary and windows come from one scan. The windows are joined with the benchmark's by hash, then word for word.
    """
    grams = benchmark_windows(benchmark, window)
    by_size = {r["size"]: r["n"] for r in grams.groupBy("size").agg(F.count("*").alias("n")).collect()}
    sizes = sorted(by_size) or [window]  # ``window`` different sizes at most
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    longest = F.greatest(F.size("w") - sizes[0] + 1, F.lit(0)) * len(sizes)
    step = rows.select("*", F.explode(F.sequence(F.lit(-1), longest - 1)).alias("step"))
    size = reduce(lambda c, i: c.when(F.col("step") % len(sizes) == i, sizes[i]), range(1, len(sizes)), F.when(F.col("step") < 0, -1))
    places = step.select(
        "doc_id",
        "text_hash",
        "w",
        F.when(F.col("step") >= 0, F.floor(F.col("step") / len(sizes))).alias("at"),
        size.otherwise(sizes[0]).alias("size"),
    ).where("size < 0 OR at + size <= size(w)")
    scan = places.select(
        "doc_id",
        "text_hash",
        "at",
        "size",
        F.when(F.col("at").isNull(), F.size("w")).cast("long").alias("n_words"),
        F.when(F.col("at").isNotNull(), F.expr("slice(w, cast(at + 1 AS INT), size)")).alias("g"),
    ).withColumn("hash", F.coalesce(F.xxhash64("g"), F.col("text_hash")))
    grams = grams.withColumn("found", F.lit(True))  # the id of an item may be NULL
    if sum(by_size.values()) <= BROADCAST_WINDOWS:  # counted just now; a larger set meets the windows in a shuffle
        grams = F.broadcast(grams)
    found = scan.alias("s").join(grams.alias("b"), F.expr("s.hash = b.hash AND s.size = b.size AND s.g = b.gram"), "left")
    return found.where("s.at IS NULL OR b.found").select("doc_id", "text_hash", "at", "s.size", "n_words", "item_id")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, positions: bool = False) -> DataFrame:
    """Words of every document that stand in an occurrence of a benchmark window.

    Columns: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` (of the item ids as text, sorted,
    comma-joined), ``contaminated`` (n_hit > 0 and 20 * n_hit >= n_words), ``text_hash`` (xxhash64 of the text), and
    with ``positions`` also ``hit_words`` (their places from 0, at most a document's words). One row per input row;
    rows that repeat id and text get equal results. A NULL text has no words. A NULL id is an id like others.
    Items with a NULL id have windows like others, so their words count for ``n_hit``; having no id, they count neither
    for ``n_items`` nor in ``items_sha256``. Benchmark items without words give no window; an empty benchmark gives no hit. Other columns are not read.
    """
    scanned = _scanned(docs, benchmark, window)
    # a place becomes its words, an item one more row; equal ones fall together before the shuffle
    facts = scanned.select(
        "doc_id",
        "text_hash",
        "n_words",
        F.explode(
            F.when(F.col("at").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(
                F.sequence(F.lit(-1).cast("long"), F.col("size").cast("long") - 1)
            )
        ).alias("k"),
        "at",
        "item_id",
    ).select(
        "doc_id",
        "text_hash",
        "n_words",
        F.when(F.col("k") >= 0, F.col("at") + F.col("k")).alias("word"),
        F.when(F.col("k") < 0, F.col("item_id")).alias("item"),
    )
    once = facts.groupBy("doc_id", "text_hash", "word", "item").agg(
        F.max("n_words").alias("n_words"), F.count("n_words").alias("rows")
    )
    aggregates = [
        F.max("n_words").alias("n_words"),
        F.sum("rows").alias("rows"),
        F.count("word").alias("n_hit"),
        F.count("item").alias("n_items"),
        F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"),
    ]
    if positions:
        aggregates.append(F.sort_array(F.collect_list("word")).alias("hit_words"))
    found = once.groupBy("doc_id", "text_hash").agg(*aggregates)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.col("items").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "text_hash",
        *(["hit_words"] if positions else []),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("_copy"),
    ).drop("_copy")


def _same(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Rows and findings of equal id and text; a NULL id meets a NULL id."""
    found = found.withColumnsRenamed({"doc_id": "_found_id", "text_hash": "_found_hash"})
    return rows.join(found, F.col("_id").eqNullSafe(F.col("_found_id")) & (F.col("_hash") == F.col("_found_hash")), how)


def without_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The documents that are not contaminated, all columns; repeated rows stay or go together."""
    bad = contamination(docs, benchmark, window).where("contaminated").select("doc_id", "text_hash").distinct()
    return _same(packed(docs), bad, "left_anti").select("_row.*")


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """All documents, all columns, with the hit words of contaminated ones taken out of ``text``."""
    bad = contamination(docs, benchmark, window, positions=True).where("contaminated")
    bad = bad.select("doc_id", "text_hash", "hit_words").dropDuplicates(["doc_id", "text_hash"])
    rows = _same(packed(docs), bad, "left").withColumn(
        "_parts", F.regexp_extract_all("_row.text", F.lit(f"({_WORD_OR_GAP})"), F.lit(1))
    )
    # words and gaps alternate, so the place of a word follows from that of its part
    rows = rows.withColumn("_first", F.get("_parts", F.lit(0)).rlike("^" + _GAP + "$").cast("int"))
    left = F.filter(
        "_parts",
        lambda part, i: ((i + F.col("_first")) % 2 == 1)
        | ~F.array_contains("hit_words", F.floor((i - F.col("_first")) / 2)),
    )
    text = F.when(F.col("hit_words").isNull(), F.col("_row.text")).otherwise(F.array_join(left, ""))
    return rows.withColumn("_row", F.col("_row").withField("text", text)).select("_row.*")
