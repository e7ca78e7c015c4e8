"""Document fingerprints: one-permutation MinHash, optimal densification, packed low-order bits.

Exploded rows and aggregates over them run in generated code. The texts are dealt out by their key once; all
aggregations of a text and of its edited version happen where it lies, without another shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import written

SHINGLE_WORDS = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
LOW_BITS = 4
PER_LONG = 64 // LOW_BITS
LONGS = BINS // PER_LONG
PER_FLAGS = 32  # flags of bins in one long, so that its sign and all differences stay out of play
FLAGS = BINS // PER_FLAGS
PROBES = 16
FEW = BINS // 2  # with more held bins the probes all but always find one
BLOCK_ROWS = 500_000
KEY = ["kid", "text_hash"]
VERSION = [*KEY, "edit"]  # whether it is the edited text
PRINT = [f"p{j}" for j in range(LONGS)]
_NIBBLES = 0x1111111111111111


def words(text: Column) -> Column:
    """Words of a text: ASCII white space parts, A-Z are folded."""
    folded = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )
    return F.array_remove(F.split(folded, "[\\x20\\x09-\\x0D]+"), "")


def _draw(probe: int) -> str:
    """The bin that the empty bin ``bin`` looks at in one probe: a universal hash of its number."""
    factor, summand = 0x9E3779B1 + 0x3C6EF372 * probe | 1, 0x7F4A7C15 * (probe + 1) % (1 << 31)
    return f"cast((((bin + 1L) * {factor}L + {summand}L) >> 11) & {BINS - 1} as int)"


def _held(at: str) -> str:
    return f"(shiftrightunsigned(held[{at} div {PER_FLAGS}], {at} % {PER_FLAGS}) & 1L) = 1L"


def _low(at: str) -> str:
    return f"shiftrightunsigned(low[{at} div {PER_LONG}], {LOW_BITS} * ({at} % {PER_LONG})) & {(1 << LOW_BITS) - 1}L"


_OWN = f"filter(sequence(0, {BINS - 1}), b -> {_held('b')})"  # the held bins


def _walk(bins: DataFrame) -> DataFrame:
    """``start``, ``step`` and ``inverse`` of each bin's way around all bins; the step is odd, so that it misses none."""
    last = BINS - 1
    way = bins.select(
        "*",
        F.expr(f"cast(((bin * 2654435761L + 374761393L) >> 9) & {last} as int)").alias("start"),
        F.expr(f"cast((2L * ((bin * 2246822519L + 3266489917L) >> 7) + 1L) & {last} as int)").alias("step"),
    )
    # the step is its own inverse in the 3 low bits; each turn doubles them
    way = way.withColumn("inverse", F.expr(f"(step * (2 - step * step)) & {last}"))
    return way.withColumn("inverse", F.expr(f"(inverse * (2 - step * inverse)) & {last}"))


def _last_resort() -> str:
    """The first held bin on the way of bin ``bin``: each held bin has one place on it, the least of these counts."""
    place = f"array_min(transform(coalesce(own, {_OWN}), b -> ((b - start) * inverse) & {BINS - 1}))"
    return f"((start + {place} * step) & {BINS - 1})"


def _moved(value: str, per_long: int, bits: int) -> str:
    """A value at ``bin``, where it lies in its long."""
    return f"shiftleft({value}, {bits} * cast(bin % {per_long} as int))"


def _packed(moved: str, lane: str, longs: int, prefix: str) -> list[Column]:
    """Moved values packed into the longs that ``lane`` numbers; each bin comes once."""
    return [
        F.expr(f"coalesce(bit_or(CASE WHEN {lane} = {j} THEN {moved} END), 0L)").alias(f"{prefix}{j}") for j in range(longs)
    ]


def prints(texts: DataFrame) -> DataFrame:
    """Fingerprints (VERSION, PRINT) of texts (VERSION, w: words); texts without words have none.

    The rows of a key must lie together. Each shingle is hashed once: its top bits choose the bin, the least hash of a
    bin is its value, of which the low bits are kept. A bin without shingles takes the value of the first bin with
    shingles among its own draws, which do not depend on the text: PROBES hashed ones, then, for texts of few
    shingles, all bins in an order of its own. Equal sets of shingles give equal fingerprints.

    Only the empty bins look for a value; beside them one row (bin -1) brings the values of the others.
    """
    places = texts.where("size(w) > 0").select(
        *VERSION, "w", F.explode(F.expr(f"sequence(0, greatest(size(w) - {SHINGLE_WORDS}, 0))")).alias("at")
    )
    # of a shorter text the words that are not there are NULL, which a hash passes over
    shingle = [F.get("w", F.col("at") + k) for k in range(SHINGLE_WORDS)]
    hashed = places.select(*VERSION, F.xxhash64(*shingle).alias("h"))
    binned = hashed.select(*VERSION, F.expr(f"cast(shiftrightunsigned(h, {64 - BIN_BITS}) as int)").alias("bin"), "h")
    least = binned.groupBy(*VERSION, "bin").agg(F.min("h").alias("h"))
    placed = least.select(
        *VERSION,
        F.expr(f"bin div {PER_LONG}").alias("lane"),
        F.expr(_moved(f"(h & {(1 << LOW_BITS) - 1}L)", PER_LONG, LOW_BITS)).alias("moved"),
        F.expr(f"bin div {PER_FLAGS}").alias("flags"),
        F.expr(_moved("1L", PER_FLAGS, 1)).alias("flag"),
    )
    packed = placed.groupBy(*VERSION).agg(*_packed("moved", "lane", LONGS, "l"), *_packed("flag", "flags", FLAGS, "h"))
    arrays = packed.select(
        *VERSION,
        F.array(*[f"l{j}" for j in range(LONGS)]).alias("low"),
        F.array(*[f"h{j}" for j in range(FLAGS)]).alias("held"),
        F.expr(" + ".join(f"bit_count(h{j})" for j in range(FLAGS))).alias("n_held"),
    ).withColumn("own", F.expr(f"CASE WHEN n_held <= {FEW} THEN {_OWN} END"))
    bins = arrays.select(*VERSION, "low", "held", "own", F.explode(F.sequence(F.lit(-1), F.lit(BINS - 1))).alias("bin"))
    bins = bins.where(f"CASE WHEN bin < 0 THEN true ELSE NOT ({_held('bin')}) END")
    cases = " ".join(f"WHEN {_held(at)} THEN {at}" for at in map(_draw, range(PROBES)))
    source = _walk(bins).withColumn("source", F.expr(f"CASE WHEN bin < 0 THEN 0 {cases} END"))
    source = source.select(*VERSION, "low", "bin", F.expr(f"coalesce(source, {_last_resort()})").alias("source"))
    filled = source.select(
        *VERSION,
        F.when(F.col("bin") < 0, F.col("low")).alias("low"),
        F.expr(f"CASE WHEN bin < 0 THEN -1 ELSE bin div {PER_LONG} END").alias("lane"),
        F.expr(f"CASE WHEN bin >= 0 THEN {_moved(f'({_low("source")})', PER_LONG, LOW_BITS)} END").alias("moved"),
    )
    values = [F.expr(f"bit_or(CASE WHEN lane < 0 THEN low[{j}] WHEN lane = {j} THEN moved END)").alias(p) for j, p in enumerate(PRINT)]
    return filled.groupBy(*VERSION).agg(*values)


def as_text(prefix: str = "") -> Column:
    """Fixed-width hex of a fingerprint; empty for a text without words."""
    return F.coalesce(F.concat(*[F.lpad(F.hex(f"{prefix}{p}"), 16, "0") for p in PRINT]), F.lit(""))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two fingerprints, corrected for low bits that agree by chance.

    Equal fingerprints give 1, those of two texts without words too; one without words against another gives 0.
    """

    def apart(p: str) -> str:
        x = f"({a}{p} ^ {b}{p})"
        pairs = f"({x} | shiftrightunsigned({x}, 1))"
        return f"bit_count(({pairs} | shiftrightunsigned({pairs}, 2)) & {_NIBBLES}L)"

    differing = F.expr(" + ".join(map(apart, PRINT)))
    chance = 1.0 / (1 << LOW_BITS)
    share = (1 - differing / BINS - chance) / (1 - chance)
    none_a, none_b = F.col(f"{a}{PRINT[0]}").isNull(), F.col(f"{b}{PRINT[0]}").isNull()
    return F.when(none_a & none_b, 1.0).when(none_a | none_b, 0.0).otherwise(F.greatest(F.lit(0.0), share))


def keyed(docs: DataFrame) -> DataFrame:
    """(KEY, doc_id, text): a key without NULL, one for rows of equal id and text."""
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("")).alias("kid"),
        F.xxhash64("text").alias("text_hash"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    )


def successors(rows: DataFrame) -> DataFrame:
    """(KEY, need, next_kid, next_hash): each text's next in descending order of ids, the first after the last.

    ``rows``: (KEY, doc_id, n_chars, copies), one for each key. The order is by id, then text hash, NULL ids last. The
    rows are dealt out by range, numbered by block, and ordered within blocks; the first row of each block, a table of
    one row for each block, closes the gaps.
    """
    blocks = max(2, -(-rows.count() // BLOCK_ROWS))
    order = [F.desc_nulls_last("doc_id"), F.desc("text_hash")]
    dealt = rows.repartitionByRange(blocks, *order).withColumn("block", F.spark_partition_id())
    dealt = written(dealt, "dealt")  # from here on the numbers of the blocks are fixed
    within = Window.partitionBy("block").orderBy(*order)
    after = dealt.withColumn("after", F.lead(F.struct(*KEY)).over(within))
    heads = dealt.withColumn("at", F.row_number().over(within)).where("at = 1").select("block", F.struct(*KEY).alias("head"))
    heads = heads.withColumn("all", F.lit(1))  # as many rows as blocks
    every = Window.partitionBy("all").orderBy("block")
    wrap = F.first("head").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("block", F.coalesce(F.lead("head").over(every), wrap).alias("next_head"))
    found = after.join(heads, "block").withColumn("following", F.coalesce("after", "next_head"))
    return found.select(
        *KEY,
        F.expr("cast(n_chars div 3 as int)").alias("need"),
        F.col("following.kid").alias("next_kid"),
        F.col("following.text_hash").alias("next_hash"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every whole text and of an edited one: its last third replaced by the next document's beginning.

    Columns: ``doc_id``, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (hex),
    ``near_edited``, ``near_next`` (estimated likeness to the edited text's and to the next document's). The next
    document is that of the next smaller id, after the least the greatest; of rows that repeat an id with different
    texts, the one with the next smaller text hash. Equal rows count as one in that order, and each gets its result;
    one row per input row. NULL ids come last. A NULL text counts as empty; the only document follows itself. A text
    without words has the empty fingerprint. Only id and text are read.
    """
    rows = keyed(docs)
    small = rows.groupBy(*KEY).agg(
        F.first("doc_id").alias("doc_id"), F.max(F.length("text").cast("long")).alias("n_chars"), F.count("*").alias("copies")
    )
    small = written(small, "keys")
    order = written(successors(small), "order")

    # the texts move once, to their keys, where everything is made in one run: all uses read the same exchange
    texts = rows.groupBy(*KEY).agg(F.first("text").alias("text"))
    asks = order.select(
        F.col("next_kid").alias("kid"), F.col("next_hash").alias("text_hash"),
        F.struct(*KEY).alias("for"), "need",
    )
    heads = texts.join(asks, KEY).select("for.kid", "for.text_hash", F.expr("substring(text, 1, need)").alias("head"), "need")
    edited = texts.join(heads, KEY).select(
        *KEY, "text", F.expr("concat(substring(text, 1, length(text) - need), head)").alias("edited")
    )
    # the words are made within the array, once: a filter on them above a projection would make them again
    versions = F.array(*[F.struct(F.lit(edit).alias("edit"), words(F.col(of)).alias("w")) for edit, of in ((False, "text"), (True, "edited"))])
    made = prints(edited.select(*KEY, F.inline(versions)))
    digests = edited.select(*KEY, F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    made = written(made.unionByName(digests, allowMissingColumns=True), "prints")

    of = lambda edit, prefix: made.where(edit).select(*KEY, *[F.col(p).alias(f"{prefix}{p}") for p in PRINT])
    following = order.select(*KEY, "next_kid", "next_hash")
    nexts = of("edit = false", "n").withColumnsRenamed({"kid": "next_kid", "text_hash": "next_hash"})
    found = (
        small.join(made.where("edited_sha256 IS NOT NULL").select(*KEY, "edited_sha256"), KEY)
        .join(of("edit = true", "e"), KEY, "left")
        .join(of("edit = false", "o"), KEY, "left")
        .join(following, KEY)
        .join(nexts, ["next_kid", "next_hash"], "left")
    )
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text("o").alias("fingerprint"),
        as_text("e").alias("edited_fingerprint"),
        likeness("o", "e").alias("near_edited"),
        likeness("o", "n").alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"),
    ).drop("_copy")
