"""Near-duplicates: MinHash with tensored banding, links confirmed on full shingle sets, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import byte_slices, packed, written

SHINGLE_WORDS = 5
PERCENT = 85
HALVES = 10
HASHES = 3
FIRST_PIVOTS = 4
PIVOTS = 4096  # a bucket of as many vertices is settled in two rounds
SKETCH_BITS = 64
SKETCH_APART = 18
PARITY_BITS = 512
CACHE_BYTES = 80 << 20
WORD_BYTES = 170  # what a cached word takes beside its own bytes
ROWS_AT_ONCE = 8192
SKETCH = [*[f"s{i}" for i in range(SKETCH_BITS // 64)], *[f"p{i}" for i in range(PARITY_BITS // 64)]]
_U = np.uint64
_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(1, 1 << 63, SKETCH_BITS, dtype=np.uint64) * _U(2) + _U(1)
_SHIFTS = _RNG.integers(0, 1 << 63, SKETCH_BITS, dtype=np.uint64)
_PLACES = _RNG.integers(1, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) * _U(2) + _U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingles:
    """Distinct 64-bit hashes of the shingles of a text, in ascending order.

    Hashes of words are kept from text to text; beyond CACHE_BYTES those of the last text alone are.
    """

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}
        self.held = 0

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.lower() folds A-Z only, bytes.split() parts at the six ASCII white-space codes only
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < SHINGLE_WORDS:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=1)], np.uint64)
        known = self.words
        if self.held > CACHE_BYTES:
            known.clear()
            self.held = 0
        new = set(words).difference(known)
        self.held += sum(map(len, new)) + WORD_BYTES * len(new)
        for word in new:
            known[word] = xxhash.xxh64_intdigest(word)
        ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = len(ids) - SHINGLE_WORDS + 1
        total = np.zeros(n, np.uint64)
        for k in range(SHINGLE_WORDS):
            total += ids[k : k + n] * _PLACES[k]
        return np.unique(mixed(total))


def half_keys(shingles: np.ndarray) -> np.ndarray:
    """Two collections of half keys, each of which joins a few minima; a table key later pairs one of either.

    Then follow two sketches: one bit of each minimum, and the parities of the numbers of shingles in PARITY_BITS
    classes. Each shingle that only one of two sets has flips one parity.
    """
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), ROWS_AT_ONCE):
        part = shingles[at : at + ROWS_AT_ONCE, None] * _FACTORS[None, :] + _SHIFTS[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    joined = np.zeros(2 * HALVES, np.uint64)
    for k in range(HASHES):
        joined = mixed(joined + least[k : 2 * HALVES * HASHES : HASHES])
    sketch = np.packbits((mixed(least) >> _U(63)).astype(np.uint8)).view(np.uint64)
    parities = np.bincount((shingles >> _U(64 - PARITY_BITS.bit_length() + 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.concatenate([joined, sketch, np.packbits(parities.astype(np.uint8)).view(np.uint64)]).view(np.int64)


def _gathered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written in as few files as its size asks for, not one for each task of the joins that made it.

    For tables that are small beside the shuffles that make them. On a local path an executor starts `chmod` for the files
    it writes, and until such a child has its own program it holds the executor's memory as well.
    """
    return written(df.hint("rebalance"), name)


def _rows(docs: DataFrame) -> DataFrame:
    """One small row per document: set size, set hash (its vertex), half keys and sketch. The only pass over all texts."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches) -> Iterator[pa.RecordBatch]:
        shingles, width = Shingles(), 2 * HALVES + len(SKETCH)
        with np.errstate(over="ignore"):
            for batch in byte_slices(batches, column=2):
                sizes, vertices, keys = [], [], []
                for text in batch.column(2).to_pylist():
                    found = shingles(text)
                    sizes.append(len(found))
                    # a set hash: the sum of mixed members and the size
                    vertices.append(mixed(np.array([mixed(found + _U(1)).sum(dtype=np.uint64) + _U(len(found))]))[0])
                    keys.append(half_keys(found).tobytes() if len(found) else bytes(8 * width))
                flat = pa.array(np.frombuffer(b"".join(keys), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(sizes, pa.int64()),
                        pa.array(np.array(vertices, np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * width), flat),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "vertex", "halves"],
                )

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        sign, f"doc_id {id_type}, text_hash bigint, n_shingles bigint, vertex bigint, halves array<bigint>"
    )


def _buckets(classes: DataFrame) -> DataFrame:
    """(key, vertex, i, j, first) of every table key (i, j) that two or more vertices share.

    A left half key that only one vertex has cannot be part of a shared table key, so it is dropped before the pairs
    are formed: most documents never reach the product. Only vertices and single half keys are moved for that.
    """
    lefts = classes.select("vertex", F.posexplode(F.slice("halves", 1, HALVES)).alias("i", "left"))
    shared = (
        lefts.groupBy("i", "left")
        .agg(F.min("vertex").alias("low"), F.max("vertex").alias("high"))
        .where("low <> high")
        .select("i", "left")
    )
    rights = classes.select("vertex", F.slice("halves", HALVES + 1, HALVES).alias("rights"))
    keys = (
        lefts.join(shared, ["i", "left"])
        .join(rights, "vertex")
        .select("vertex", "i", "left", F.posexplode("rights").alias("j", "right"))
        .select(F.xxhash64("i", "left", "j", "right").alias("key"), "vertex", "i", "j")
    )
    keys = written(keys, "keys")
    common = keys.groupBy("key").agg(F.min("vertex").alias("low"), F.max("vertex").alias("high")).where("low <> high")
    return keys.join(common.select("key", F.col("low").alias("first")), "key")


def _traits(classes: DataFrame, members: DataFrame) -> DataFrame:
    """(vertex, n, SKETCH, marks, doc_id, text_hash) of the vertices that share a table key.

    ``marks`` are 31 bits of each half key, by which a pair is known at its first shared key and met there only.
    """
    sketch = [F.get("halves", F.lit(2 * HALVES + i)).alias(c) for i, c in enumerate(SKETCH)]
    marks = F.transform(F.slice("halves", 1, 2 * HALVES), lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))
    found = classes.join(members.select("vertex").distinct(), "vertex", "left_semi")
    return found.select("vertex", "n", *sketch, marks.alias("marks"), "pick.doc_id", "pick.text_hash")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(vertex, members) for the wanted (vertex, doc_id, text_hash), from the texts again."""

    def sets(batches) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        with np.errstate(over="ignore"):
            for batch in byte_slices(batches, column=1):
                found = [shingles(t).view(np.int64) for t in batch.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))],
                    ["vertex", "members"],
                )

    texts = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    return (
        texts.join(wanted, ["doc_id", "text_hash"])
        .select("vertex", "text")
        .mapInArrow(sets, "vertex bigint, members array<bigint>")
        .dropDuplicates(["vertex"])  # repeated rows
    )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    own, other = (sets.select(F.col("vertex").alias(v), F.col("members").alias(f"set_{v}")) for v in "ab")
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (
        pairs.join(own, "a")
        .join(other, "b")
        .select("a", "b", both.alias("both"), (F.size("set_a") + F.size("set_b") - both).alias("either"))
        .where(100 * F.col("both") >= PERCENT * F.col("either"))
        .select("a", "b")
    )


def _roots(parents: DataFrame) -> DataFrame:
    """(node, component) of a forest (node, parent), parents less than nodes, by doubling the pointers.

    A node whose parent is a root is settled and takes part no more.
    """
    named = parents.select("node", F.col("parent").alias("component"))
    settled, open_nodes = None, named
    while True:
        above = open_nodes.select(F.col("node").alias("component"), F.col("component").alias("higher"))
        if settled is not None:
            above = above.unionByName(settled.select(F.col("node").alias("component"), F.col("component").alias("higher")))
        jumped = written(open_nodes.join(above, "component", "left"), "jumped")
        done = jumped.where("higher IS NULL").select("node", "component")
        settled = done if settled is None else settled.unionByName(done)
        open_nodes = jumped.where("higher IS NOT NULL").select("node", F.col("higher").alias("component"))
        if open_nodes.isEmpty():
            return settled


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable over the edges (a, b), for all nodes but the least ones themselves.

    Every node hooks onto its least neighbour if that is less than itself; the trees this makes are contracted to their
    roots, and only edges between different roots stay for the next round. Nothing but minima is aggregated, so a hub
    of any degree is one row, and nodes and edges that are settled take part no more: rounds add up to a constant
    factor. The rounds' maps are put together from the last one back.
    """
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rounds: list[DataFrame] = []
    while True:
        parents = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        rounds.append(_roots(parents))
        for end in "ab":
            to = rounds[-1].select(F.col("node").alias(end), F.col("component").alias(f"to_{end}"))
            edges = edges.join(to, end, "left")
        ends = F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b")
        edges = edges.select(*ends).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = written(edges.distinct(), "edges")
        if edges.isEmpty():
            break
    found = rounds.pop()
    while rounds:
        later = found.select(F.col("node").alias("component"), F.col("component").alias("root"))
        earlier = rounds.pop().join(later, "component", "left")
        found = written(earlier.select("node", F.coalesce("root", "component").alias("component")).unionByName(found), "rounds")
    return found


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    found = members.join(labels.withColumnRenamed("node", "vertex"), "vertex", "left")
    return found.withColumn("label", F.coalesce("component", "vertex")).drop("component")


def _may_link() -> str:
    """False where sizes rule a link out, or sketches further apart than those of linked sets are (see near_duplicates)."""
    minima = SKETCH_BITS // 64
    apart = lambda names: " + ".join(f"bit_count({c} ^ {c}_a)" for c in names)
    most = f"({(100 - PERCENT) / (100 + PERCENT)}D * (n + n_a))"  # shingles that only one of two linked sets has
    spread = f"{PARITY_BITS / 2}D * (1 - exp(-{2 / PARITY_BITS}D * {most})) + {5 * PARITY_BITS**0.5 / 2}D"
    return (
        f"100 * least(n, n_a) >= {PERCENT} * greatest(n, n_a) AND {apart(SKETCH[:minima])} <= {SKETCH_APART} "
        f"AND {apart(SKETCH[minima:])} <= least({most} + 1e-6D, {spread})"
    )


_MAY_LINK = _may_link()
# No key before this one is shared: pairs of keys are shared where the left and the right half are.
_FIRST_SHARED = " AND ".join(
    f"NOT ({at} > {k} AND marks[{k + offset}] = marks_a[{k + offset}])"
    for at, offset in (("i", 0), ("j", HALVES))
    for k in range(HALVES - 1)
)


def _linked(members: DataFrame, traits: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, component) of all vertices that confirmed links within the buckets connect.

    First every vertex meets the least vertex of all its buckets, one pair each, which settles most; then the least
    FIRST_PIVOTS of every bucket meet its members in other components, then the least PIVOTS, and in buckets with more
    vertices than that the next PIVOTS, and so on. Two vertices meet in the bucket of their first shared key alone,
    unless they are already connected, so no link between components is lost, and copies of one text or a family of
    near copies cost a few comparisons each, not one for each pair. A bucket within one component is done with; the
    sketches are fetched for the others alone.
    """
    compared = traits.select("vertex", "n", *SKETCH, "marks")
    pivot = compared.select(F.col("vertex").alias("a"), *[F.col(c).alias(f"{c}_a") for c in ("n", *SKETCH, "marks")])
    pairs = (
        members.where("vertex <> first")
        .select("vertex", F.col("first").alias("a"))
        .distinct()
        .join(compared, "vertex")
        .join(pivot, "a")
        .where(_MAY_LINK)
        .groupBy("vertex")
        .agg(F.min("a").alias("a"))
        .select("a", F.col("vertex").alias("b"))
    )
    labels = components(_gathered(_confirmed(pairs, sets), "links"))  # each round reads them twice
    members, width = members.drop("first"), FIRST_PIVOTS
    while True:
        live = _mixed(members, labels)
        rank = F.row_number().over(Window.partitionBy("key").orderBy("vertex"))
        pivots = live.withColumn("rank", rank).where(F.col("rank") <= width)
        if width == PIVOTS:  # read again below
            pivots = written(pivots, "pivots")
        other = pivots.select("key", F.col("vertex").alias("a"), F.col("label").alias("label_a")).join(pivot, "a")
        pairs = (
            live.join(compared, "vertex")
            .join(other, "key")
            .where(f"vertex > a AND label <> label_a AND {_MAY_LINK} AND {_FIRST_SHARED}")
            .select("a", F.col("vertex").alias("b"))
            .distinct()
        )
        new = _gathered(_confirmed(pairs, sets), "links")
        if not new.isEmpty():
            labels = _merged(labels, new)
        members = live.drop("label")
        if width == PIVOTS:  # only buckets with more vertices go on, without those that have met all others
            full = pivots.where(F.col("rank") == width).select("key", F.col("vertex").alias("met"))
            members = written(members.join(full, "key").where("vertex > met").drop("met"), "members")
            if members.isEmpty():
                return labels
        width = PIVOTS


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members with their labels, without the buckets whose members all have the same one."""
    labelled = _labelled(members, labels)
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return written(labelled.join(mixed.select("key"), "key"), "live")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: only the components that the links join are worked on, then renamed."""
    ends = links
    for end in "ab":
        own = labels.select(F.col("node").alias(end), F.col("component").alias(f"to_{end}"))
        ends = ends.join(own, end, "left")
    edges = ends.select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))
    roots = components(edges.where("a <> b").distinct())
    renamed = labels.join(roots.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left")
    renamed = renamed.select("node", F.coalesce("root", "component").alias("component"))
    return _gathered(renamed.unionByName(roots), "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Components of documents whose sets of 5-word shingles are alike: 100 * intersection >= 85 * union.

    Columns: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable), ``kept`` (the id is the
    component's), ``text_hash`` (xxhash64 of the text, to join decisions back). One row per input row. Words part at
    ASCII white space, A-Z are folded. A text of fewer words is one shingle; one without words, or NULL, is linked with
    nothing. Rows that repeat an id are one document, linked by what any of their texts is linked with. A NULL id is
    linked with nothing, its component is NULL and it is kept. An empty table gives no rows. Only id and text are read.

    A pair of likeness s shares a table key with probability (1 - (1 - s**3)**10)**2: 0.9998 at 0.85, more above it.
    Before sets are fetched, sketches are compared: 64 bits of minima, of which those of a pair at 0.85 differ in 4.8 on
    average and in more than 18 about once in a million pairs, those of a pair at 0.3 in 22; and the parities of 512
    classes of shingles. These differ in no more classes than there are shingles that only one of the sets has, so for
    linked sets in at most 15/185 of both sizes; sets of thousands of shingles fill the classes, there the expected
    number and five deviations is the bound.
    Equal sets always meet: they are one vertex.
    """
    rows = written(_rows(docs), "rows")
    linked = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = written(
        linked.groupBy("vertex").agg(
            F.first("n_shingles").alias("n"),  # equal within a vertex, as are the half keys
            F.first("halves").alias("halves"),
            F.min("doc_id").alias("id"),
            F.min(F.struct("doc_id", "text_hash")).alias("pick"),
        ),
        "classes",
    )
    members = written(_buckets(classes), "members")
    traits = _gathered(_traits(classes, members), "traits")
    wanted = traits.select("vertex", "doc_id", "text_hash")
    labels = _linked(members, traits, written(_sets(docs, wanted), "sets"))
    # an id with different texts ties their vertices together
    repeated = linked.groupBy("doc_id").agg(F.min("vertex").alias("low"), F.max("vertex").alias("high")).where("low <> high")
    ties = linked.join(repeated.select("doc_id", F.col("low").alias("a")), "doc_id").select("a", F.col("vertex").alias("b"))
    ties = written(ties.where("a <> b").distinct(), "ties")
    if not ties.isEmpty():
        labels = _merged(labels, ties)
    by_vertex = classes.select("vertex", "id").join(labels.withColumnRenamed("node", "vertex"), "vertex", "left")
    by_vertex = _gathered(by_vertex.select("vertex", "id", F.coalesce("component", "vertex").alias("component")), "labels")
    least = by_vertex.groupBy("component").agg(F.min("id").alias("component_id"))
    found = by_vertex.join(least, "component").select("vertex", "component_id")
    return (
        rows.withColumn("vertex", F.when(F.col("n_shingles") > 0, F.col("vertex")))  # NULL meets nothing
        .join(found, "vertex", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
            F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
            "text_hash",
        )
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents without near duplicates: one row of each component, all columns; NULL ids and empty texts stay.

    Rows that repeat an id: the one whose text hash is least stays, one of equal rows.
    """
    found = near_duplicates(docs)
    real = found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("text_hash").alias("_hash"), F.count("*").alias("_rows")
    )
    kept = real.select(F.col("doc_id").alias("_id"), "_hash", "_rows")
    stays = packed(docs).join(kept, ["_id", "_hash"])
    single = stays.where("_rows = 1").select("_row.*")
    repeated = stays.where("_rows > 1").dropDuplicates(["_id"]).select("_row.*")
    return single.unionByName(repeated).unionByName(docs.where("doc_id IS NULL"))
