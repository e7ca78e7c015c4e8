"""Secret scans: candidate strings, and a random forest that removes false positives."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import sampled, written

LEAST_LENGTH = 16
LEAST_VALUE = 6
DICTIONARY_WORDS = 5_000
GRAM = 4
TRAIN_ROWS = 20_000
TRAIN_PARTS = 8
NAME_PART = 100
NEAR = 2 * NAME_PART + 40
TREES = 24
DEPTH = 6
KEEP_FROM = 0.5
# Words that name a secret, and parts of paths that hold examples.
KEY_WORDS = "token|secret|passw|passphrase|api[_ -]?key|access[_ -]?key|private[_ -]?key|credential|auth|bearer|apikey"
PATH_WORDS = "test|example|sample|mock|fixture|doc|readme"
# A name ends at its "="; one or two more pad a candidate where no value follows them.
_CANDIDATE = "[A-Za-z0-9+/_-]{%d,}(?:={1,2}(?![A-Za-z0-9+/_=-]|[\"'`][^\\s\"'`,;:)}\\]]))?" % LEAST_LENGTH
# The words of a private key block are marked, so that each line of it is known by itself; \n may be spelled out.
_MARK = "\ue000"
_BLOCK = (
    "(-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----|\\G(?!\\A)[A-Za-z0-9+/=:,-]++)((?:\\s|\\\\[nr])++)(?!-----)(?=[A-Za-z0-9+/=:,-])"
)
_LINE = "(?<=" + _MARK + ")[A-Za-z0-9+/=]+(?![A-Za-z0-9+/=:,-])"
# A value after the name of a secret: any visible characters, to its quote or to what ends an unquoted one. A name has
# at most NAME_PART characters on either side of its key word, so that a long run is not searched from each of its places.
_NAME = "[A-Za-z0-9_]{0,%d}?(?:%s)[A-Za-z0-9_.-]{0,%d}+[\"'`\\\\)\\]]{0,9}+" % (
    NAME_PART, KEY_WORDS.replace("|auth|", "|auth(?!ors?(?![A-Za-z]))|"), NAME_PART
)
_SET = "(?:=>|:?={1,3}|:)"
_GIVEN = "(?i:" + _NAME + "\\s*+(?:" + _SET + "\\s*+\\\\?[\"'`]?|(?<=\\s)[\"'`]))"
_LEAD = "(?i)" + _NAME + " ?(?:" + _SET + " )?$"
_VALUE = "(?:{}|(?<![\"'`])[^\\s\"'`,;&<>(){{}}\\[\\]\\\\]{{{n},}})".format(
    "|".join(f"(?<={q})[^\\s{q}]{{{LEAST_VALUE},}}" for q in "\"'`"), n=LEAST_VALUE
)
_FOUND = _GIVEN + _VALUE + "|" + _LINE + "|" + _CANDIDATE
_PLAIN = "^[A-Za-z0-9+/_=-]{%d,}$" % LEAST_LENGTH
# the text up to a candidate, the name it is given to, and the candidate: a value or another
_EACH = "(?s)(.*?)(?:(" + _GIVEN + ")(" + _VALUE + ")|(" + _LINE + "|" + _CANDIDATE + "))"
FEATURES = (
    "length", "transitions", "distinct", "digits", "uppers", "symbols", "hex", "coverage",
    "quoted", "assigned", "key_before", "key_near", "path_example", "path_depth", "word_after",
)


def candidates(docs: DataFrame, path_col: str | None = "source") -> DataFrame:
    """(doc_id, path, word_at, candidate, prefix, before, before2, after): long strings of key-like characters, and what
    is given to the name of a secret, to its quote or white space, from 6 characters on.

    One row for each of them, several to a word between white space, with the text before and after it: the neighbours of
    a word's first and last one are the words around, of the others those in the word. All words in a private key block
    are candidates. A NULL or empty text has none.
    """
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    text = F.coalesce("text", F.lit(""))
    text = F.when(text.contains("PRIVATE KEY-----"), F.regexp_replace(text, _BLOCK, "$1$2" + _MARK)).otherwise(text)
    keyed = F.col("keyed")
    rows = docs.select(
        "doc_id", path.alias("path"), F.split(text, "\\s+").alias("w"), text.rlike("(?i)" + KEY_WORDS).alias("keyed")
    )
    def before(i: Column, n: int) -> Column:
        return F.coalesce(F.get("w", i - n), F.lit(""))

    def joined(x: Column, i: Column) -> Column:
        """The word, after the name in front of it if it holds the value."""
        tail = F.right(F.concat_ws(" ", *[F.right(before(i, n), F.lit(NEAR)) for n in (3, 2, 1)], F.lit("")), F.lit(NEAR))
        lead = F.regexp_extract(tail, _LEAD, 0)
        near = before(i, 1).rlike("[:=>]$") | x.rlike("^[\"'`:=]")
        whole = F.when(keyed & (F.octet_length(x) >= LEAST_VALUE) & near, F.concat(lead, x))
        return F.when(whole.rlike("^" + _GIVEN + _VALUE), whole).otherwise(x)

    long = lambda x: F.octet_length(x) >= F.when(keyed, LEAST_VALUE).otherwise(LEAST_LENGTH)
    found = rows.select(
        "doc_id",
        "path",
        F.explode(
            F.filter(
                F.transform(
                    F.transform("w", joined),
                    lambda x, i: F.when(
                        (long(x) | x.contains(_MARK)) & x.rlike(_FOUND),
                        F.struct(
                            i.cast("long").alias("word_at"),
                            x.alias("word"),
                            before(i, 1).alias("before"),
                            before(i, 2).alias("before2"),
                            F.coalesce(F.get("w", i + 1), F.lit("")).alias("after"),
                        ),
                    ),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("f"),
    )
    part = lambda group: F.regexp_extract_all("f.word", F.lit(_EACH), F.lit(group))
    both = lambda x, y: F.zip_with(x, y, lambda a, b: F.concat(a, b))
    # a value in escaped quotes leaves the escape of the closing one
    values = F.transform(part(3), lambda v: F.regexp_replace(v, "\\\\+$", ""))
    matched = found.select("doc_id", "path", "f", both(part(1), part(2)).alias("p"), both(values, part(4)).alias("c"))
    each = F.transform(
        "c",
        lambda c, k: F.struct(
            c.alias("candidate"),
            F.get("p", k).alias("prefix"),
            F.when(k == 0, F.col("f.before")).otherwise(F.get("c", k - 1)).alias("before"),
            F.when(k == 0, F.col("f.before2")).otherwise(F.get("p", k - 1)).alias("before2"),
            F.coalesce(F.concat(F.get("p", k + 1), F.get("c", k + 1)), F.col("f.after")).alias("after"),
        ),
    )
    return matched.select("doc_id", "path", F.col("f.word_at").alias("word_at"), F.explode(each).alias("m")).select(
        "doc_id", "path", "word_at", "m.*"
    )


def dictionary(docs: DataFrame, limit: int = DICTIONARY_WORDS) -> list[str]:
    """Parts of 4 letters of the most frequent words over all documents.

    The words are counted over everything; at most ``limit`` of them reach the driver.
    """
    words = docs.select(F.explode(F.split(F.lower("text"), "[^\\p{L}]+")).alias("word"))
    counted = words.where(F.length("word") >= GRAM).groupBy("word").agg(F.count("*").alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(limit)
    return sorted({r.word[i : i + GRAM] for r in top.select("word").collect() for i in range(len(r.word) - GRAM + 1)})


def _share(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1))


def with_features(found: DataFrame, parts: list[str]) -> DataFrame:
    """The features of candidates: length, character transitions, dictionary coverage, path, neighbouring words."""
    c = F.col("candidate")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "0")
    kinds = F.regexp_replace(kinds, "[^aB0]", "s")
    # all runs of GRAM characters in one pass: a substring by place would start over at each
    grams = F.transform(F.regexp_extract_all(c, F.lit("(?s)(?=(.{%d}))" % GRAM), F.lit(1)), F.lower)
    covered = F.size(F.filter(grams, lambda g: g.isin(parts))) / F.greatest(F.size(grams), F.lit(1)) if parts else F.lit(0.0)
    near = F.concat_ws(" ", "before2", "before", "prefix")
    block = F.col("prefix").endswith(_MARK)
    path = F.coalesce("path", F.lit(""))
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    return found.select(
        "*",
        F.length(c).cast("double").alias("length"),
        ((F.length(F.regexp_replace(kinds, "(.)\\1+", "$1")) - 1) / F.length(c)).alias("transitions"),
        (F.size(F.array_distinct(F.split(c, ""))) / F.length(c)).alias("distinct"),
        _share(c, "[^0-9]").alias("digits"),
        _share(c, "[^A-Z]").alias("uppers"),
        _share(c, "[A-Za-z0-9]").alias("symbols"),
        flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hex"),
        covered.cast("double").alias("coverage"),
        flag(F.col("prefix").rlike("[\"'`]$")).alias("quoted"),
        flag(block | F.concat("before", "prefix").rlike("[:=]")).alias("assigned"),
        flag(block | F.lower(F.concat_ws(" ", "before", "prefix")).rlike(KEY_WORDS)).alias("key_before"),
        flag(block | F.lower(near).rlike(KEY_WORDS)).alias("key_near"),
        flag(F.lower(path).rlike(PATH_WORDS)).alias("path_example"),
        _share(path, "[^/]").alias("path_depth"),
        flag(F.col("after").rlike("^[A-Za-z]")).alias("word_after"),
    )


def labelled(found: DataFrame) -> DataFrame:
    """Findings with a certain label: 1 if a name of a secret is assigned a string of letters and digits, or if a private
    key block holds one (strings of key-like characters only); 0 for one without any digit or any letter, or in running text without an assignment, where no
    name of a secret stands in it or around it; the others have none and are left out."""
    c = F.col("candidate")
    block = F.col("prefix").endswith(_MARK)
    named = block | F.lower(F.concat_ws(" ", "before2", "before", "prefix")).rlike(KEY_WORDS)
    given = block | F.concat("before", "prefix").rlike("[:=]")
    mixed = c.rlike("[0-9]") & c.rlike("[A-Za-z]")
    around = named | F.lower(F.concat_ws(" ", "candidate", "after")).rlike(KEY_WORDS)
    label = F.when(named & given & mixed, 1.0).when((~mixed | ~given) & ~around, 0.0)
    return found.withColumn("label", label).where(F.col("label").isNotNull() & (block | c.rlike(_PLAIN)))


def train_forest(features: DataFrame, rows: int = TRAIN_ROWS) -> PipelineModel | None:
    """Fit the forest on labelled findings (a ``label`` column); ``rows`` bounds those of each label.

    Of more, the findings whose candidates hash lowest. None if one of the labels is missing. Of findings with one
    candidate the least features count, and rows are dealt out and ordered by candidate, so the forest is the same
    however the documents are partitioned.
    """
    least = features.groupBy("label", "candidate").agg(F.min(F.struct(*FEATURES)).alias("f"))
    parts = [sampled(least.where(F.col("label") == v), rows, "candidate") for v in (0.0, 1.0)]
    found = written(parts[0].union(parts[1]).select("candidate", "label", "f.*"), "findings")
    if found.select("label").distinct().count() < 2:
        return None
    train = found.repartition(TRAIN_PARTS, "candidate").sortWithinPartitions("candidate", "label")
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, maxMemoryInMB=64)
    return PipelineModel([assembler, forest.fit(assembler.transform(train))])


def secret_scan(docs: DataFrame, path_col: str | None = "source", findings: DataFrame | None = None) -> DataFrame:
    """Secrets in every whole text, with false positives marked by the forest.

    Columns: ``doc_id``, ``word_at`` (place of the word, from 0; candidates of one word share it), ``candidate_sha256``, ``length``, ``score`` (the
    forest's probability of a secret), ``secret`` (score >= 0.5), ``candidate``. One row for each candidate; documents
    without one, NULL and empty texts give none. ``findings``: labelled findings with the columns of ``candidates``
    and ``label``; without them those that :func:`labelled` is certain of. If they lack one of the labels, nothing can
    be told apart: every candidate scores 0.5 and stays. Repeated rows are scanned each. Other columns are not read.
    """
    parts = dictionary(docs)
    found = written(with_features(candidates(docs, path_col), parts), "candidates")
    model = train_forest(labelled(found) if findings is None else with_features(findings, parts))
    if model is None:
        scored = found.withColumn("score", F.lit(0.5))
    else:
        scored = model.transform(found).withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        "doc_id",
        "word_at",
        F.sha2(F.col("candidate").cast("binary"), 256).alias("candidate_sha256"),
        F.col("length").cast("long").alias("length"),
        "score",
        (F.col("score") >= KEEP_FROM).alias("secret"),
        "candidate",
    )
