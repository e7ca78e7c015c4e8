"""Checked queries of the operators, each over its whole table, and SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import (
    bpe,
    decontaminate,
    fingerprints,
    language,
    licenses,
    near_dups,
    phrases,
    pii,
    quality,
    secrets,
    sentence_pieces,
    token_counts,
    whitening,
)
from tickloom.llm.common import read_table
from tickloom.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_counts(spark, sf_dir):
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op2_quality(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.train_quality(docs, read_table(spark, sf_dir, "labels")))


@query
def op3_near_dups(spark, sf_dir):
    return near_dups.near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_hash")


@query
def op4_decontaminate(spark, sf_dir):
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, benchmark).drop("text_hash")


@query
def op5_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(read_table(spark, sf_dir, "documents"))


@query
def op6_secrets(spark, sf_dir):
    return secrets.secret_scan(read_table(spark, sf_dir, "documents")).drop("candidate")


@query
def op7_bpe(spark, sf_dir):
    return bpe.bpe_round_trip(read_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op8_language(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return language.languages(docs, language.train_language(docs)).select("doc_id", "held_out", "lang_pred", "score")


@query
def op9_licenses(spark, sf_dir):
    return licenses.license_scan(read_table(spark, sf_dir, "documents")).drop("findings")


@query
def op10_pii(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return pii.pii_spans(docs, pii.train_pii(docs)).drop("redacted")


@query
def op11_sentence_pieces(spark, sf_dir):
    return sentence_pieces.sentence_piece_round_trip(read_table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op12_phrases(spark, sf_dir):
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


@query
def op13_whitening(spark, sf_dir):
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"))


ORACLES["op4_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, w[i:i + least(len(w), 13) - 1] AS gram
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM grams),
hits AS (
  SELECT p.doc_id, p.i, p.size, g.item_id
  FROM (SELECT doc_id, size, i, w[i:i + size - 1] AS gram
        FROM (SELECT d.doc_id, d.w, s.size, unnest(range(1, len(d.w) - s.size + 2)) AS i FROM d, sizes s)) p
  JOIN grams g ON p.size = g.size AND p.gram = g.gram),
words AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256,
  coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op3_near_dups"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, w[i:i + least(len(w), 5) - 1] AS g
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  WHERE 100 * least(p.n, q.n) >= 85 * greatest(p.n, q.n)
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON least_of.a = d.doc_id
"""

ORACLES["op12_phrases"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM w GROUP BY lang),
f AS (
  SELECT lang, w[i:i + k - 1] AS g, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) sizes(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, g, f AS a FROM f WHERE len(g) > 1),
inner_of AS (
  SELECT lang, g[i:j] AS g, max(a) AS longer
  FROM (SELECT lang, g, a, i, unnest(range(i, len(g) + 1)) AS j FROM (SELECT lang, g, a, unnest(range(1, len(g) + 1)) AS i FROM c))
  WHERE j - i + 1 < len(g) GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN inner_of o USING (lang, g) WHERE o.longer IS NULL OR 100 * o.longer < 100 * c.a),
cut AS (
  SELECT k.lang, k.g, k.a, k.k, x.f AS l, y.f AS r, t.n,
    (CAST(1000 AS HUGEINT) * k.a * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM kept) k
  JOIN f x ON x.lang = k.lang AND x.g = k.g[1:k.k] JOIN f y ON y.lang = k.lang AND y.g = k.g[k.k + 1:] JOIN totals t ON t.lang = k.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS first FROM cut),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank,
    array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM best WHERE first = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
