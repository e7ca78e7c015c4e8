"""The pipeline against a plain version of its stages, and the contract's entries."""

from __future__ import annotations

import hashlib

import numpy as np

import __spark_entry__ as contract
import corpus_pipeline
from tests import oracle
from tests.llm import data
from tests.llm.test_operators import groups, hits
from tickloom.llm import language, pii
from tickloom.llm.queries import ORACLES, QUERIES, tokenizer


def test_stages(spark, sf_dir):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    model = language.train_language(docs)
    good = {r.doc_id for r in language.languages(docs, model).collect() if r.lang_pred != "und" and r.score >= 0.3}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    of = groups(rows)
    rows = [(i, t) for i, t in rows if of[i] == i]
    rows = [(i, t) for i, t, w, hit, _ in hits(rows, bench) if not (hit and 20 * len(hit) >= len(w))]
    kept = docs.where(docs.doc_id.isin([i for i, _ in rows]))
    field = pii.train_pii(kept)
    library = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    expected = set()
    for i, text in rows:
        ids = library.encode(pii.redacted(text, pii.all_spans(text, field)[1]), add_special_tokens=False).ids
        expected.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), np.array(ids, "<u4").tobytes()))
    found = {(r.doc_id, r.n_tokens, r.ids_sha256, bytes(r.packed_ids)) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert found == expected


def test_stages_keep_columns_and_meet_odd_rows(spark, tmp_path):
    docs = data.documents(spark)
    data.benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
    empty = data.documents(spark, [])
    assert all(stage(spark, empty, str(tmp_path)).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_sql(spark, sf_dir):
    con = oracle.connect(sf_dir)
    for name, sql in ORACLES.items():
        _, fault = oracle.compare(spark, con, QUERIES[name], sql, sf_dir)
        assert not fault, name


def test_registered():
    names = {n.partition("_")[0] for n in contract.queries()}
    assert {f"op{i}" for i in range(1, 11)} <= names and "pipeline" in contract.queries()
