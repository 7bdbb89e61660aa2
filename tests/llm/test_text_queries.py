"""Registered text queries against their SQL and against brute force, and the pipeline stage by stage."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from creditspark.llm import neardup
from creditspark.llm.oracles import ORACLES
from creditspark.llm.queries import QUERIES

from .. import compare
from . import brute

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def connection():
    return compare.duck(FOLDER)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


def test_registration():
    names = set(entry_module.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) is None


def test_spans(spark, texts):
    for r in QUERIES["op2_personal_data"](spark, FOLDER).collect():
        spans = brute.personal(texts[r.doc_id])
        assert r.base_sha256 == brute.sha(brute.joined(spans))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in brute.KINDS)
    for r in QUERIES["op3_secrets"](spark, FOLDER).collect():
        assert r.base_sha256 == brute.sha(brute.joined(brute.secrets(texts[r.doc_id])))


def test_repeated_passages(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op9_repeated_passages"](spark, FOLDER).collect()}
    order = sorted(texts)
    import hashlib

    for d, (n, removed, spans, kept) in zip(order, brute.repeats([texts[d] for d in order])):
        r = found[d]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, hashlib.sha256(kept).hexdigest())


def test_language_accuracy(spark, texts):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in QUERIES["op10_language"](spark, FOLDER).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_toxicity_leaves_clean_documents(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    found = QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.01").collect()
    clean = [r for r in found if labels.get(r.doc_id) == 0]
    toxic = [r for r in found if labels.get(r.doc_id) == 1]
    assert sum(r.rejected for r in clean) <= 0.01 * len(clean)
    assert sum(r.rejected for r in toxic) >= 0.8 * len(toxic)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    scratch = corpus_pipeline.Scratch(spark)
    before = {r.doc_id: r.text for r in docs.collect()}
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = scratch.write(stage(spark, at, FOLDER), name)
        assert at.columns == docs.columns
        after = {r.doc_id: r.text for r in at.collect()}
        assert set(after) <= set(before)
        if name == "toxicity":
            clean = [d for d in before if labels.get(d) == 0]
            assert sum(d in after for d in clean) >= 0.99 * len(clean)
        if name == "near_duplicates":
            order = sorted(before)
            roots = {order[root] for _, root in brute.near([before[d] for d in order])}
            assert set(after) == roots
        if name == "decontamination":
            hit = {d: brute.contamination(t, items) for d, t in before.items()}
            assert set(after) == {d for d, (n, h, _) in hit.items() if not (h and 20 * h >= n)}
        if name == "secrets":
            assert set(after) == set(before)
            assert not any(brute.secrets(t) for t in after.values())
            assert all(after[d] == t for d, t in before.items() if not brute.secrets(t) and "[secret]" not in after[d])
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, at, FOLDER).collect()
    assert {p.doc_id for p in pieces} == set(before)
    assert neardup.PERCENT == 75
