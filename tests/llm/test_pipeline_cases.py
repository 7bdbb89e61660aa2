"""The whole pipeline on nulls, odd texts, repeated rows, clashing columns, and on an empty table; stages against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from creditspark.llm import toxicity
from creditspark.llm.tables import Scratch, numbered, row_name

from . import brute
from .test_cases import ITEMS, ROWS, prose

# Names that stages use inside, and those of their results.
CLASHING = ["__llm_row", "__llm_row_", "__llm_spans", "_row", "p_toxic", "expected_severity", "spans", "node", "code", "window", "gone", "found"]
TOXIC = "vile rotten"


def folder_of(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [(i, t, "xx" if k % 2 else None, None if k % 3 else "s", len(t or "")) for k, (i, t) in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for k, c in enumerate(CLASHING):
        df = df.withColumn(c, F.lit(k) if k % 2 else F.lit("other"))
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i >= 1100)) for i in range(1000, 1200)] + [(1100, 1), (None, 1), (10**9, 1), (1003, None)]
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


@pytest.fixture
def folder(spark, tmp_path):
    r = random.Random(8)
    long = " ".join(f"{r.choice('abcdefgh')}{i % 70_000}" for i in range(800_000))  # about 5 MB
    rows = [*ROWS, (500, long), (501, long)]
    rows += [(1000 + i, prose(20, 5000 + i) + (f" {TOXIC} " if i >= 100 else " fine weather ") + prose(20, 7000 + i)) for i in range(200)]
    return folder_of(spark, tmp_path, rows)


def test_every_stage_on_odd_rows(spark, folder):
    at = spark.read.parquet(f"{folder}/documents.parquet")
    columns, scratch = at.columns, Scratch(spark)
    rows = at.select("doc_id", "text").collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = scratch.write(stage(spark, at, folder), name)
        assert at.columns == columns
        now = at.collect()
        for k, c in enumerate(CLASHING):
            assert {x[c] for x in now} == {k if k % 2 else "other"}
        if name == "toxicity":
            gone = {x.doc_id for x in rows} - {x.doc_id for x in now}
            assert gone == set(range(1100, 1200))
        elif name == "near_duplicates":
            assert len(now) == len({root for _, root in brute.near([x.text for x in rows if len(x.text or "") < 10**6])}) + 1
        elif name == "decontamination":
            hits = [brute.contamination(x.text, ITEMS) for x in rows if len(x.text or "") < 10**6]
            assert len(now) == len(rows) - sum(h > 0 and 20 * h >= n for n, h, _ in hits)
        else:
            assert len(now) == len(rows) and not any(brute.secrets(x.text) for x in now)
        rows = now
    pieces = corpus_pipeline.STAGES[-1][1](spark, at, folder).collect()
    assert sorted({str(p.doc_id) for p in pieces}) == sorted({str(x.doc_id) for x in rows})


def test_run(spark, folder):
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {p.doc_id for p in pieces} >= {500, 1000, 1099} and not {p.doc_id for p in pieces} & {501, 1100, 1199}


def test_run_on_an_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder_of(spark, tmp_path, [])).count() == 0


def test_row_numbers_beside_a_column_of_that_name(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 7), (2, "b", 7)], "doc_id long, text string, __llm_row long")
    first = numbered(df, Scratch(spark))
    assert row_name(df) is None and row_name(first) == "__llm_row_"
    assert numbered(first, Scratch(spark)) is first
    assert len({r["__llm_row_"] for r in first.collect()}) == 2 and {r["__llm_row"] for r in first.collect()} == {7}


def test_severity_of_a_dense_model():
    """Scores of texts in blocks equal those of a dense matrix product."""
    import numpy as np
    import pyarrow as pa

    texts = [prose(30, i) + (f" {TOXIC}" * (i % 5)) for i in range(40)] + [None, "", TOXIC * 2]
    data, offsets = toxicity.tc.text_bytes(pa.array(texts))
    row, code = toxicity.features(data, offsets)
    codes = np.unique(code)[::3]
    r = np.random.default_rng(2)
    model = toxicity.OrdinalModel(codes, r.random(len(codes)), np.array([1.0, 4.0]))
    counts = np.zeros((len(texts), len(codes)))
    for i, c in zip(row.tolist(), code):
        k = int(np.searchsorted(codes, c))
        if k < len(codes) and codes[k] == c:
            counts[i, k] += 1
    score = np.where(counts > 0, 1 + 0.2 * np.log2(np.maximum(counts, 1)), 0) @ model.weights
    expected = 1 / (1 + np.exp(model.thresholds[None, :] - score[:, None]))
    assert np.allclose(toxicity.chances(model, pa.array(texts)), expected, atol=1e-6)
