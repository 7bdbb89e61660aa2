"""Benchmarks with repeated rows, two texts under one id, and null ids."""

from __future__ import annotations

import duckdb
import pytest

from creditspark.llm import decontam
from creditspark.llm.oracles import ORACLES
from creditspark.llm.queries import QUERIES

from .. import compare
from . import brute
from .test_cases import prose

A, B, C, D = (prose(n, 600 + n) for n in (30, 16, 13, 25))
ITEMS = [(1, A), (1, A), (2, B), (2, C), (None, D), (None, D), (3, A), (4, "Two words"), (4, "two WORDS"), (5, None), (6, "."), (7, "ka " * 20)]
TEXTS = [None, "", A, B, C, D, f"{prose(20, 1)} {A} {prose(20, 2)} {D}", f"x {B} y", f"x {C} y", "say two words", prose(40, 3), "ka " * 40]


@pytest.mark.parametrize("most", [decontam.FILTER_WORDS, 1])
def test_items_are_all_found(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(decontam, "FILTER_WORDS", most)
    rows = list(enumerate(TEXTS))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").repartition(2).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, items = (spark.read.parquet(str(tmp_path / f"{n}.parquet")) for n in ("documents", "benchmark"))
    for r in decontam.contamination(docs, items).collect():
        words, hit, ids = brute.contamination(TEXTS[r.doc_id], ITEMS)
        assert (r.n_words, r.n_hit) == (words, hit)
        assert r["items"] == [x for x in ids if x != "None"] + [None] * ("None" in ids)
        assert r.contaminated == (hit > 0 and 20 * hit >= words)
    sql = duckdb.connect()
    for name in ("documents", "benchmark"):
        sql.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert compare.differences(QUERIES["op8_decontaminate"](spark, str(tmp_path)), sql, ORACLES["op8_decontaminate"]) is None
