"""Results do not depend on how a scan is split, even if that changes between the jobs of one operator."""

from __future__ import annotations

import random

import pytest

from creditspark.llm import credentials, decontam, language, neardup, passages, sharding
from creditspark.llm.tables import Scratch

from . import brute
from .test_cases import BASE, EDITED, PASSAGE, prose

ITEMS = [(1, PASSAGE)]
SECRET = "password=abcdefghijkl1 "
TEXTS = [prose(40 + i, 300 + i) for i in range(20)] + [BASE, EDITED, BASE]
TEXTS += [prose(20, 400 + i) + " " + PASSAGE for i in range(3)] + [SECRET + prose(30, 500 + i) for i in range(4)]


@pytest.fixture
def docs(spark, tmp_path):
    """Files of one row group each, so that a row's number follows the splits."""
    rows = list(enumerate(TEXTS))
    random.Random(1).shuffle(rows)
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def shifting(spark, monkeypatch):
    """More and more splits from write to write, as when executors join during a run."""
    put, write, turn = spark.conf.set, Scratch.write, iter(range(1, 10**6))

    def split():
        put("spark.sql.files.minPartitionNum", str(1 + 3 * next(turn)))

    def then_split(self, *args, **kwargs):
        out = write(self, *args, **kwargs)
        split()
        return out

    put("spark.sql.files.openCostInBytes", "0")
    monkeypatch.setattr(Scratch, "write", then_split)
    split()
    yield
    spark.conf.unset("spark.sql.files.minPartitionNum")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_near_duplicates(docs, shifting):
    expected = brute.near(TEXTS)
    found = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert [(found[i].n_shingles, found[i].component_id) for i in range(len(TEXTS))] == expected
    kept = {r.doc_id: r.text for r in neardup.deduplicated(docs).collect()}
    assert kept == {root: TEXTS[root] for _, root in expected}


def test_repeats(docs, shifting):
    found = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in passages.without_repeats(docs).collect()}
    assert [found[i] for i in range(len(TEXTS))] == brute.repeats(TEXTS)


def test_decontaminated(spark, docs, shifting):
    clean = decontam.decontaminated(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert {r.doc_id for r in clean.collect()} == {i for i, t in enumerate(TEXTS) if not brute.contamination(t, ITEMS)[1]}


def test_masked(docs, shifting):
    masked = {r.doc_id: r.text for r in credentials.redacted(docs).collect()}
    assert masked == {i: t.replace(SECRET, "[secret] ") for i, t in enumerate(TEXTS)}


def test_written_shards(spark, docs, shifting, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "shards"), 2000)
    written = spark.read.option("recursiveFileLookup", "true").schema(docs.schema).parquet(str(tmp_path / "shards"))
    found = [(r.doc_id, r.text) for r in written.collect()]
    assert sorted(found) == list(enumerate(TEXTS))
    where = spark.read.schema("doc_id long, text string, shard string").parquet(str(tmp_path / "shards"))
    shards = {r.doc_id: r.shard for r in sharding.shards(docs, 2000).select("doc_id", "shard").collect()}
    assert all(shards[r.doc_id].startswith(r.shard or "") for r in where.collect())


def test_language_samples(spark, shifting, tmp_path):
    syllables = {"aa": ["ka", "lo", "mi"], "bb": ["xu", "wy", "zo"]}
    r = random.Random(4)
    rows = [(i, lang, " ".join("".join(r.choice(syllables[lang]) for _ in range(3)) for _ in range(9))) for i in range(200) for lang in [sorted(syllables)[i % 2]]]
    rows += rows[:3]  # repeated texts are learned from once
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5).write.parquet(path)
    labelled = spark.read.parquet(path)
    scratch = Scratch(spark)
    model = language.train(labelled, scratch)
    assert model.languages == sorted(syllables)
    learned = spark.read.parquet(f"{scratch.folder}/texts").collect()
    assert sorted((x.lang, x.text) for x in learned) == sorted({(lang, text) for _, lang, text in rows})
    assert {x.n for x in learned if x.lang == "aa"} == {len({text for _, lang, text in rows if lang == "aa"})}
