"""A training-text pipeline: five stages, each one of the text operators with its decisions applied.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as
Parquet and reads again as the next stage's ``docs``. All but the last return the columns of
``documents``. Null texts, repeated rows, null ids and further columns pass through as the
operators define; an empty table stays empty.

1. toxicity: documents whose chance of being toxic reaches one half go.
2. near_duplicates: one document of each group of near duplicates stays.
3. decontamination: documents that are contaminated by the benchmark go.
4. secrets: every reported secret is replaced by a mark; no document goes.
5. packing: the texts become pieces of windows of 1024 token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspark.llm import credentials, decontam, neardup, packing, toxicity
from creditspark.llm.queries import table, tokenizer_path
from creditspark.llm.tables import Scratch


# Intermediate tables of the stage before; its output was written and reread when the next stage begins.
_before: list[Scratch] = []


def _scratch(spark: SparkSession) -> Scratch:
    """Tables of a stage, after those of the stage before were dropped. Stages run one after the other."""
    while _before:
        old = _before.pop()
        if old.spark is spark:
            old.keep()
    _before.append(Scratch(spark))
    return _before[-1]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), scratch=_scratch(spark))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs, scratch=_scratch(spark))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"), _scratch(spark))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return credentials.redacted(docs, scratch=_scratch(spark))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, tokenizer_path(), scratch=_scratch(spark))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_windows),
]

# A fitted model and min-hash signatures have no counterpart in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; returns the packed pieces."""
    scratch = Scratch(spark)
    docs, last = table(spark, sf_dir, "documents"), ()
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop(*last)
        last = (name,)
    return docs
