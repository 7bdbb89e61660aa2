"""Registered queries of the text operators: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import credentials, decontam, language, merkle, neardup, packing, passages, pii, quality, runs, sharding, tokenfile, toxicity
from .spans import joined
from .tables import Scratch

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_pack(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def _counted(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Digest columns of a span operator: counts and hash of the strict spans, all spans as text."""
    strict = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(strict, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in kinds]
    return found.select(
        "doc_id", *counts, F.sha2(joined(strict).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


@query
def op2_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return _counted(pii.personal_data(table(spark, folder, "documents")), pii.STRICT)


@query
def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return _counted(credentials.secrets(table(spark, folder, "documents")), credentials.STRICT)


@query
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed", ",").alias("failed"),
    )


@query
def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards(table(spark, folder, "documents")).drop("_row")


@query
def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")
    )


@query
def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.severity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(table(spark, folder, "documents"))


@query
def op9_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = passages.without_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    where = f"{Scratch(spark).folder}/ids"
    tokenfile.write_ids(table(spark, folder, "documents"), tokenizer_path(), where)
    return tokenfile.read_documents(spark, where).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    columns = {c: F.col(c) for c in merkle.COLUMNS}
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.when(chosen, merkle.leaf(columns | {"n_chars": F.col("n_chars").cast("long") + 1}))
    found = merkle.manifest(table(spark, folder, "documents"), {"changed": changed})
    found = found.withColumn("folded_root", merkle.folded(F.coalesce("changed", "leaf"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("path"))).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _repeating(text: Column, doc_id: Column) -> Column:
    """The text of one in ten documents with a stretch of words that repeats to the end, others as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def of(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        word = lambda i: F.element_at(words, (F.when(i < a, i).otherwise(a + (i - a) % p) + 1).cast("int"))
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " "))

    found = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    changed = F.element_at(F.transform(F.array(found), of), 1)  # the words are found once
    return F.when(h % 10 == 0, F.coalesce(changed, text)).otherwise(text)


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = runs.periodic_runs(docs.select("doc_id", _repeating(F.col("text"), F.col("doc_id")).alias("text")))
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("first"), r["start"], r["length"], r["period"]))
    top = F.get(F.array_sort(order), F.lit(0))
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[top[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * top["length"] / top["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
