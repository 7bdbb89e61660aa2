"""Quality rules with thresholds learned per language and source.

Every document gets a few measures. Each measure of each (language, source) is summarised in
a mergeable quantile sketch: counts per bucket, where a bucket holds integers that agree in
their first six binary digits, so any quantile is known within 1/32 and two sketches merge by
adding counts. A group with few documents takes the merged sketch of its language, a language
with few documents that of the whole corpus. A measure fails beyond the upper quartile plus a
multiple of the quartile distance, and at least a set margin beyond the median, so the limits
follow the group and groups without outliers lose nothing. Documents are then joined with
their group's limits.

Null and empty texts have no words and fail. Null languages and sources are groups like others.
Repeated rows count as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Scratch, join_small

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_GROUP = 200
SPREADS = 6
# Measures in parts of 10,000 (word length in hundredths) and the least margin above the median.
MEASURES = {"word_length": 1500, "symbols": 300, "capitals": 4000, "dup_lines": 4000, "repeats": 3000}

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACE = r"[\x20\x09-\x0D]+"


def measures(docs: DataFrame) -> DataFrame:
    """Counts of each row, from built-in functions on the row's own text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", "lang", "source", text.alias("text")).select(
        "doc_id", "lang", "source", "text",
        F.filter(F.split("text", _SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    counted = base.select(
        "doc_id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.translate("text", CAPITALS, ""))).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size("words") - WINDOW + 1), lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
        ).alias("windows"),
    )
    # Windows found twice stand side by side when sorted with their places.
    again = F.size("windows") > F.size(F.array_distinct("windows"))
    ranked = counted.select(
        "*", F.when(again, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("ranked")
    ).drop("windows")
    twin = lambda x, j: (F.get("ranked", j - 1)["h"] == x["h"]) | (F.get("ranked", j + 1)["h"] == x["h"])
    places = F.transform(F.filter("ranked", lambda x, j: F.coalesce(twin(x, j), F.lit(False))), lambda x: x["i"])
    placed = ranked.select("*", F.sort_array(places).alias("places")).drop("ranked")
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda a, p: F.struct((p + WINDOW).alias("end"), (a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n"))
    covered = F.aggregate("places", begin, step, lambda a: a["n"])
    return placed.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).drop("places")


def scaled() -> dict[str, Column]:
    """The measures as whole numbers, for sketches without rounding of doubles."""
    part = lambda n, of: F.expr(f"({n} * 10000) div greatest({of}, 1)")
    return {
        "word_length": F.expr("(word_chars * 100) div greatest(n_words, 1)"),
        "symbols": part("n_symbols", "word_chars"),
        "capitals": part("n_capitals", "word_chars"),
        "dup_lines": part("n_dup_lines", "n_lines"),
        "repeats": part("n_repeat_words", "n_words"),
    }


def bucket(x: Column) -> Column:
    """The least number with the same length and first six binary digits."""
    width = F.greatest(F.length(F.bin(x)) - 6, F.lit(0))
    return F.when(width > 0, x - F.pmod(x, F.pow(F.lit(2), width).cast("long"))).otherwise(x)


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, measure, n, q25, q50, q75)`` from bucket counts."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    running = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("total", F.sum("n").over(group))
    at = lambda p: F.min(F.when(100 * F.col("upto") >= p * F.col("total"), F.col("bucket"))).alias(f"q{p}")
    return running.groupBy(*by, "measure").agg(F.max("total").alias("n"), at(25), at(50), at(75))


def limits(sketch: DataFrame) -> DataFrame:
    """``(lang, source)`` and the greatest allowed value of each measure, one row per group."""
    own = quantiles(sketch, ["lang", "source"]).alias("o")
    lang = quantiles(sketch, ["lang"]).alias("l")
    whole = quantiles(sketch, []).alias("w")
    joined = own.join(
        lang, F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.measure") == F.col("l.measure"))
    ).join(whole, F.col("o.measure") == F.col("w.measure"))
    def q(name: str) -> Column:
        own, lang, whole = F.col(f"o.{name}"), F.col(f"l.{name}"), F.col(f"w.{name}")
        return F.when(F.col("o.n") >= MIN_GROUP, own).when(F.col("l.n") >= MIN_GROUP, lang).otherwise(whole)
    fence = q("q75") + SPREADS * (q("q75") - q("q25"))
    margin = F.coalesce(*[F.when(F.col("o.measure") == m, q("q50") + least) for m, least in MEASURES.items()])
    chosen = joined.select("o.lang", "o.source", "o.measure", F.greatest(fence, margin).alias("most"))
    return chosen.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("measure") == m, F.col("most"))).alias(f"most_{m}") for m in MEASURES]
    )


def judged(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Per row the counts, ``base_failed``, ``failed`` (names of failing measures) and ``kept``."""
    scratch = scratch or Scratch(docs.sparkSession)
    counts = scratch.write(measures(docs), "measures")
    values = scaled()
    long = counts.where("n_words > 0").select(
        "lang", "source",
        F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(x).alias("bucket")) for m, x in values.items()])).alias("x"),
    ).select("lang", "source", "x.*")
    sketch = scratch.write(long.groupBy("lang", "source", "measure", "bucket").agg(F.count(F.lit(1)).alias("n")), "sketch")
    allowed = scratch.write(limits(sketch), "limits").select(
        F.struct("lang", "source").alias("group"), *[f"most_{m}" for m in MEASURES]
    )
    # Null-safe on both parts: a struct of nulls is itself not null.
    keyed = counts.withColumn("group", F.struct("lang", "source"))
    allowed = allowed.withColumnRenamed("group", "of_group")
    joined = join_small(keyed, allowed, F.col("group").eqNullSafe(F.col("of_group")), "left", 100).drop("group", "of_group")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    over = [F.when(x > F.col(f"most_{m}"), F.lit(m)) for m, x in values.items()]
    return joined.select(
        *counts.columns, base.alias("base_failed"), F.array_compact(F.array(*over)).alias("failed")
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
