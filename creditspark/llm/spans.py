"""Spans found by patterns, with places in code points, from built-in functions only.

The matches of a pattern and the stretches between them come from two built-in
functions; the running sum of their lengths gives every place. One scan writes
the few matches of each document, and all further work reads that narrow table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Scratch, row_of

CONTEXT = 40


@dataclass(frozen=True)
class Pattern:
    """A Java pattern; ``needs`` is a cheap text that any match contains."""

    kind: str
    pattern: str
    needs: str | None = None


def find_spans(docs: DataFrame, patterns: Sequence[Pattern], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(_row, doc_id)`` of all rows, and ``(_row, kind, start, end, value, before, after)`` of all
    matches, leftmost and without overlap within a kind; ``before`` and ``after`` are the
    nearest characters up to the neighbouring match."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(row_of(docs).alias("_row"), "doc_id", text.alias("text"))
    none = F.array().cast("array<string>")
    matched = base.select("*", *[
        (F.when(F.contains("text", F.lit(p.needs)), F.regexp_extract_all("text", F.lit(p.pattern), F.lit(0))).otherwise(none)
         if p.needs else F.regexp_extract_all("text", F.lit(p.pattern), F.lit(0))).alias(f"m{i}")
        for i, p in enumerate(patterns)
    ])

    def parts(i: int, p: Pattern) -> Column:
        between = F.transform(
            F.split("text", p.pattern, -1),
            lambda g: F.struct(
                F.length(g).cast("long").alias("n"), F.right(g, F.lit(CONTEXT)).alias("tail"), F.left(g, F.lit(CONTEXT)).alias("head")
            ),
        )
        return F.when(F.size(f"m{i}") > 0, F.struct(F.lit(p.kind).alias("kind"), F.col(f"m{i}").alias("matches"), between.alias("between")))

    found = F.filter(F.array(*[parts(i, p) for i, p in enumerate(patterns)]), lambda x: x.isNotNull())
    raw = scratch.write(matched.select("_row", "doc_id", found.alias("found")), "matches")
    each = raw.select("_row", F.explode("found").alias("f")).select(
        "_row", "f.kind",
        F.posexplode(F.arrays_zip(F.col("f.matches").alias("value"), F.col("f.between").alias("gap"),
                                  F.slice("f.between", 2, F.size("f.matches")).alias("next"))).alias("i", "x"),
    ).where(F.col("x.value").isNotNull())
    so_far = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    length = F.length("x.value").cast("long")
    end = F.sum(F.col("x.gap.n") + length).over(so_far)
    spans = each.select("_row", "kind", (end - length).alias("start"), end.alias("end"), F.col("x.value").alias("value"),
                        F.col("x.gap.tail").alias("before"), F.col("x.next.head").alias("after"))
    return raw.select("_row", "doc_id"), spans


def rank_of(kind: Column, kinds: Sequence[str]) -> Column:
    """Place of a kind in the list, for sorting."""
    result = F.lit(len(kinds))
    for i, k in enumerate(kinds):
        result = F.when(kind == k, i).otherwise(result)
    return result


def joined(spans: Column) -> Column:
    """Sorted span structs as ``kind:start:end`` texts joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
