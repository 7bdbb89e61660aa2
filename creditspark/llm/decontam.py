"""Benchmark decontamination by a prefix-filtered set join.

A window is 13 consecutive words of a benchmark item (the whole item where it is
shorter). Its set is the set of its five-word shingles. A document can only hold
the window if it holds the window's rarest shingle, so that one shingle, the
prefix, is joined; the word position it is found at fixes where the window would
have to start, which gives the positional and length bounds; what is left is
verified shingle by shingle.

Windows are told apart by their content, so each is looked for once however many
items, repeated rows or texts of one id hold it; their ids are attached after the search.

Null, empty and word-less texts have no words and no hits, on either side. Items
with equal text each count, repeated rows of one item count once, and a null item id
counts as one item (it has no text in a joined list). Repeated document rows each get
their own row of the result, null ids included. Empty tables give empty results or zero hits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textcodes as tc
from .tables import Scratch, back_to, join_small, numbered, returning, row_of

WINDOW = 13
SHINGLE = 5
# The filter of benchmark shingles in the scan: bits per shingle, and the most 64-bit words it may take.
# It only thins out what is joined; a benchmark beyond its size lets more shingles pass.
FILTER_BITS = 16
FILTER_WORDS = 1 << 20

_WINDOWS = "item_id string, n_words int, needed array<long>"
_HITS = "_row long, doc_id {kind}, n_words long, at array<long>, codes array<long>"


def _filter_words(distinct: DataFrame) -> np.ndarray:
    """Bloom filter of the codes, two bits each, in a power of two of words; put together by an aggregation."""
    n = distinct.count()
    size = min(FILTER_WORDS, 1 << max(0, (n * FILTER_BITS // 64).bit_length()))
    places = F.explode(F.array(*[F.shiftrightunsigned(F.col("code"), k) for k in (8, 32)]))
    bits = distinct.select(places.alias("p")).select(
        F.shiftright("p", 6).bitwiseAND(F.lit(size - 1)).alias("word"), F.expr("shiftleft(1L, cast(p & 63 AS int))").alias("bit")
    )
    found = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(size, np.uint64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return words


def _passes(words: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether each code may be in the filter."""
    hit = np.ones(len(codes), bool)
    for k in (8, 32):
        p = codes >> np.uint64(k)
        word = words[((p >> np.uint64(6)) & np.uint64(len(words) - 1)).astype(np.int64)]
        hit &= ((word >> (p & np.uint64(63))) & np.uint64(1)).astype(bool)
    return hit


def _windows(batches):
    """Rows (item, words, shingle codes in order), one per window."""
    for batch in batches:
        data, offsets = tc.text_bytes(batch.column("text"))
        _, _, row, code = tc.words(data, offsets, tc.ALNUM)
        counts = np.bincount(row, minlength=len(batch))
        firsts = np.concatenate([[0], np.cumsum(counts)])
        out = {name: [] for name in ("item", "n_words", "n_shingles", "code")}
        for i, n in enumerate(counts):
            if not n:
                continue
            length, size = min(n, WINDOW), min(n, SHINGLE)
            _, codes = tc.shingles(code[firsts[i] : firsts[i + 1]], np.zeros(n, np.int8), size)
            starts = np.arange(n - length + 1)
            own = length - size + 1
            out["item"].append(np.full(len(starts), i))
            out["n_words"].append(np.full(len(starts), length))
            out["n_shingles"].append(np.full(len(starts), own))
            out["code"].append(codes[(starts[:, None] + np.arange(own)).ravel()])
        if not out["item"]:
            continue
        got = {name: np.concatenate(parts) for name, parts in out.items()}
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item_id").take(pa.array(got["item"])),
                pa.array(got["n_words"].astype(np.int32)),
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(got["n_shingles"])]).astype(np.int32)), pa.array(got["code"].view(np.int64))
                ),
            ],
            ["item_id", "n_words", "needed"],
        )


def _find(wanted: np.ndarray, sizes: list[int]):
    """Per document: words, and positions and codes of the shingles that pass the filter ``wanted``."""

    def run(batches):
        for batch in batches:
            data, offsets = tc.text_bytes(batch.column("text"))
            n_words = np.zeros(len(batch), np.int64)
            at, codes = [[] for _ in range(len(batch))], [[] for _ in range(len(batch))]
            for i, j in tc.row_blocks(offsets):
                _, _, row, code = tc.words(data, offsets[i : j + 1], tc.ALNUM)
                counts = np.bincount(row, minlength=j - i)
                n_words[i:j] = counts
                firsts = np.concatenate([[0], np.cumsum(counts)])
                for size in sizes:
                    where, found = tc.shingles(code, row, size)
                    hit = _passes(wanted, found)
                    where, found = where[hit], found[hit]
                    for r in np.unique(row[where]):
                        own = row[where] == r if len(where) < 64 else slice(*np.searchsorted(row[where], [r, r + 1]))
                        at[i + r].append(where[own] - firsts[r])
                        codes[i + r].append(found[own].view(np.int64))
            lists = [
                pa.array([np.concatenate(x) if x else np.zeros(0, kind) for x in parts], pa.list_(to))
                for parts, kind, to in ((at, np.int64, pa.int64()), (codes, np.int64, pa.int64()))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("doc_id"), pa.array(n_words), *lists],
                ["_row", "doc_id", "n_words", "at", "codes"],
            )

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Per document row: ``_row``, ``doc_id``, ``n_words``, ``n_hit`` (words inside an occurring
    window), ``items`` (their ids as sorted strings, a null id last) and ``contaminated``
    (``n_hit > 0 and 20 * n_hit >= n_words``)."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    owned = scratch.write(items.mapInArrow(returning(_windows), _WINDOWS).distinct(), "owned")
    contents = owned.select("n_words", "needed").distinct()
    contents = scratch.write(contents.withColumn("window", F.monotonically_increasing_id()), "contents")
    owners = scratch.write(owned.join(contents, ["n_words", "needed"]).select("window", "item_id"), "owners")
    windows = contents.select("window", "n_words", F.size("needed").alias("n_shingles"), F.posexplode("needed").alias("k", "code"))
    sizes = [r[0] for r in contents.select(F.least("n_words", F.lit(SHINGLE))).distinct().collect()]
    wanted = _filter_words(windows.select("code").distinct())
    has_id = docs.select(row_of(docs).alias("_row"), "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    hits = has_id.mapInArrow(returning(_find(wanted, sizes)), _HITS.format(kind=kind))
    hits = scratch.write(hits, "hits")

    flat = hits.where(F.size("codes") > 0).select(
        "_row", "n_words", F.explode(F.arrays_zip("at", "codes")).alias("hit")
    ).select("_row", F.col("n_words").alias("doc_words"), F.col("hit.at").alias("at"), F.col("hit.codes").alias("code"))

    # Rarity over all documents; a window with a shingle found nowhere cannot occur.
    rarity = flat.groupBy("code").agg(F.count(F.lit(1)).alias("found"))
    tokens = windows.join(rarity, "code")
    per_window = Window.partitionBy("window")
    by_rarity = per_window.orderBy("found", "code", "k")
    prefix = (
        tokens.withColumn("present", F.count(F.lit(1)).over(per_window))
        .where(F.col("present") == F.col("n_shingles"))
        .withColumn("rank", F.row_number().over(by_rarity))
        .where("rank = 1")
        .select("window", "n_words", "n_shingles", F.col("k").alias("prefix_k"), "code")
    )
    prefix = scratch.write(prefix.join(contents.select("window", "needed"), "window"), "prefix")

    # Join the prefix only, then bounds on where the window would lie, then the whole window, shingle by shingle.
    candidates = (
        join_small(flat, prefix, "code", "inner", 160)
        .withColumn("start", F.col("at") - F.col("prefix_k"))
        .where((F.col("start") >= 0) & (F.col("start") + F.col("n_words") <= F.col("doc_words")))
        .select("_row", "window", F.col("n_words").alias("window_words"), "n_shingles", "start", F.posexplode("needed").alias("k", "code"))
        .withColumn("at", F.col("start") + F.col("k"))
    )
    matched = candidates.join(flat.select("_row", "at", "code"), ["_row", "at", "code"])
    found = matched.groupBy("_row", "window", "start", "window_words", "n_shingles").agg(F.count(F.lit(1)).alias("n")).where("n = n_shingles")
    found = scratch.write(found.select("_row", "window", "start", "window_words"), "found")

    spans = found.groupBy("_row", "start").agg(F.max(F.col("start") + F.col("window_words")).alias("end"))
    before = Window.partitionBy("_row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    covered = spans.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", reached)))
    n_hit = covered.groupBy("_row").agg(F.sum("new").cast("long").alias("n_hit"))
    held = found.select("_row", "window").distinct().join(owners, "window").select("_row", "item_id").distinct()
    # A list of structs, as a list of the ids alone would leave a null id out.
    held = held.groupBy("_row").agg(F.collect_list(F.struct("item_id")).alias("ids"))
    held = held.select("_row", F.array_sort(F.transform("ids", lambda x: x["item_id"])).alias("items"))
    result = (
        hits.select("_row", "doc_id", "n_words")
        .join(n_hit.join(held, "_row"), "_row", "left")
        .withColumn("n_hit", F.coalesce("n_hit", F.lit(0)))
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    )
    return result.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` without its contaminated rows."""
    scratch = scratch or Scratch(docs.sparkSession)
    table = numbered(docs, scratch)
    bad = scratch.write(contamination(table, benchmark, scratch).where("contaminated").select("_row"), "bad")
    scratch.keep("numbered", "bad")
    return back_to(table, bad, "left_anti").select(docs.columns)
