"""Long passages that occur more than once, by hashed anchors in place of suffix order.

Every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere is found, in
all texts, exactly. Suffixes are indexed at anchors only: of all 200-byte strings that hold
it, the 40-byte gram with the least hash, leftmost if tied. Equal strings have equal grams at
equal places, so any repeat meets in the index. The index is a table of gram codes, without
suffixes or places; it only tells which codes occur twice. Tables of equal size merge.

1. The anchors of the one table are taken in hash slices. Each slice is joined with every
   level for grams known already, and joins the levels; they are deleted after the last slice.
2. For anchors with a shared gram, the stretch of strings that lean on the anchor is compared
   as a whole. Stretches found twice are repeats from end to end.
3. The other stretches with shared grams, mostly at the ends of a passage, are compared
   string by string, one stretch per different content.
4. Repeated strings become ranges per text, and the texts without them are returned.

Null and empty texts have no bytes. Equal rows repeat each other. A text of fewer than 200
bytes cannot hold a repeat. An empty table gives no rows. Matches never cross texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcodes as tc
from .tables import Scratch, numbered, row_of

LENGTH = 200
GRAM = 40
BATCHES = 4
# Different stretches of one gram that are compared in one place; more are spread by string.
TOGETHER = 2000
# Bytes worked through at once: a worker holds about 15 numbers of 8 bytes for each.
BLOCK_BYTES = 1 << 18

_PLACE_BITS = np.uint64(22)


def codes_of(total: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Codes of the byte strings [start, end), from running sums."""
    return tc.mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def running(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = tc.powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return total, down


def _segments(offsets: np.ndarray, length: int):
    """(first row, last row, from, to): whole rows together, or parts of one long row that overlap."""
    for i, j in tc.row_blocks(offsets, BLOCK_BYTES):
        a, b = int(offsets[i]), int(offsets[j])
        if j - i > 1 or b - a <= 2 * BLOCK_BYTES:
            yield i, j, a, b
        else:
            for s in range(a, b - length + 1, BLOCK_BYTES):
                yield i, j, s, min(s + BLOCK_BYTES + length - 1, b)


def anchored(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, first, last, gram code, stretch code) of every stretch of string starts with one anchor."""
    reach = length - gram + 1
    out = [[] for _ in range(5)]
    for i, j, a, b in _segments(offsets, length):
        n = b - a
        if n < length:
            continue
        total, down = running(data[a:b])
        at = np.arange(n - gram + 1)
        grams = codes_of(total, down, at, at + gram)
        value = (grams & ~((np.uint64(1) << _PLACE_BITS) - np.uint64(1))) | at.astype(np.uint64)
        width = -(-len(value) // reach) * reach
        padded = np.full(width, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(value)] = value
        blocks = padded.reshape(-1, reach)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = n - length + 1
        least = np.minimum(behind[:starts], ahead[reach - 1 : reach - 1 + starts])
        anchor = (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        limits = offsets[i : j + 1] - a
        p = np.arange(starts)
        row = np.searchsorted(limits, p, "right") - 1
        inside = p + length <= np.minimum(limits[row + 1], n)
        p, row, anchor = p[inside], row[inside], anchor[inside]
        if not len(p):
            continue
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
        first = p[new]
        last = np.append(p[np.flatnonzero(new)[1:] - 1], p[-1])
        shift = a - offsets[i + row[new]]
        for part, x in zip(out, (i + row[new], first + shift, last + shift, grams[anchor[new]], codes_of(total, down, first, last + length))):
            part.append(x)
    kinds = (np.int64, np.int64, np.int64, np.uint64, np.uint64)
    return tuple(np.concatenate(x) if x else np.zeros(0, k) for x, k in zip(out, kinds))


def _entries(batches):
    for batch in batches:
        data, offsets = tc.text_bytes(batch.column("text"))
        row, first, last, gram, stretch = anchored(data, offsets)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row").take(pa.array(row)), pa.array(first), pa.array(last), pa.array(gram.view(np.int64)), pa.array(stretch.view(np.int64))],
            ["_row", "first", "last", "gram", "stretch"],
        )


class SuffixFamily:
    """Levels of gram codes ``(gram, _row)``; level i holds 2**i batches or nothing."""

    def __init__(self, scratch: Scratch):
        self.scratch = scratch
        self.levels: list[tuple[str, DataFrame] | None] = []
        self.turn = 0

    def add(self, entries: DataFrame) -> DataFrame:
        """Take in a batch; returns the grams it shares within itself or with any level."""
        self.turn += 1
        counted = entries.groupBy("gram").agg(F.min("_row").alias("_row"), F.count(F.lit(1)).alias("n"))
        name = f"array{self.turn}"
        array = self.scratch.write(counted.sortWithinPartitions("gram"), name)
        shared = array.where("n > 1").select("gram")
        for level in self.levels:
            if level is not None:
                shared = shared.union(array.join(level[1], "gram", "left_semi").select("gram"))
        shared = self.scratch.write(shared.distinct(), f"shared{self.turn}")
        array = array.select("gram", "_row")
        for i, level in enumerate(self.levels):
            if level is None:
                self.levels[i] = (name, array)
                return shared
            merged = array.union(level[1]).groupBy("gram").agg(F.min("_row").alias("_row")).sortWithinPartitions("gram")
            new = f"level{self.turn}-{i + 1}"
            array = self.scratch.write(merged, new)
            self.scratch.drop(name, level[0])
            self.levels[i], name = None, new
        self.levels.append((name, array))
        return shared


def _cut_out(batches):
    """The bytes of each wanted stretch with the strings that start in it."""
    for batch in batches:
        data, offsets = tc.text_bytes(batch.column("text"))
        wanted = batch.column("wanted")
        per_row = np.diff(wanted.offsets.to_numpy())
        flat = wanted.flatten()
        row = np.repeat(np.arange(len(batch)), per_row)
        first, last = flat.field("first").to_numpy(), flat.field("last").to_numpy()
        begin, end = offsets[row] + first, offsets[row] + last + LENGTH
        raw = memoryview(data)
        cut = [bytes(raw[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row").take(pa.array(row)), flat.field("first"), flat.field("gram"), flat.field("others"), pa.array(cut, pa.binary())],
            ["_row", "first", "gram", "others", "bytes"],
        )


def _strings(gram: list, cut: list):
    """(stretch, start in it, code) of every string of the given stretches."""
    sizes = np.array([len(c) for c in cut], np.int64)
    limits = np.concatenate([[0], np.cumsum(sizes)])
    total, down = running(np.frombuffer(b"".join(cut), np.uint8))
    n = sizes - LENGTH + 1
    which = np.repeat(np.arange(len(cut)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = limits[which] + start
    code = codes_of(total, down, at, at + LENGTH)
    return which, start, tc.mix(code ^ np.array(gram, np.int64).view(np.uint64)[which])


def _ranges(rows, firsts, which, start):
    """Byte ranges per text of runs of string starts."""
    new = np.ones(len(which), bool)
    new[1:] = (which[1:] != which[:-1]) | (start[1:] != start[:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(which)) - 1
    base = np.array(firsts, np.int64)[which[heads]]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(rows, np.int64)[which[heads]]), pa.array(base + start[heads]), pa.array(base + start[tails] + LENGTH)],
        ["_row", "start", "end"],
    )


def _compare(batches):
    """Ranges of strings that two stretches of one gram share; rows come in order of the gram."""
    held: list[tuple] = []

    def found():
        rows, firsts, gram, cut = zip(*held)
        which, start, code = _strings(gram, cut)
        order = np.argsort(code, kind="stable")
        ranked = code[order]
        twin = np.zeros(len(code), bool)
        equal = ranked[1:] == ranked[:-1]
        twin[order[1:][equal]] = twin[order[:-1][equal]] = True
        return _ranges(rows, firsts, which[twin], start[twin])

    size = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("_row", "first", "gram", "bytes")]
        for item in zip(*columns):
            if size > BLOCK_BYTES and item[2] != held[-1][2]:
                yield found()
                held, size = [], 0
            held.append(item)
            size += len(item[3])
    if held:
        yield found()


def _spread(batches):
    """One row per string, for grams with very many different stretches."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("_row", "first", "gram", "bytes")]
        for i in range(0, len(batch), 2000):
            rows, firsts, gram, cut = (c[i : i + 2000] for c in columns)
            which, start, code = _strings(gram, cut)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(rows, np.int64)[which]), pa.array(np.array(firsts, np.int64)[which] + start), pa.array(code.view(np.int64))],
                ["_row", "start", "code"],
            )


def repeats(rows: DataFrame, scratch: Scratch, batches: int = BATCHES) -> DataFrame:
    """``(_row, start, end)``: byte ranges that together cover all repeated strings; may overlap."""
    entries = rows.select("_row", "text").mapInArrow(_entries, "_row long, first long, last long, gram long, stretch long")
    part = F.pmod(F.xxhash64("_row"), F.lit(batches)).cast("int")
    entries = scratch.write(entries.withColumn("batch", part), "entries", by="batch")
    family = SuffixFamily(scratch)
    shared = None
    for b in range(batches):
        found = family.add(entries.where(F.col("batch") == b))
        shared = found if shared is None else shared.union(found)
    occurrence = F.xxhash64("_row", "first")
    known = scratch.write(
        entries.join(shared.distinct(), "gram", "left_semi").select("_row", "first", "last", "gram", "stretch"), "known"
    )
    scratch.drop("entries", *(level[0] for level in family.levels if level))

    equal = known.groupBy("gram", "stretch").agg(F.min(occurrence).alias("lo"), F.max(occurrence).alias("hi"))
    equal = scratch.write(equal, "equal")
    others = equal.groupBy("gram").agg(F.count(F.lit(1)).alias("others"))
    judged = known.join(equal.join(others, "gram"), ["gram", "stretch"]).select(
        "_row", "first", "last", "gram", "others", (F.col("lo") != F.col("hi")).alias("whole"),
        ((occurrence == F.col("lo")) & (F.col("others") > 1)).alias("compared"),
    )
    judged = scratch.write(judged.where("whole OR compared"), "judged")
    scratch.drop("known", "equal")

    wanted = judged.where("compared").groupBy("_row").agg(F.collect_list(F.struct("first", "last", "gram", "others")).alias("wanted"))
    cut = rows.select("_row", "text").join(wanted, "_row").select("_row", "text", "wanted").mapInArrow(
        _cut_out, "_row long, first long, gram long, others long, bytes binary"
    )
    cut = scratch.write(cut, "cut")
    schema = "_row long, start long, end long"
    near = cut.where(F.col("others") <= TOGETHER).repartition("gram").sortWithinPartitions("gram").mapInArrow(_compare, schema)
    strings = cut.where(F.col("others") > TOGETHER).mapInArrow(_spread, "_row long, start long, code long")
    twice = strings.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    far = strings.join(twice, "code", "left_semi").select("_row", "start", (F.col("start") + LENGTH).alias("end"))
    whole = judged.where("whole").select("_row", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end"))
    return scratch.write(whole.union(near).union(far), "ranges")


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges, as sorted ranges that neither overlap nor touch."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return start[heads], reach[np.append(heads[1:], len(start)) - 1]


def _without(batches):
    for batch in batches:
        texts, ranges = batch.column("text"), batch.column("ranges")
        removed, spans, kept = [], [], []
        for i in range(len(batch)):
            raw = (texts[i].as_py() or "").encode()
            found = ranges[i].values
            if found is None or not len(found):
                removed.append(0)
                spans.append([])
                kept.append(raw)
                continue
            start, end = merged(found.field("start").to_numpy(), found.field("end").to_numpy())
            removed.append(int((end - start).sum()))
            spans.append([{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist())])
            edges = zip([0, *end.tolist()], [*start.tolist(), len(raw)])
            kept.append(b"".join([raw[a:b] for a, b in edges]))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
            ["_row", "doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def without_repeats(docs: DataFrame, batches: int = BATCHES, scratch: Scratch | None = None) -> DataFrame:
    """Per row ``_row``, ``doc_id``, ``n_bytes``, ``n_removed``, the removed ``spans`` (byte ranges) and
    the bytes ``kept``."""
    scratch = scratch or Scratch(docs.sparkSession)
    rows = numbered(docs, scratch, "doc_id", "text")
    rows = rows.select(row_of(rows).alias("_row"), "doc_id", "text")
    found = repeats(rows, scratch, batches)
    per_row = found.groupBy("_row").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).join(per_row, "_row", "left")
    return joined.select("_row", "doc_id", "n_bytes", "text", "ranges").mapInArrow(
        _without, f"_row long, doc_id {kind}, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
    )
