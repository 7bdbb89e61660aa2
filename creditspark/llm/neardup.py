"""Near-duplicate documents: min-hash signatures joined by a multi-index over their chunks.

Two documents are linked when their sets of five-word shingles have a Jaccard
similarity of 0.75 or more. Each set gets a signature of 32 values of 16 bits (b-bit
min-wise hashing), in 8 chunks of 4. By the pigeonhole principle two signatures that
differ in at most ``8 * (1 + 1) - 1 = 15`` values have a chunk with at most one
difference, so each document is filed under every chunk with one value left out (32
keys) and no pair within that distance is missed. Pairs at similarity 0.75 share a
chunk so with probability 1 - 2e-5.

Not every pair of a bucket is needed to know the connected groups. Members of a bucket
are first compared with two members picked by the key, the found links are contracted,
and only members outside of their bucket's main group are then compared with all other
groups in it, by a longer signature before the texts. Links are confirmed on the full sets; equal sets are one node.

Texts with fewer than five words have the whole word sequence as their one shingle. Null,
empty and word-less texts have no shingle and are linked with nothing. Repeated rows are
linked; of rows with one doc_id only one is kept. Rows with a null doc_id are linked like
others; ``component_id`` is the smallest id that is not null. An empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textcodes as tc
from .components import connected
from .tables import Scratch, back_to, give_back, numbered, returning, row_of

SHINGLE = 5
CHUNKS = 8
VALUES = 4  # of 16 bits, per chunk: one long
# Pairs within this signature distance are confirmed; at similarity 0.75 all but 3e-5 are.
DISTANCE = 18
PERCENT = 75
# A longer signature for pairs within large buckets: 2048 values of one bit, in 32 longs. At
# similarity 0.75, 256 values differ on average, and more than 321 with probability 1e-5. The
# first 512 of them are looked at first; there 64 differ on average, more than 102 with 1e-6.
FINE_PARTS = 32
FINE_VALUES = 64
FINE_DISTANCE = 321
GLANCE_PARTS = 8
GLANCE_DISTANCE = 102
# Pairs per block of the exact comparison, and bytes of the texts at their ends, on average.
BLOCK_PAIRS = 5000
BLOCK_BYTES = 16 << 20

_rng = np.random.default_rng(20240607)
_MULTIPLY = _rng.integers(0, 1 << 63, CHUNKS * VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, CHUNKS * VALUES, np.uint64)
_FINE_MULTIPLY = _rng.integers(0, 1 << 63, FINE_PARTS * FINE_VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
_FINE_ADD = _rng.integers(0, 1 << 63, FINE_PARTS * FINE_VALUES, np.uint64)
_PARTS = [f"s{i}" for i in range(CHUNKS)]
_FINE = [f"f{i}" for i in range(FINE_PARTS)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle codes of each row."""
    _, _, row, code = tc.words(data, offsets, tc.SPACED)
    n = len(offsets) - 1
    counts = np.bincount(row, minlength=n)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    at, codes = tc.shingles(code, row, size)
    limits = np.searchsorted(at, firsts)
    sets = []
    for i in range(n):
        if 0 < counts[i] < size:
            whole = tc.shingles(code[firsts[i] : firsts[i + 1]], np.zeros(counts[i], np.int8), int(counts[i]))
            sets.append(whole[1])
        else:
            sets.append(np.unique(codes[limits[i] : limits[i + 1]]))
    return sets


def _signatures(batches):
    for batch in batches:
        data, offsets = tc.text_bytes(batch.column("text"))
        n_shingles = np.zeros(len(batch), np.int64)
        keys = np.zeros((2, len(batch)), np.uint64)
        parts = np.zeros((CHUNKS, len(batch)), np.uint64)
        for i, j in tc.row_blocks(offsets):
            sets = shingle_sets(data, offsets[i : j + 1])
            sizes = np.array([len(s) for s in sets], np.int64)
            n_shingles[i:j] = sizes
            full = np.flatnonzero(sizes) + i
            if not len(full):
                continue
            codes = np.concatenate(sets)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[sizes > 0]
            keys[0, full] = np.add.reduceat(codes, starts)
            keys[1, full] = np.add.reduceat(tc.mix(codes ^ np.uint64(tc.BASE)), starts)
            for k in range(CHUNKS * VALUES):
                least = np.minimum.reduceat(codes * _MULTIPLY[k] + _ADD[k], starts)
                value = tc.mix(least) & np.uint64(0xFFFF)
                parts[k // VALUES, full] |= value << np.uint64(16 * (k % VALUES))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("doc_id"), pa.array(n_shingles), pa.array(np.diff(offsets))]
            + [pa.array(x.view(np.int64)) for x in (*keys, *parts)],
            ["_row", "doc_id", "n_shingles", "n_bytes", "key0", "key1", *_PARTS],
        )


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask)


def _distance(a: str, b: str) -> Column:
    """Differing values of two signatures."""
    terms = []
    for p in _PARTS:
        x = F.col(f"{a}_{p}").bitwiseXOR(F.col(f"{b}_{p}"))
        terms += [(x.bitwiseAND(_signed(0xFFFF << (16 * v))) != 0).cast("int") for v in range(VALUES)]
    return reduce(lambda x, y: x + y, terms)


def _fine_distance(a: str, b: str, parts: list[str]) -> Column:
    """Differing values of two longer signatures of single bits."""
    return reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{a}_{p}").bitwiseXOR(F.col(f"{b}_{p}"))) for p in parts])


def _alike_sizes(a: str, b: str, percent: int) -> Column:
    """Sets whose sizes differ too much cannot be similar enough."""
    a, b = F.col(f"{a}_n_shingles"), F.col(f"{b}_n_shingles")
    return (100 * a >= percent * b) & (100 * b >= percent * a)


def _mask(v: int) -> Column:
    """All values of a chunk but the ``v``-th."""
    return _signed(((1 << 64) - 1) ^ (0xFFFF << (16 * v)))


def _first_key(a: str, b: str) -> Column:
    """The first key that two signatures share; a pair is taken there only."""
    shared = []
    for c, p in enumerate(_PARTS):
        x = F.col(f"{a}_{p}").bitwiseXOR(F.col(f"{b}_{p}"))
        shared += [F.when(x.bitwiseAND(_mask(v)) == 0, c * VALUES + v) for v in range(VALUES)]
    return F.coalesce(*shared)


def _keys(nodes: DataFrame) -> DataFrame:
    """(key, code, node): each chunk with each one value left out."""
    filed = F.array(*[
        F.struct(F.lit(c * VALUES + v).alias("key"), F.col(_PARTS[c]).bitwiseAND(_mask(v)).alias("code"))
        for c in range(CHUNKS) for v in range(VALUES)
    ])
    return nodes.select("node", F.explode(filed).alias("k")).select("k.key", "k.code", "node")


def _fine(batches):
    """Longer signatures of single bits for the members of shared buckets."""
    for batch in batches:
        data, offsets = tc.text_bytes(batch.column("text"))
        for i, j in tc.row_blocks(offsets):
            parts = np.zeros((FINE_PARTS, j - i), np.uint64)
            sets = shingle_sets(data, offsets[i : j + 1])
            sizes = np.array([len(x) for x in sets], np.int64)
            codes = np.concatenate(sets)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            for k in range(FINE_PARTS * FINE_VALUES):
                least = np.minimum.reduceat(codes * _FINE_MULTIPLY[k] + _FINE_ADD[k], starts)
                parts[k // FINE_VALUES] |= (tc.mix(least) & np.uint64(1)) << np.uint64(k % FINE_VALUES)
            own = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays(
                [own.column("node"), own.column("text"), pa.array(sizes), *(pa.array(x.view(np.int64)) for x in parts)],
                ["node", "text", "n_shingles", *_FINE],
            )


def _confirm(percent: int):
    def linked(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        """Pairs of a block whose sets are similar enough; ``texts`` has all texts the block needs."""
        node = texts.column("node").to_numpy()
        sets = {}
        data, offsets = tc.text_bytes(texts.column("text"))
        for i, j in tc.row_blocks(offsets, 1 << 20):
            sets.update(zip(node[i:j].tolist(), shingle_sets(data, offsets[i : j + 1])))
        a, b = pairs.column("a").to_numpy(), pairs.column("b").to_numpy()
        good = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            x, y = sets[x], sets[y]
            if len(x) > len(y):
                x, y = y, x
            if len(x):
                near = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[near] == x).sum())
                good[i] = 100 * both >= percent * (len(x) + len(y) - both)
        found = pa.table({"a": a[good], "b": b[good]})
        sets.clear()
        give_back()
        return found

    return linked


def _links(pairs: DataFrame, texts: DataFrame, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Pairs ``(a, b, n_bytes)`` are dealt to a square of blocks by hashes of both ends, so a block has a bounded
    number of pairs and of bytes at their ends however many one node has, and a text goes once to each block that needs it.
    """
    pairs = scratch.write(pairs, f"{name}-pairs")
    n, size = pairs.agg(F.count(F.lit(1)), F.sum("n_bytes")).first()
    side = math.ceil(math.sqrt(max(1, n / BLOCK_PAIRS, (size or 0) / BLOCK_BYTES)))
    block = F.pmod(F.xxhash64("a"), F.lit(side)) * side + F.pmod(F.xxhash64("b"), F.lit(side))
    dealt = pairs.select(block.alias("block"), "a", "b")
    again = scratch.read(f"{name}-pairs", pairs)  # the same table under columns of its own, for the cogroup
    ends = [again.select(block.alias("block"), F.col(end).alias("node")).distinct() for end in ("a", "b")]
    needed = ends[0].union(ends[1]).distinct()
    held = needed.join(texts.select("node", "text"), "node").select("block", "node", "text")
    found = dealt.groupBy("block").cogroup(held.groupBy("block")).applyInArrow(_confirm(percent), "a long, b long")
    return scratch.write(found, name)


def _merged(group: DataFrame, more: DataFrame, scratch: Scratch) -> DataFrame:
    """Groups (node, group) after further links: only links between different groups are followed, as links of the groups."""
    named = group.select(F.col("node").alias("a"), F.col("group").alias("ga"))
    contracted = more.select("a", "b").join(named, "a", "left").join(named.toDF("b", "gb"), "b", "left").select(
        F.coalesce("ga", "a").alias("a"), F.coalesce("gb", "b").alias("b")
    )
    joined = connected(scratch.write(contracted.where("a <> b").distinct(), "between"), scratch, "last")
    joined = scratch.write(joined.select(F.col("node").alias("group"), F.col("group").alias("whole")), "joined")
    kept = group.join(joined, "group", "left").select("node", F.coalesce("whole", "group").alias("group"))
    # Nodes without a group of their own so far.
    single = joined.join(group.select(F.col("node").alias("group")), "group", "left_anti").select(F.col("group").alias("node"), F.col("whole").alias("group"))
    return kept.union(single)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, scratch: Scratch | None = None) -> DataFrame:
    """Per row: ``_row``, ``doc_id``, ``n_shingles``, ``component_id`` (smallest doc_id of the
    group) and ``kept`` (the first row of each group)."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    rows = numbered(docs, scratch, "doc_id", "text")
    rows = rows.select(row_of(rows).alias("_row"), "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"_row long, doc_id {kind}, n_shingles long, n_bytes long, key0 long, key1 long, " + ", ".join(f"{p} long" for p in _PARTS)
    signed = scratch.write(rows.mapInArrow(returning(_signatures), schema), "signed")

    # Equal sets are one node, named by its first row.
    sets = signed.where("n_shingles > 0").groupBy("key0", "key1", "n_shingles").agg(
        F.min("_row").alias("node"), F.max("n_bytes").alias("n_bytes"), *[F.max(p).alias(p) for p in _PARTS]
    )
    sets = scratch.write(sets, "sets")
    nodes = sets.select("node", "n_shingles", "n_bytes", *_PARTS)

    # Buckets of two nodes or more, with two members picked in an order of the key's own.
    keys = _keys(nodes)
    salt = F.shiftrightunsigned(F.xxhash64("key", "code"), 1)
    salted = F.col("node").bitwiseXOR(salt)
    shared = (
        keys.groupBy("key", "code")
        .agg(F.count(F.lit(1)).alias("members"), F.min(salted).alias("lo"), F.max(salted).alias("hi"))
        .where("members > 1")
        .select("key", "code", F.col("lo").bitwiseXOR(salt).alias("lo"), F.col("hi").bitwiseXOR(salt).alias("hi"))
    )
    filed = scratch.write(keys.join(shared, ["key", "code"]), "filed")
    members = filed.select("node").distinct()
    texts = rows.select(F.col("_row").alias("node"), "text").join(members, "node", "left_semi")
    texts = scratch.write(
        texts.mapInArrow(returning(_fine), "node long, text string, n_shingles long, " + ", ".join(f"{f} long" for f in _FINE)), "texts"
    )

    def side(prefix: str, *columns: str) -> list[Column]:
        return [F.col(c).alias(f"{prefix}_{c}") for c in columns]

    first = filed.select("node", F.explode(F.array("lo", "hi")).alias("other")).where("node <> other").distinct()
    first = (
        first.join(nodes.select("node", *side("l", "n_shingles", "n_bytes", *_PARTS)), "node")
        .join(nodes.select(F.col("node").alias("other"), *side("r", "n_shingles", "n_bytes", *_PARTS)), "other")
        .where(_alike_sizes("l", "r", percent))
        .withColumn("distance", _distance("l", "r"))
        .where(F.col("distance") <= DISTANCE)
    )
    n_bytes = F.col("l_n_bytes") + F.col("r_n_bytes")
    nearest = Window.partitionBy("node").orderBy("distance", "other")
    first = (
        first.withColumn("rank", F.row_number().over(nearest)).where("rank <= 2")
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), n_bytes.alias("n_bytes")).distinct()
    )
    links = _links(first, texts, percent, scratch, "links")
    group = connected(links, scratch, "first")

    # Members outside their bucket's largest group against every other group of the bucket.
    named = filed.select("key", "code", "node").join(group, "node", "left").withColumn("group", F.coalesce("group", "node"))
    named = scratch.write(named, "named")
    sizes = named.groupBy("key", "code", "group").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key", "code").agg(F.count(F.lit(1)).alias("groups"), F.max_by("group", "n").alias("main")).where("groups > 1")
    signature = nodes.select("node", "n_bytes", *_PARTS).join(texts.drop("text"), "node")
    mixed = named.join(main.select("key", "code", "main"), ["key", "code"]).join(signature, "node")
    mixed = scratch.write(mixed, "mixed")
    carried = ("node", "group", "n_shingles", "n_bytes", *_PARTS, *_FINE)
    left = mixed.where("`group` <> main").select("key", "code", *side("l", *carried))
    right = mixed.select("key", "code", *side("r", *carried), (F.col("group") == F.col("main")).alias("r_inside"))
    rest = left.join(right, ["key", "code"]).where(
        (F.col("l_group") != F.col("r_group"))
        & (F.col("r_inside") | (F.col("l_node") < F.col("r_node")))
        & _alike_sizes("l", "r", percent)
        & (_fine_distance("l", "r", _FINE[:GLANCE_PARTS]) <= GLANCE_DISTANCE)
        & (_first_key("l", "r") == F.col("key"))
        & (_fine_distance("l", "r", _FINE) <= FINE_DISTANCE)
    )
    rest = rest.select(F.least("l_node", "r_node").alias("a"), F.greatest("l_node", "r_node").alias("b"), n_bytes.alias("n_bytes"))
    more = _links(rest, texts, percent, scratch, "more")
    group = _merged(group, more, scratch)

    # Back to rows: nodes stand for all rows of their set, groups take their smallest doc_id.
    named = sets.select("key0", "key1", "n_shingles", "node").join(group, "node", "left").select(
        "key0", "key1", "n_shingles", F.coalesce("group", "node").alias("group")
    )
    owned = signed.select("_row", "doc_id", "n_shingles", "key0", "key1").join(named, ["key0", "key1", "n_shingles"], "left")
    owned = scratch.write(owned.select("_row", "doc_id", "n_shingles", F.coalesce("group", "_row").alias("group")), "owned")
    smallest = owned.groupBy("group").agg(F.min("doc_id").alias("component_id"), F.min(F.when(F.col("doc_id").isNull(), F.col("_row"))).alias("null_row"))
    placed = owned.join(smallest, "group")
    ahead = placed.where(F.col("doc_id") == F.col("component_id")).groupBy("group").agg(F.min("_row").alias("first_row"))
    placed = placed.join(ahead, "group", "left")
    return placed.select(
        "_row", "doc_id", "n_shingles", "component_id",
        (F.col("_row") == F.coalesce("first_row", "null_row")).alias("kept"),
    )


def deduplicated(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with one row of each group of near duplicates."""
    scratch = scratch or Scratch(docs.sparkSession)
    table = numbered(docs, scratch)
    gone = scratch.write(near_duplicates(table, scratch=scratch).where("not kept").select("_row"), "gone")
    scratch.keep("numbered", "gone")
    return back_to(table, gone, "left_anti").select(docs.columns)
