"""Shards of bounded size by extendible hashing.

A document's hash bits are those of its id, then of its text, then of its row number, so
that no two rows share all bits. The directory starts with one bucket; a bucket whose bytes
exceed the limit is split on its next bit, others stay. Bytes are first summed per cell of a
depth a few bits beyond what an even spread needs. A cell then belongs to its shortest
prefix whose cells fit the limit together, and only cells that are too large themselves go
on to further bits. One document is never cut: alone in its bucket it may exceed the limit.

Null and empty texts have 0 bytes. Null ids are hashed like the text "null". Repeated rows
share the bits of id and text and part at the row number. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, back_to, free_name, join_small, numbered, row_name, row_of

LIMIT = 8 << 20
# Bits of a cell beyond an even spread, bits added per further round, bits per hash part.
SPARE_BITS = 6
MORE_BITS = 12
PART_BITS = 60


def _bits(value: Column) -> Column:
    number = F.conv(F.substring(F.md5(value), 1, PART_BITS // 4), 16, 2)
    return F.lpad(number, PART_BITS, "0")


def shards(docs: DataFrame, limit: int = LIMIT, scratch: Scratch | None = None) -> DataFrame:
    """Per row: ``_row``, ``doc_id``, ``n_bytes``, ``shard`` (its hash prefix as 0s and 1s),
    ``depth`` and ``shard_bytes``."""
    scratch = scratch or Scratch(docs.sparkSession)
    rows = docs.select(row_of(docs).alias("_row"), "doc_id", "text").select(
        "_row", "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.concat(
            _bits(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")),
            _bits(F.coalesce("text", F.lit("")).cast("binary")),
            _bits(F.col("_row").cast("string").cast("binary")),
        ).alias("bits"),
    )
    rows = scratch.write(rows, "rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE_BITS
    below, placed, open_rows, turn = 0, [], rows, 0
    while True:
        prefix = lambda c: F.substring(c, F.lit(1), F.col("d"))
        cells = open_rows.groupBy(F.substring("bits", 1, depth).alias("cell")).agg(
            F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n")
        )
        cells = scratch.write(cells, f"cells{turn}")
        levels = cells.select("cell", "bytes", "n", F.explode(F.sequence(F.lit(below), F.lit(depth))).alias("d"))
        sums = levels.groupBy("d", prefix("cell").alias("shard")).agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("n"))
        fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("n") == 1))
        # The shortest prefix that fits: the least depth among those of the cell.
        chosen = levels.select("cell", "d", prefix("cell").alias("shard")).join(fits.drop("n"), ["d", "shard"])
        least = chosen.groupBy("cell").agg(F.min("d").alias("d"))
        directory = scratch.write(chosen.join(least, ["cell", "d"]).select("cell", "shard", "d", "shard_bytes"), f"directory{turn}")
        keyed = open_rows.withColumn("cell", F.substring("bits", 1, depth))
        joined = join_small(keyed, directory, "cell", "left", 250)
        placed.append(joined.where("shard IS NOT NULL").select("_row", "doc_id", "n_bytes", "shard", F.col("d").alias("depth"), "shard_bytes"))
        left_over = cells.join(directory, "cell", "left_anti").limit(1).count()
        if not left_over:
            break
        open_rows = scratch.write(joined.where("shard IS NULL").select("_row", "doc_id", "n_bytes", "bits"), f"open{turn}")
        below, depth, turn = depth + 1, min(depth + MORE_BITS, 3 * PART_BITS), turn + 1
    result = placed[0]
    for part in placed[1:]:
        result = result.union(part)
    return result


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Write the documents to one folder per shard."""
    scratch = Scratch(docs.sparkSession)
    table = numbered(docs, scratch)
    name = "shard" if "shard" not in docs.columns else free_name(docs, "hash_shard")
    found = shards(table, limit, scratch).select("_row", F.col("shard").alias(name))
    back_to(table, found, "inner").drop(row_name(table)).repartition(name).write.partitionBy(name).parquet(path)
