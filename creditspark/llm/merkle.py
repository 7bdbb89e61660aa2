"""Merkle manifest of a dataset: a hash tree per language, and one over the languages' roots.

A leaf is the SHA-256 of a row's columns. In each tree every ``fan_out`` consecutive nodes
become their hash until one is left. Trees are built by windows: in a level, a node's siblings
are the rows at fixed offsets before and after it (lag and lead by multiples of the level's
step), masked by the node's slot in its run and by the tree's length; the first child's row
hashes the parent. A row that stands for no node of a level has a null digest there, and
takes the siblings of its ancestor from the nearest earlier row that has them.

Windows run over aligned blocks of at most ``BLOCK`` rows of a tree, so a language with most of the
rows is many small groups. The roots of the blocks are the next tier's rows, a table smaller by that factor,
until each tree is one block. Rows are numbered by a range sort of the narrow leaf table and
counts per part; no table is sorted in one task. The number of languages is not bounded either.

Nulls in any column have a mark of their own; an empty text is not null. Rows with a null or repeated
``doc_id`` are leaves like others (null first, ties by leaf hash; equal rows in any order,
which gives the same tree). Texts of any length are hashed whole. Further columns are not read, whatever their names. An empty
table has no leaves and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Scratch, join_small

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_OUT = 2
BLOCK = 1024
# Bytes of a row of siblings, for the size check of joins.
_PATH_BYTES = 2048


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the joined texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(columns: dict[str, Column]) -> Column:
    """Hash of one row: each value after its length in bytes, ``-`` for null."""
    texts = [columns[c].cast("string") for c in COLUMNS]
    return digest(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to along ``path``, an array of the texts before and after it per level."""
    return F.aggregate(path, start, lambda node, step: digest(step["before"], node, step["after"]))


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.aggregate(path, F.lit(""), lambda found, step: F.concat(found, step["before"], step["after"]))


def placed(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` (with a column ``tree``) with ``pos``, their place in their tree by ``order``, and the tree's size ``n``."""
    keys = ["tree", *order, "_tie"]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = scratch.write(ranged.drop("_tie").withColumn("_seq", F.monotonically_increasing_id()), name)
    ranged = ranged.withColumn("_part", F.shiftright("_seq", 33))
    # A tree has a row per part that it reaches into.
    parts = ranged.groupBy("tree", "_part").agg(F.min("_seq").alias("low"), F.count(F.lit(1)).alias("here"))
    tree = Window.partitionBy("tree")
    before = F.sum("here").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = parts.select("tree", "_part", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("_shift"), F.sum("here").over(tree).alias("n"))
    shifts = scratch.write(shifts, f"{name}-parts")
    numbered = join_small(ranged, shifts, ["tree", "_part"], "inner", 128)
    return numbered.withColumn("pos", F.col("_seq") + F.col("_shift")).drop("_seq", "_part", "_shift")


def _climb(nodes: DataFrame, fan_out: int, levels: int) -> DataFrame:
    """``path`` within the block for every row, and the block's root in ``node`` of its first row."""
    nodes = nodes.withColumn("block", F.floor(F.col("pos") / fan_out**levels))
    block = Window.partitionBy("tree", "block").orderBy("pos")
    pos, node = F.col("pos"), F.col("node")
    for level in range(levels):
        step = fan_out**level
        slot = F.floor(pos / step) % fan_out
        before = [F.when(slot >= k, F.lag("node", k * step).over(block)) for k in range(fan_out - 1, 0, -1)]
        after = [F.when((slot + k < fan_out) & (pos + k * step < F.col("n")), F.lead("node", k * step).over(block)) for k in range(1, fan_out)]
        going = F.col("n") > step
        nodes = nodes.withColumn("_before", F.concat_ws("", *before)).withColumn("_after", F.concat_ws("", *after))
        found = F.struct(F.col("_before").alias("before"), F.col("_after").alias("after"))
        parent = F.when(going, digest(node, F.col("_after"))).otherwise(node)
        nodes = nodes.withColumn(f"_s{level}", F.when(going & (pos % step == 0), found)).withColumn(
            "node", F.when(pos % (step * fan_out) == 0, parent)
        ).drop("_before", "_after")
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    steps = [F.last(f"_s{level}", ignorenulls=True).over(so_far) for level in range(levels)]
    path = F.filter(F.array(*steps), lambda step: step.isNotNull())
    return nodes.withColumn("path", path).drop(*[f"_s{level}" for level in range(levels)])


def climbed(leaves: DataFrame, scratch: Scratch, name: str, fan_out: int = FAN_OUT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``leaves`` (tree, pos, n, node) with their ``path`` to the root, and ``(tree, root)``."""
    levels = 1
    while fan_out ** (levels + 1) <= block:
        levels += 1
    size = fan_out**levels
    tiers, roots, nodes = [], None, leaves
    while True:
        tier = scratch.write(_climb(nodes, fan_out, levels), f"{name}-tier{len(tiers)}")
        tiers.append(tier)
        own = tier.where((F.col("pos") == 0) & (F.col("n") <= size)).select("tree", F.col("node").alias("root"))
        roots = own if roots is None else roots.union(own)
        if (tier.agg(F.max("n")).first()[0] or 0) <= size:
            break
        nodes = tier.where((F.col("pos") % size == 0) & (F.col("n") > size)).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), "node"
        )
    above = None
    for tier in reversed(tiers):
        if above is not None:
            tier = join_small(tier, above, ["tree", "block"], "left", _PATH_BYTES).withColumn(
                "path", F.concat("path", F.coalesce("_above", F.array().cast(tier.schema["path"].dataType)))
            ).drop("_above")
        above = tier.select("tree", F.col("pos").alias("block"), F.col("path").alias("_above"))
    return tier.drop("block", "node"), roots


def manifest(
    docs: DataFrame, extra: dict[str, Column] | None = None, scratch: Scratch | None = None, fan_out: int = FAN_OUT, block: int = BLOCK
) -> DataFrame:
    """Per row: ``doc_id``, ``leaf``, ``subroot`` (of its language), ``root``, ``path`` (from the
    leaf to the root) and the columns of ``extra``, computed from the row."""
    scratch, extra = scratch or Scratch(docs.sparkSession), extra or {}
    # Languages in the order of their bytes, null before all.
    tree = F.coalesce(F.concat(F.lit("."), F.col("lang").cast("string")), F.lit(""))
    leaves = docs.select("doc_id", tree.alias("tree"), leaf({c: F.col(c) for c in COLUMNS}).alias("leaf"), *[v.alias(f"extra_{k}") for k, v in extra.items()])
    leaves = placed(leaves, ["doc_id", "leaf"], scratch, "leaves").withColumn("node", F.col("leaf"))
    leaves, subroots = climbed(leaves, scratch, "rows", fan_out, block)
    subroots = scratch.write(subroots, "subroots")
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), F.col("root").alias("node"))
    tops = placed(tops, ["lang"], scratch, "languages").withColumn("subroot", F.col("node"))
    tops, root = climbed(tops, scratch, "top", fan_out, block)
    tops = tops.join(F.broadcast(root), "tree")  # a single row
    tops = tops.select(F.col("lang").alias("tree"), "subroot", F.col("path").alias("_top"), F.col("root").alias("_root"))
    tops = scratch.write(tops, "tops")
    both = join_small(leaves, tops, "tree", "inner", _PATH_BYTES)
    return both.select(
        "doc_id", "leaf", "subroot", F.col("_root").alias("root"), F.concat("path", "_top").alias("path"), *[F.col(f"extra_{k}").alias(k) for k in extra]
    )
