"""Order-based building blocks that never sort one key in one task.

Values are first aggregated to cells (one row per distinct value), so a hot
value costs one row. Many cells are sorted over range partitions; sums run inside each
partition and the small partition totals carry them across partitions. The
limits between partitions only steer the work: results are exact for any limits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .longform import clean_double, named, to_long, unpivoted
from .storage import checkpointed, is_small, join_checked, join_with_nulls, removed, row_width, written, written_at

ROWS_PER_BUCKET = 2_000_000
SKETCH_ACCURACY = 10_000
BUCKET = "bucket"


def bucket_count(spark: SparkSession, rows: int) -> int:
    """Value buckets for a table of ``rows`` rows; ``spark.creditspark.rowsPerBucket``
    sets how many rows one bucket should hold."""
    per_bucket = int(spark.conf.get("spark.creditspark.rowsPerBucket", str(ROWS_PER_BUCKET)))
    return max(1, math.ceil(rows / per_bucket))


def value_cells(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    sums: dict[str, Column],
    rows: int | None = None,
) -> tuple[DataFrame, bool]:
    """One row per (keys, feature, distinct value) with the aggregates in ``sums``.

    Returns the cells and whether there are so many rows that running totals must not see a key in one
    task. The shuffle follows a map-side combine, so repeated values collapse before it.
    """
    inputs = [c for c in df.columns if c not in features]
    wide = df.select(*map(named, inputs), *[clean_double(f).alias(f) for f in features])
    buckets = bucket_count(df.sparkSession, df.count() if rows is None else rows)
    long = unpivoted(wide, inputs, features)
    cells = long.filter(F.col("value").isNotNull()).groupBy(*map(named, keys), "feature", "value").agg(
        *[expr.alias(name) for name, expr in sums.items()]
    )
    return cells, buckets > 1


def _added_up(sums: Sequence[str]):
    """Running sums over the sorted rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = dict.fromkeys(sums, 0)
        for batch in batches:
            if not len(batch):
                continue
            columns, names = list(batch.columns), list(batch.schema.names)
            for s in sums:
                upto = np.cumsum(batch.column(s).fill_null(0).to_numpy(zero_copy_only=False)) + before[s]
                before[s] = upto[-1]
                columns.append(pa.array(upto))
                names.append(f"{s}_in")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _ranged_totals(cells: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Sequence[str], with_all: bool) -> DataFrame:
    """``running_totals`` of cells that are sorted over range partitions: a partition adds up its cells, and a table
    of about one row per partition and key says what to add to its sums for that key."""
    keyed = [*map(named, keys), *map(named, order)]
    # The ranges are sampled from the cells, so these are computed once before.
    ranged = written(cells).repartitionByRange(*keyed).sortWithinPartitions(*keyed)
    flat = T.StructType([*ranged.schema, *[T.StructField(f"{s}_in", ranged.schema[s].dataType) for s in sums]])
    local = written(ranged.mapInArrow(_added_up(sums), flat).withColumn(BUCKET, F.spark_partition_id()))
    # Sums of a partition before its first cell of a key, and after its last one.
    ends = local.groupBy(*map(named, keys), BUCKET).agg(
        F.min(F.struct(*map(named, order), *[(F.col(f"{s}_in") - F.coalesce(s, F.lit(0))).alias(f"{s}_low") for s in sums])).alias("low"),
        F.max(F.struct(*map(named, order), *[F.col(f"{s}_in") for s in sums])).alias("high"),
    )
    here = {s: F.col(f"high.{s}_in") - F.col(f"low.{s}_low") for s in sums}
    by_key = Window.partitionBy(*map(named, keys))
    before = by_key.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select(
        *map(named, keys), BUCKET,
        *[(F.coalesce(F.sum(x).over(before), F.lit(0)) - F.col(f"low.{s}_low")).alias(f"{s}_before") for s, x in here.items()],
        *[F.sum(x).over(by_key).alias(f"{s}_all") for s, x in here.items()],
    )
    return join_with_nulls(local, checkpointed(offsets), [*keys, BUCKET], checked=True).select(
        *map(named, cells.columns),
        *[(F.col(f"{s}_in") + F.col(f"{s}_before")).alias(f"{s}_upto") for s in sums],
        *[F.col(f"{s}_all") for s in sums if with_all],
    )


def running_totals(
    cells: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str],
    bucketed: bool,
    with_all: bool = True,
) -> DataFrame:
    """Add ``<s>_upto`` (running sum including the row) and, on demand, ``<s>_all`` per key."""
    rows = (Window.unboundedPreceding, Window.currentRow)
    if not bucketed:
        by_key = Window.partitionBy(*keys)
        running = by_key.orderBy(*order).rowsBetween(*rows)
        return cells.select(
            "*",
            *[F.sum(s).over(running).alias(f"{s}_upto") for s in sums],
            *[F.sum(s).over(by_key).alias(f"{s}_all") for s in sums if with_all],
        )
    if BUCKET not in cells.columns:
        return _ranged_totals(cells, keys, order, sums, with_all)
    # Read twice below, so computed once: for the bucket totals and for the windows.
    cells = written(cells)
    totals = cells.groupBy(*keys, BUCKET).agg(*[F.sum(s).alias(s) for s in sums])
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        BUCKET,
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_before") for s in sums],
        *[F.sum(s).over(by_key).alias(f"{s}_all") for s in sums],
    )
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order).rowsBetween(*rows)
    local = cells.select("*", *[F.sum(s).over(inside).alias(f"{s}_in") for s in sums])
    return join_with_nulls(local, offsets, [*keys, BUCKET]).select(
        *[c for c in cells.columns if c != BUCKET],
        *[(F.col(f"{s}_in") + F.col(f"{s}_before")).alias(f"{s}_upto") for s in sums],
        *[F.col(f"{s}_all") for s in sums if with_all],
    )


def _added_up_by_scope(keys: Sequence[str], order: str, sums: Sequence[str], whole: str | None):
    """Running sums per scope and key over the rows of a task, sorted by key and order; with ``whole`` a row of that
    scope follows each place of the order, with the sums of all scopes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}  # per scope: key, sums so far
        last = None  # key, order and sums of the last row, whose place may go on

        def at_scope(scope, key):
            known = state.get(scope)
            return known[1] if known is not None and known[0] == key else np.zeros(len(sums), np.int64)

        def piece(scope, key, place, found, like):
            if scope is None:
                scope = pa.array([whole] * len(place), like.schema.field("scope").type)
            columns = [scope, *[pa.array([k] * len(place), like.schema.field(c).type) for c, k in zip(keys, key)], place, *map(pa.array, found)]
            return pa.RecordBatch.from_arrays(columns, ["scope", *keys, order, *[f"{s}_in" for s in sums]])

        for batch in batches:
            if not len(batch):
                continue
            coded = [batch.column(c).dictionary_encode() for c in keys]
            codes = np.stack([c.indices.fill_null(-1).to_numpy(zero_copy_only=False) for c in coded])
            limits = [0, *(np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(0)) + 1), len(batch)]
            for a, b in zip(limits[:-1], limits[1:]):
                part = batch.slice(a, b - a)
                key = tuple(part.column(c)[0].as_py() for c in keys)
                place = part.column(order)
                x = np.stack([part.column(s).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for s in sums])
                if last is not None and last[0] != key:
                    yield piece(None, last[0], last[1], last[2], part)
                    last = None
                if whole is not None:
                    at = place.to_numpy(zero_copy_only=False)
                    upto = np.cumsum(x, 1) + at_scope((whole,), key)[:, None]
                    ends = np.flatnonzero(at[1:] != at[:-1])
                    if last is not None and last[1][0].as_py() != at[0]:
                        yield piece(None, key, last[1], last[2], part)
                    if len(ends):
                        yield piece(None, key, place.take(pa.array(ends)), upto[:, ends], part)
                    last = key, place.slice(len(at) - 1, 1), upto[:, -1:]
                    state[(whole,)] = key, upto[:, -1]
                scopes = part.column("scope").dictionary_encode()
                names, own = [*scopes.dictionary.to_pylist(), None], scopes.indices.fill_null(len(scopes.dictionary)).to_numpy(zero_copy_only=False)
                rows = np.argsort(own, kind="stable")
                starts = np.flatnonzero(np.concatenate([[True], np.diff(own[rows]) != 0]))
                upto = np.cumsum(x[:, rows], 1)
                before = np.concatenate([np.zeros((len(sums), 1), np.int64), upto[:, starts[1:] - 1]], 1)
                carried = np.stack([at_scope(names[own[rows[s]]], key) for s in starts], 1)
                upto += np.repeat(carried - before, np.diff([*starts, len(rows)]), 1)
                for s, e in zip(starts, [*starts[1:], len(rows)]):
                    state[names[own[rows[s]]]] = key, upto[:, e - 1]
                taken = pa.array(rows)
                yield piece(part.column("scope").take(taken), key, place.take(taken), upto, part)
        if last is not None:
            yield piece(None, last[0], last[1], last[2], batch)

    return run


def scoped_totals(
    cells: DataFrame, scope: str, keys: Sequence[str], order: str, sums: Sequence[str], whole: str | None = None
) -> DataFrame:
    """(scope, keys..., order, <s>_upto, <s>_all): ``running_totals`` per (scope, keys) of whole-numbered ``sums``; with
    ``whole`` also those of all scopes together, under that name, one row per place of the order.

    Cells of all scopes lie side by side in ranges of (keys, order), so one sort serves the scopes and their whole.
    A range's sums are stored; what the ranges before it add is a table of about one row per scope, key and range that
    readers join, stored too where it is too large to broadcast.
    """
    keyed = [*map(named, keys), named(order)]
    inputs = cells.select(named(scope).alias("scope"), *keyed, *[F.col(s).cast("long").alias(s) for s in sums])
    # The ranges are sampled from the cells, so these are computed once before.
    stored_cells, path = written_at(inputs)
    ranged = stored_cells.repartitionByRange(*keyed).sortWithinPartitions(*keyed)
    kept = ["scope", *keys, order]
    flat = T.StructType([*[ranged.schema[c] for c in kept], *[T.StructField(f"{s}_in", T.LongType()) for s in sums]])
    local = written(ranged.mapInArrow(_added_up_by_scope(keys, order, sums, whole), flat).withColumn(BUCKET, F.spark_partition_id()))
    removed(cells.sparkSession, path)
    by = ["scope", *keys]
    ends = local.groupBy(*map(named, by), BUCKET).agg(F.max(F.struct(named(order), *[F.col(f"{s}_in") for s in sums])).alias("high"))
    here = {s: F.col(f"high.{s}_in") for s in sums}
    by_key = Window.partitionBy(*map(named, by))
    before = by_key.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = checkpointed(ends.select(
        *map(named, by), BUCKET,
        *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{s}_before") for s, x in here.items()],
        *[F.sum(x).over(by_key).alias(f"{s}_all") for s, x in here.items()],
    ))
    small = is_small(offsets, width=row_width(offsets))
    joined = join_with_nulls(local, F.broadcast(offsets) if small else offsets, [*by, BUCKET]).select(
        *map(named, kept), *[(F.col(f"{s}_in") + F.col(f"{s}_before")).alias(f"{s}_upto") for s in sums], *[F.col(f"{s}_all") for s in sums]
    )
    return joined if small else written(joined)


def between_points(low: Column, high: Column, part: Column) -> Column:
    """Linear interpolation; exact at both ends, and where both ends are equal."""
    return F.when(part >= 0.5, high - (high - low) * (1 - part)).otherwise(low + (high - low) * part)


def rank_quantiles(running: DataFrame, keys: Sequence[str], probs: Sequence[float], value: str = "value") -> DataFrame:
    """Exact linearly interpolated quantiles per key as the array ``edges``.

    ``running`` comes from ``running_totals`` over the count column ``n``. Each
    needed rank is picked out of the cell that covers it by a conditional
    maximum, which combines map-side: no group of values is collected.
    """
    first, last = F.col("n_upto") - F.col("n"), F.col("n_upto") - 1
    end = F.col("n_all") - 1
    picks = []
    for i, q in enumerate(probs):
        low = F.floor(end.cast("double") * F.lit(float(q)))
        high = F.least(low + 1, end)
        picks.append(F.max(F.when((low >= first) & (low <= last), F.col(value))).alias(f"low{i}"))
        picks.append(F.max(F.when((high >= first) & (high <= last), F.col(value))).alias(f"high{i}"))
    found = running.groupBy(*keys).agg(*picks, F.max("n_all").alias("n_all"))
    edges = []
    for i, q in enumerate(probs):
        place = end.cast("double") * F.lit(float(q))
        edges.append(between_points(F.col(f"low{i}"), F.col(f"high{i}"), place - F.floor(place)))
    return found.select(*keys, "n_all", F.array(*edges).alias("edges"))


def slots(df: DataFrame, points: dict[str, list[float]]) -> DataFrame:
    """Add ``<column>__slot``: how many of the column's ascending points are not above the value, by binary
    search; null for a missing value."""
    cut = [c for c, p in points.items() if p]
    if cut:
        df = Bucketizer(
            splitsArray=[[-math.inf, *points[c], math.inf] for c in cut], inputCols=cut,
            outputCols=[f"{c}__slot" for c in cut], handleInvalid="keep",
        ).transform(df)
    found = {c: F.col(f"`{c}__slot`").cast("int") if points[c] else F.lit(0) for c in points}
    return df.withColumns({f"{c}__slot": F.when(F.col(f"`{c}`").isNotNull(), x) for c, x in found.items()})


def plain_names(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> tuple[DataFrame, dict[str, str]]:
    """Features as doubles under names without dots or backticks, and those names by feature."""
    names = {f: f"f{i}" for i, f in enumerate(features)}
    return df.select(*map(named, keep), *[clean_double(f).alias(n) for f, n in names.items()]), names


def long_of(wide: DataFrame, keep: Sequence[str], parts: dict[str, Column]) -> DataFrame:
    """(keep..., feature, x): one struct per feature and row."""
    each = [F.struct(F.lit(f).alias("feature"), x.alias("x")) for f, x in parts.items()]
    return wide.select(*map(named, keep), F.explode(F.array(*each)).alias("_each")).select(*map(named, keep), "_each.feature", "_each.x")


def _marks(probs: Sequence[float]) -> list[float]:
    """Shares between which each wanted quantile is looked for: all lower ends, then all upper ends."""
    margin, ordered = 2 / SKETCH_ACCURACY, sorted(set(probs))
    return [max(0.0, q - margin) for q in ordered] + [min(1.0, q + margin) for q in ordered]


def _cells_by_search(df: DataFrame, features: Sequence[str], marks: dict[str, list[float]]) -> DataFrame:
    """``_bracketed_cells`` of the whole table: a binary search over a feature's few marks per value, at any number of quantiles."""
    wide, names = plain_names(df, features)
    points, parts = {}, {}
    for f, found in marks.items():
        lows, highs = sorted(found[: len(found) // 2]), sorted(found[len(found) // 2 :])
        points[names[f]] = sorted({*lows, *(math.nextafter(h, math.inf) for h in highs)})
        at = [-math.inf, *points[names[f]]]
        entered = [sum(low <= p for low in lows) for p in at]
        left = [sum(high < p for high in highs) for p in at]
        slot = F.col(f"{names[f]}__slot")
        pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), slot)  # noqa: B023, E731
        gap = pick([e == x for e, x in zip(entered, left)])
        floor = pick([highs[x - 1] if x else -math.inf for x in left])
        value = F.when(gap, floor).otherwise(F.col(names[f]))
        parts[f] = F.struct(pick(entered).alias(BUCKET), value.alias("value"), gap.alias("gap"))
    long = long_of(slots(wide, points), [], parts).select("feature", "x.*").where(F.col("value").isNotNull())
    return long.groupBy("feature", BUCKET, "value", "gap").agg(F.count("*").alias("n"))


def _bracketed_cells(df: DataFrame, features: Sequence[str], keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Value cells near the wanted quantiles, and one cell for everything between two of them.

    A sketch (combined map-side, bounded size) brackets each quantile. Only values
    inside a bracket keep a cell of their own, so the shuffle carries a few
    thousandths of the values. ``bucket`` numbers the brackets, ``gap`` marks the
    summed cells; the order (bucket, value, gap) is the order of the values.
    """
    marks = _marks(probs)
    if not keys:
        wide, names = plain_names(df, features)
        row = wide.agg(*[F.percentile_approx(n, marks, SKETCH_ACCURACY).alias(n) for n in names.values()]).first()
        return _cells_by_search(df, features, {f: row[n] for f, n in names.items() if row[n] is not None})
    group, m = [*keys, "feature"], len(marks) // 2
    long = to_long(df, features, keys)
    sketch = checkpointed(
        long.groupBy(*group).agg(F.percentile_approx("value", marks, SKETCH_ACCURACY).alias("marks"))
    )
    value = F.col("value")
    entered = reduce(Column.__add__, [(value >= F.element_at("marks", i + 1)).cast("int") for i in range(m)])
    left = reduce(Column.__add__, [(value > F.element_at("marks", m + i + 1)).cast("int") for i in range(m)])
    # A value is inside a bracket if it entered more of them than it left; the last one left ends below it.
    placed = join_checked(long, sketch, group).select(*group, "value", "marks", entered.alias(BUCKET), left.alias("_left"))
    floor = F.when(F.col("_left") == 0, F.lit(-math.inf)).otherwise(F.element_at("marks", F.lit(m) + F.col("_left")))
    gap = F.col(BUCKET) == F.col("_left")
    return (
        placed.select(*group, BUCKET, F.when(gap, floor).otherwise(value).alias("value"), gap.alias("gap"))
        .groupBy(*group, BUCKET, "value", "gap")
        .agg(F.count("*").alias("n"))
    )


def exact_quantiles(df: DataFrame, features: Sequence[str], keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Stored (keys..., feature, n_all, edges): exact interpolated quantiles of all features.

    Only values that a sketch places near a quantile are sorted. If a wanted rank should
    lie outside its bracket, all values are used.
    """
    group = [*keys, "feature"]
    df = df.select(*map(named, keys), *map(named, features))
    cells = _bracketed_cells(df, features, keys, probs)
    running = running_totals(cells, group, ["value", "gap"], ["n"], True)
    found = checkpointed(rank_quantiles(running.withColumn("value", F.when(~F.col("gap"), F.col("value"))), group, probs))
    if found.filter(F.exists("edges", lambda edge: edge.isNull())).isEmpty():
        return found
    cells, bucketed = value_cells(df, features, keys, {"n": F.count("*")})
    running = running_totals(cells, group, ["value"], ["n"], bucketed)
    return checkpointed(rank_quantiles(running, group, probs))


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_number") -> DataFrame:
    """1-based position of every row inside its key, in the given order.

    Range partitions replace the single-task window. Equal rows may be many, so
    a row id taken from the stored table breaks ties and lets them spread.
    """
    stored = checkpointed(df).withColumn("_row", F.monotonically_increasing_id())
    ordering = [*order, "_row"]
    ranged = checkpointed(
        stored.repartitionByRange(*keys, *ordering).withColumn("_part", F.spark_partition_id())
    )
    sizes = ranged.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_part").orderBy(*ordering)
    local = ranged.withColumn("_in", F.row_number().over(inside))
    return join_with_nulls(local, offsets, [*keys, "_part"]).select(
        *df.columns, (F.col("_in") + F.col("_offset")).alias(name)
    )


def contiguous_blocks(
    df: DataFrame,
    keys: Sequence[str],
    major: str,
    minor: Sequence[str],
    cuts: Column,
    name: str = "block",
) -> DataFrame:
    """Number rows by consecutive blocks of the order (major, minor...) per key.

    ``cuts`` is an array column, computable from ``keys``, of 0-based positions
    where a new block starts. Counts per ``major`` value decide the block of
    nearly all rows; only rows of a ``major`` value that a cut falls inside are
    ranked by ``minor``.
    """
    by_key = Window.partitionBy(*keys)
    running = by_key.orderBy(major).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*keys, major).agg(F.count("*").alias("_n"))

    def block_at(position: Column) -> Column:
        return F.size(F.filter(cuts, lambda cut: cut <= position))

    placed = checkpointed(
        counts.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
        .withColumn("_first", block_at(F.col("_before")))
        .withColumn("_last", block_at(F.col("_before") + F.col("_n") - 1))
    )
    whole = placed.filter("_first = _last").select(*keys, major, F.col("_first").alias(name))
    split = placed.filter("_first < _last").select(*keys, major, "_before")
    direct = join_with_nulls(df, whole, [*keys, major], checked=True).select(*df.columns, name)
    if split.isEmpty():
        return direct
    border = join_with_nulls(df, split, [*keys, major], checked=True)
    ranked = row_numbers(border, [*keys, major], minor, "_place")
    exact = ranked.withColumn(name, block_at(F.col("_before") + F.col("_place") - 1))
    return direct.unionByName(exact.select(*df.columns, name))
