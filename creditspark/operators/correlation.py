"""Pairwise correlation of features, its filter, and variance inflation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import texts
from ..plans.longform import TARGET, clean_double, varying_numeric_features
from ..plans.storage import checkpointed
from .iv import information_value

# Columns are paired tile by tile; a task holds the sums of so many pairs of tiles at a time (about 100 MB).
TILE = 64
TILE_PAIRS = 512
# The tables of all tasks are added up in this many places first.
PLACES = 32
SUMS = ("n", "xy", "x", "xx", "y", "yy")
# A spread below this part of the sum of squares is rounding, not variation.
NO_SPREAD = 1e-12

_TILES = "a int, b int, place int, sums array<double>"


def _products(pairs: Sequence[tuple[int, int]], tiles: dict[int, tuple[int, int]], width: int):
    """Per pair of tiles the six sums of all their column pairs, over the rows of a task, then the centres of both
    tiles' columns. ``tiles`` are stretches of the ``width`` columns read.

    A column's centre is the middle value of the first batch in which it has any: near the mean, and the
    value itself where there is only one. Before that batch the column adds nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {pair: np.zeros((len(SUMS), tiles[pair[0]][1] - tiles[pair[0]][0], tiles[pair[1]][1] - tiles[pair[1]][0])) for pair in pairs}
        centre = np.full(width, np.nan)
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)], 1).astype(float)
            known = ~np.isnan(x)
            for i in np.flatnonzero(np.isnan(centre) & known.any(0)):
                own = np.sort(x[known[:, i], i])
                centre[i] = own[len(own) // 2]
            x, known = np.nan_to_num(x - centre), known.astype(float)
            square = x * x
            for (a, b), sums in total.items():
                p, q = slice(*tiles[a]), slice(*tiles[b])
                for k, (left, right) in enumerate(((known, known), (x, x), (x, known), (square, known), (known, x), (known, square))):
                    sums[k] += left[:, p].T @ right[:, q]
        place = TaskContext.get().partitionId() % PLACES
        for (a, b), sums in total.items():
            flat = np.concatenate([sums.ravel(), centre[slice(*tiles[a])], centre[slice(*tiles[b])]])
            lists = pa.ListArray.from_arrays(pa.array([0, flat.size], pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int32()) for x in (a, b, place)] + [lists], ["a", "b", "place", "sums"])

    return run


def _common(centres: np.ndarray) -> np.ndarray:
    """Per column the middle one of the centres of the tasks that have values; 0 without any."""
    known = np.sort(centres, 0)  # missing ones come last
    count = (~np.isnan(known)).sum(0)
    return np.where(count > 0, known[np.maximum(count - 1, 0) // 2, np.arange(known.shape[1])], 0.0)


def _added(sizes: dict[int, tuple[int, int]]):
    """One table of sums out of those of a group, moved to common centres and added in the order of their values so
    that the result doesn't depend on the tasks' order. ``sizes`` are the stretches of the tiles."""

    def run(table: pa.Table) -> pa.Table:
        p, q = (sizes[table.column(c)[0].as_py()][1] - sizes[table.column(c)[0].as_py()][0] for c in "ab")
        found = np.stack([row.values.to_numpy() for row in table.column("sums")])
        left, right = found[:, -p - q : -q], found[:, -q:]
        centres = _common(left), _common(right)
        n, xy, x, xx, y, yy = np.moveaxis(found[:, : -p - q].reshape(-1, len(SUMS), p, q), 1, 0)
        d = np.nan_to_num(left - centres[0])[:, :, None]
        e = np.nan_to_num(right - centres[1])[:, None, :]
        moved = np.stack([n, xy + e * x + d * y + n * d * e, x + n * d, xx + 2 * d * x + n * d * d, y + n * e, yy + 2 * e * y + n * e * e], 1)
        total = np.sort(moved, axis=0).sum(0).ravel()
        return table.slice(0, 1).set_column(3, "sums", pa.array([np.concatenate([total, *centres])], pa.list_(pa.float64())))

    return run


def _pair_rows(tiles: dict[int, tuple[int, int]]):
    """Rows (i, j, sums...) of the column pairs of a pair of tiles, each pair once."""

    def run(table: pa.Table) -> pa.Table:
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        (a0, a1), (b0, b1) = tiles[a], tiles[b]
        flat = _added(tiles)(table).column("sums")[0].values.to_numpy()
        sums = flat[: len(SUMS) * (a1 - a0) * (b1 - b0)].reshape(len(SUMS), a1 - a0, b1 - b0)
        i, j = np.meshgrid(np.arange(a0, a1), np.arange(b0, b1), indexing="ij")
        own = i < j
        columns = {"i": i[own].astype(np.int32), "j": j[own].astype(np.int32)}
        return pa.table(columns | {name: sums[k][own] for k, name in enumerate(SUMS)})

    return run


def _tile_pairs(n: int) -> list[list[tuple[int, int]]]:
    """All pairs of tiles, in passes that a task can hold."""
    count = -(-n // TILE)
    pairs = [(a, b) for a in range(count) for b in range(a, count)]
    return [pairs[k : k + TILE_PAIRS] for k in range(0, len(pairs), TILE_PAIRS)]


def correlation_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature_1, feature_2, r) for all pairs in list order, over rows where both have values.

    ``r`` is null where one side does not vary on those rows. Every task centres columns for accuracy, so ``df`` is evaluated once.
    Every task adds up cross products per pair of tiles of columns; the tables of the tasks are added up in a few
    places per pair of tiles and then become rows, so no task holds sums of all pairs and
    no row is wider than a tile. Very many columns take more than one pass, each over the columns it needs.
    """
    names = list(features)
    if len(names) < 2:
        return df.sparkSession.range(0).selectExpr("'' AS feature_1", "'' AS feature_2", "CAST(0 AS DOUBLE) AS r")
    wide = df.select(*[clean_double(f).alias(f"x{i}") for i, f in enumerate(names)])
    passes = []
    for pairs in _tile_pairs(len(names)):
        used = sorted({t for pair in pairs for t in pair})
        columns, inner, outer = [], {}, {}
        for t in used:
            outer[t] = (t * TILE, min(len(names), (t + 1) * TILE))
            inner[t] = (len(columns), len(columns) + outer[t][1] - outer[t][0])
            columns += wide.columns[slice(*outer[t])]
        sums = wide.select(*columns).mapInArrow(_products(pairs, inner, len(columns)), _TILES)
        few = sums.groupBy("a", "b", "place").applyInArrow(_added(outer), _TILES)
        flat = "i int, j int, " + ", ".join(f"{name} double" for name in SUMS)
        passes.append(few.groupBy("a", "b").applyInArrow(_pair_rows(outer), flat))
    s = reduce(DataFrame.unionByName, passes)
    spread = [F.col("n") * F.col(f"{v}{v}") - F.col(v) * F.col(v) for v in "xy"]
    varies = [d > NO_SPREAD * F.col("n") * F.col(f"{v}{v}") for d, v in zip(spread, "xy")]
    r = F.when(varies[0] & varies[1], (F.col("n") * F.col("xy") - F.col("x") * F.col("y")) / F.sqrt(spread[0] * spread[1]))
    label = F.array(*[F.lit(name) for name in names])
    return s.select(
        F.get(label, F.col("i")).alias("feature_1"), F.get(label, F.col("j")).alias("feature_2"), r.alias("r")
    )


def high_pairs(pairs: DataFrame, threshold: float = config.CORRELATION_THRESHOLD) -> DataFrame:
    """Pairs whose absolute correlation exceeds the threshold, rounded to 4 digits."""
    size = F.abs("r")
    return pairs.filter(size > threshold).select(
        "feature_1", "feature_2", F.bround(size, 4).alias("r")
    )


def pairs_with_iv(pairs: DataFrame, iv: DataFrame) -> DataFrame:
    """Both features' information values next to each pair, 0 where unknown."""
    for side in ("1", "2"):
        known = iv.select(F.col("feature").alias(f"feature_{side}"), F.col("iv").alias(f"iv_{side}"))
        pairs = pairs.join(known, f"feature_{side}", "left")
    return pairs.select(
        "feature_1", "feature_2", "r",
        F.coalesce("iv_1", F.lit(0.0)).alias("iv_1"), F.coalesce("iv_2", F.lit(0.0)).alias("iv_2"),
    )


def greedy_drops(
    pairs: Sequence[tuple[str, str, float, float, float]], order: Sequence[str], threshold: float
) -> list[tuple[str, str]]:
    """(feature, reason): walk the pairs by (second, first) feature position and drop
    the one with the lower value, the first on a tie; pairs already broken are skipped."""
    place = {f: i for i, f in enumerate(order)}
    dropped: dict[str, str] = {}
    for a, b, r, iv_a, iv_b in sorted(pairs, key=lambda p: (place[p[1]], place[p[0]])):
        if a in dropped or b in dropped:
            continue
        (loser, low), (winner, high) = ((a, iv_a), (b, iv_b)) if iv_a <= iv_b else ((b, iv_b), (a, iv_a))
        dropped[loser] = texts.CORRELATED % (winner, f"{r:.4f}", threshold, f"{low:.4f}", f"{high:.4f}")
    return list(dropped.items())


def correlation_drops(
    df: DataFrame, features: Sequence[str], threshold: float = config.CORRELATION_THRESHOLD, target: str = TARGET
) -> tuple[DataFrame, DataFrame]:
    """High pairs and the drop list (feature, reason). Only features inside a high
    pair need an information value; the walk sees the pair list, never rows."""
    spark = df.sparkSession
    pairs = checkpointed(high_pairs(correlation_pairs(df, features), threshold))
    involved = sorted({f for r in pairs.collect() for f in (r.feature_1, r.feature_2)})
    drops: list[tuple[str, str]] = []
    if involved:
        rated = pairs_with_iv(pairs, information_value(df, involved, target))
        drops = greedy_drops([tuple(r) for r in rated.collect()], features, threshold)
    rows = [F.struct(F.lit(f).alias("feature"), F.lit(why).alias("reason")) for f, why in drops]
    table = spark.range(1).select(F.inline(F.array(*rows))) if rows else (
        spark.range(0).selectExpr("'' AS feature", "'' AS reason"))
    return pairs, table


def filter_correlation(
    df: DataFrame, threshold: float = config.CORRELATION_THRESHOLD
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Narrowed sample, high pairs and drop list. Text features pass."""
    pairs, drops = correlation_drops(df, varying_numeric_features(df), threshold)
    return df.drop(*[r.feature for r in drops.collect()]), pairs, drops


def variance_inflation(
    df: DataFrame, features: Sequence[str], threshold: float = config.VIF_THRESHOLD
) -> DataFrame:
    """(feature, vif, high): diagonal of the inverse correlation matrix, whose size is
    the number of features. A feature that others determine has an infinite value."""
    names = list(features)
    place = {f: i for i, f in enumerate(names)}
    matrix = np.eye(len(names))
    for row in correlation_pairs(df, names).collect():
        i, j = place[row.feature_1], place[row.feature_2]
        matrix[i, j] = matrix[j, i] = 0.0 if row.r is None else row.r
    sizes, vectors = np.linalg.eigh(matrix)
    lost = sizes < 1e-8
    factors = (vectors[:, ~lost] ** 2 / sizes[~lost]).sum(axis=1)
    factors[(vectors[:, lost] ** 2 > 1e-8).any(axis=1)] = np.inf
    rows = [
        F.struct(F.lit(f).alias("feature"), F.lit(float(v)).alias("vif"), F.lit(bool(v > threshold)).alias("high"))
        for f, v in zip(names, factors)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))
