"""Tree bins from scans of the rows, without a table of all values.

One scan counts rows and bads per scope, feature and stretch of values. Running counts at the ends of stretches are
exact, and bound the gain of every cut inside one (see ``binning``). A round of the tree reads the rows once more, but only
values of stretches that can hold a best cut leave the scan, are counted and sorted. The limits of stretches come
from a sample and only steer the work: results are exact for any limits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..plans.longform import ORG, OVERALL, TARGET, clean_double, named
from ..plans.storage import reads_stored, written
from .binning import KEYS, _promising, best_of, binning_cells, grown_leaves, tree_leaves

# A cut's bound exceeds what noise does to its gain by little if stretches grow as the root of the rows.
STRETCHES_PER_ROOT = 4
MAX_STRETCHES = 65_536
# Limits of all features together, and rows of the sample that sets them.
LIMITS = 524_288
SAMPLE_ROWS = 1_000_000
# Sums that a task holds at a time.
HELD = 4_000_000
# Stretches that a round lists by scope; of more, those of any scope are read.
LISTED = 500_000

_COUNTS = "scope string, f int, stretch int, single boolean, n bigint, bad bigint"
_VALUES = "scope string, f int, stretch int, value double, bad bigint"


def _limits(rows: DataFrame, columns: Sequence[str]) -> list[np.ndarray]:
    """Ascending ends of the stretches of each column, each end inside its stretch. A frequent value has a stretch of its own."""
    n = rows.count()
    count = max(16, min(math.isqrt(n) * STRETCHES_PER_ROOT, MAX_STRETCHES, LIMITS // len(columns)))
    part = rows.sample(SAMPLE_ROWS / n, 1) if n > SAMPLE_ROWS else rows
    marks = F.split(F.lit(",".join(repr(k / count) for k in range(count + 1))), ",").cast("array<double>")
    found = part.agg(*[F.percentile_approx(c, marks, max(10_000, 2 * count)).alias(c) for c in columns]).first()
    limits = []
    for c in columns:
        ends, times = np.unique(np.array(found[c] or [], float), return_counts=True)
        alone = ends if 2 * len(ends) <= count else ends[times > 1]
        limits.append(np.union1d(ends, np.nextafter(alone, -np.inf)))
    return limits


def _single(limits: np.ndarray) -> np.ndarray:
    """Which stretches can hold one value only; the last one is above all limits."""
    return np.concatenate([[False], limits[:-1] == np.nextafter(limits[1:], -np.inf), [False]])[: len(limits) + 1]


def _scopes(batch: pa.RecordBatch) -> tuple[list, np.ndarray]:
    """Names of the scopes of a batch, null last, and each row's place among them."""
    coded = batch.column("scope").dictionary_encode()
    names = coded.dictionary.to_pylist()
    return [*names, None], coded.indices.fill_null(len(names)).to_numpy(zero_copy_only=False)


def _bads(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("bad").fill_null(0).to_numpy(zero_copy_only=False)


def _placed(batch: pa.RecordBatch, column: str, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that have a value, by value, their stretches and their values."""
    x = batch.column(column).to_numpy(zero_copy_only=False)
    order = np.argsort(x)  # missing ones come last; sorted values are found much faster
    x = x[order]
    x = x[: np.searchsorted(x, np.nan)]
    return order[: len(x)], np.searchsorted(limits, x), x


def _counted(columns: Sequence[str], limits: Sequence[np.ndarray]):
    """Rows and bads per scope, column and stretch over the rows of a task, in one table as long as that can be held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = np.cumsum([0, *[len(x) + 1 for x in limits]])
        size, single = int(starts[-1]), np.concatenate([_single(x) for x in limits])
        held: dict = {}  # place of each scope
        sums = np.zeros((2, 0), np.int64)

        def found(names, places, n, bad):
            scope, at = np.divmod(places, size)
            f = np.searchsorted(starts, at, "right") - 1
            columns = [pa.array(names, pa.string()).take(pa.array(scope)), pa.array(f.astype(np.int32)), pa.array((at - starts[f]).astype(np.int32))]
            whole = pa.RecordBatch.from_arrays([*columns, pa.array(single[at]), pa.array(n), pa.array(bad)], ["scope", "f", "stretch", "single", "n", "bad"])
            for k in range(0, len(whole), 100_000):
                yield whole.slice(k, 100_000)

        for batch in batches:
            names, own = _scopes(batch)
            bads = _bads(batch)
            parts = []
            for c, start, ends in zip(columns, starts, limits):
                known, stretch, _ = _placed(batch, c, ends)
                parts.append((known, stretch + start))
            known, at = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            if len(held.keys() | set(names)) * size > HELD:
                keys, back = np.unique(own[known] * size + at, return_inverse=True)
                yield from found(names, keys, np.bincount(back, minlength=len(keys)), np.bincount(back, bads[known], len(keys)).astype(np.int64))
                continue
            for name in names:
                held.setdefault(name, len(held))
            if len(held) * size > sums.shape[1]:
                sums = np.pad(sums, ((0, 0), (0, len(held) * size - sums.shape[1])))
            at = at + np.array([held[name] for name in names])[own[known]] * size
            np.add.at(sums[0], at, 1)
            bad = np.flatnonzero(bads[known])
            np.add.at(sums[1], at[bad], bads[known[bad]])
        seen = np.flatnonzero(sums[0])
        if len(seen):
            yield from found([*held], seen, sums[0][seen], sums[1][seen])

    return run


def _values_inside(columns: dict[int, str], limits: dict[int, np.ndarray], chosen: dict[int, dict], whole: str | None):
    """(scope, f, stretch, value, bad) of the values in the ``chosen`` stretches, per column and scope; under the
    scope None those of every scope. With ``whole`` a value also counts in that scope."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        any_scope = {}
        for f, by_scope in chosen.items():
            any_scope[f] = np.zeros(len(limits[f]) + 1, bool)
            for stretches in by_scope.values():
                any_scope[f][stretches] = True
        for batch in batches:
            names, own = _scopes(batch)
            bads = _bads(batch)
            for f, by_scope in chosen.items():
                rows, stretch, x = _placed(batch, columns[f], limits[f])
                near = np.flatnonzero(any_scope[f][stretch])
                rows, stretch, x = rows[near], stretch[near], x[near]
                scopes = own[rows]
                sides = [(name, np.flatnonzero(scopes == k)) for k, name in enumerate(names) if name is not None]
                if whole is not None:
                    sides.append((whole, np.arange(len(rows))))
                for name, at in sides:
                    wanted = by_scope.get(None, by_scope.get(name))
                    if wanted is None or not len(at):
                        continue
                    if None not in by_scope:
                        place = np.minimum(np.searchsorted(wanted, stretch[at]), len(wanted) - 1)
                        at = at[wanted[place] == stretch[at]]
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name], pa.string()).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, f, np.int32)),
                         pa.array(stretch[at].astype(np.int32)), pa.array(x[at]), pa.array(bads[rows[at]])],
                        ["scope", "f", "stretch", "value", "bad"])

    return run


def _running(order: str, *keys: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def scanned_leaves(
    df: DataFrame,
    features: Sequence[str],
    n_bins: int,
    by_org: bool = True,
    target: str = TARGET,
    min_share: float = config.WOE_MIN_BIN_SHARE,
) -> DataFrame:
    """``tree_leaves`` of the rows' value cells, for the whole sample and with ``by_org`` for every organisation.

    Rows that do not come from a stored table are stored first, as every round reads them.
    """
    if not features:
        return tree_leaves(binning_cells(df, features, by_org, target), n_bins, min_share)
    scope = named(ORG).cast("string") if by_org else F.lit(OVERALL)
    columns = [f"x{f}" for f in range(len(features))]
    rows = df.select(scope.alias("scope"), named(target).cast("bigint").alias("bad"), *[clean_double(f).alias(c) for f, c in zip(features, columns)])
    rows = rows if reads_stored(df) else written(rows)
    limits, whole = _limits(rows, columns), OVERALL if by_org else None

    counts = rows.mapInArrow(_counted(columns, limits), _COUNTS).groupBy("scope", "f", "stretch", "single")
    counts = written(counts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    if by_org:
        overall = counts.groupBy("f", "stretch", "single").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        counts = counts.unionByName(overall.withColumn("scope", F.lit(OVERALL)))
    upto = {s: F.sum(s).over(_running("stretch", "scope", "f")) for s in ("n", "bad")}
    stretches = written(counts.select(
        "scope", F.get(F.array(*map(F.lit, features)), F.col("f")).alias("feature"), "f", "stretch", (F.col("single") | (F.col("n") == 1)).alias("single"),
        *[(x - F.col(s)).alias(f"{s}0") for s, x in upto.items()], *[x.alias(f"{s}1") for s, x in upto.items()],
    ))

    def best_cuts(open_nodes: DataFrame, small: bool) -> DataFrame:
        kept = ("f", "n0", "bad0", "n1", "bad1", "single")
        near = written(_promising(stretches, F.broadcast(open_nodes) if small else open_nodes, kept))
        ends = near.withColumnsRenamed({"n1": "n_upto", "bad1": "bad_upto"})
        inside = near.filter(~F.col("single"))
        listed = inside.select("scope", "f", "stretch").distinct()
        table = listed.limit(LISTED + 1).toArrow()
        if len(table) > LISTED:
            table = listed.select(F.lit(None).cast("string").alias("scope"), "f", "stretch").distinct().toArrow()
        chosen: dict[int, dict] = {}
        for key in table.group_by(["scope", "f"]).aggregate([("stretch", "list")]).to_pylist():
            chosen.setdefault(key["f"], {})[key["scope"]] = np.sort(key["stretch_list"])
        if not chosen:
            return best_of(ends)
        used = {f: columns[f] for f in chosen}
        values = rows.select("scope", "bad", *used.values()).mapInArrow(
            _values_inside(used, {f: limits[f] for f in chosen}, chosen, whole), _VALUES)
        cells = values.groupBy("scope", "f", "stretch", "value").agg(F.count("*").alias("cell_n"), F.sum("bad").alias("cell_bad"))
        here = {s: F.sum(f"cell_{s}").over(_running("value", "scope", "f", "stretch")) for s in ("n", "bad")}
        cells = cells.select("scope", "f", "stretch", *[x.alias(f"{s}_in") for s, x in here.items()])
        met = inside.join(cells, ["scope", "f", "stretch"]).withColumns({f"{s}_upto": F.col(f"{s}0") + F.col(f"{s}_in") for s in ("n", "bad")})
        shown = [*open_nodes.columns, "n_upto", "bad_upto"]
        return best_of(ends.select(*shown).unionByName(met.select(*shown)))

    return grown_leaves(stretches, best_cuts, n_bins, min_share)
