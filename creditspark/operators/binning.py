"""Optimal one-dimensional tree bins for all features and scopes at once.

A leaf is an interval of a feature's sorted values. With running counts on the
value cells, the counts left of any cut follow by subtraction. Cells lie in stretches of
about equal numbers of rows. The gini gain is convex in the goods and bads on the left, so inside a stretch it
is at most what the corners between its first and last counts give. A round looks at the
few stretches first, and only cells of those that can beat the best cut known are joined and
compared; no cell is sorted or shuffled again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.scalars import floored, woe_of
from ..plans.longform import ORG, OVERALL, TARGET, named
from ..plans.ordered import running_totals, scoped_totals, value_cells
from ..plans.storage import BROADCAST_ROWS, checkpointed, join_checked, written

KEYS = ["scope", "feature"]
# Stretches of a feature's cells in a scope.
STRETCHES = 256


def binning_cells(
    df: DataFrame, features: Sequence[str], by_org: bool = True, target: str = TARGET
) -> DataFrame:
    """Stored value cells with running counts per (scope, feature).

    The overall scope is summed from the organisation cells, not from a second scan.
    """
    sums = {"n": F.count("*"), "bad": F.sum(target)}
    keep = [ORG, target] if by_org else [target]
    cells, bucketed = value_cells(df.select(*keep, *map(named, features)), features, [ORG] if by_org else [], sums)
    cells = cells.withColumnRenamed(ORG, "scope") if by_org else cells.withColumn("scope", F.lit(OVERALL))
    return with_running_counts(cells, bucketed, by_org)


def with_running_counts(cells: DataFrame, bucketed: bool, add_overall: bool = False) -> DataFrame:
    """Cells (scope, feature, value, n_upto, bad_upto, stretch) for the tree rounds, read from a stored table.

    ``add_overall`` adds the scope of all cells of a feature, whatever their own."""
    if bucketed:
        running = scoped_totals(cells, "scope", ["feature"], "value", ["n", "bad"], OVERALL if add_overall else None)
        return running.select(*KEYS, "value", "n_upto", "bad_upto", _stretch())
    if add_overall:
        cells = written(cells)
        overall = cells.groupBy("feature", "value").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        cells = cells.unionByName(overall.withColumn("scope", F.lit(OVERALL)))
    running = running_totals(cells, KEYS, ["value"], ["n", "bad"], False)
    return written(running.select(*KEYS, "value", "n_upto", "bad_upto", _stretch()))


def _stretch() -> Column:
    return F.floor((F.col("n_upto") - 1) / F.ceil(F.col("n_all") / STRETCHES)).cast("int").alias("stretch")


def stretches_of(cells: DataFrame) -> DataFrame:
    """(scope, feature, stretch, n0, bad0, n1, bad1): running counts of the first and the last cell of each stretch, stored."""
    return written(cells.groupBy(*KEYS, "stretch").agg(
        F.min("n_upto").alias("n0"), F.min("bad_upto").alias("bad0"), F.max("n_upto").alias("n1"), F.max("bad_upto").alias("bad1")
    ))


def _purity(n: Column, bad: Column) -> Column:
    """Sum of squared class counts over the size; higher is purer."""
    bads, goods = bad.cast("double"), (n - bad).cast("double")
    return F.try_divide(bads * bads + goods * goods, n)


def _gain(n: Column, bad: Column) -> Column:
    """Gini gain of a cut of a node (columns ``n`` and ``bad``) with ``n`` rows, ``bad`` of them bad, on the left."""
    sides = _purity(n, bad), _purity(F.col("n") - n, F.col("bad") - bad)
    return F.coalesce(sides[0], F.lit(0.0)) + F.coalesce(sides[1], F.lit(0.0)) - _purity(F.col("n"), F.col("bad"))


def _promising(stretches: DataFrame, open_nodes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Open nodes with the stretches whose cells may hold their best cut; columns ``keep`` of the stretches stay."""
    def inside(n_upto: str) -> Column:
        n = F.col(n_upto) - F.col("start_n")
        return (n >= F.col("min_leaf")) & (F.col("n") - n >= F.col("min_leaf"))

    def held(value: Column, most: Column) -> Column:
        return F.least(F.greatest(value, F.lit(0)), most)

    bads = [held(F.col(f"bad{k}") - F.col("start_bad"), F.col("bad")) for k in "01"]
    start_good = F.col("start_n") - F.col("start_bad")
    goods = [held(F.col(f"n{k}") - F.col(f"bad{k}") - start_good, F.col("n") - F.col("bad")) for k in "01"]
    most = F.greatest(*[_gain(g + b, b) for g in goods for b in bads])
    seen = F.greatest(*[F.when(inside(f"n{k}"), _gain(F.col(f"n{k}") - F.col("start_n"), F.col(f"bad{k}") - F.col("start_bad"))) for k in "01"])
    reaching = (F.col("n1") - F.col("start_n") >= F.col("min_leaf")) & (F.col("start_n") + F.col("n") - F.col("n0") >= F.col("min_leaf"))
    rated = stretches.join(open_nodes, KEYS).filter(reaching).withColumn("most", most).withColumn("seen", seen)
    best = F.max("seen").over(Window.partitionBy(*KEYS, "id"))  # a bounded number of stretches a node
    slack = F.lit(1e-9) * F.col("n")  # of rounding
    return rated.withColumn("sure", best).filter(F.col("sure").isNull() | (F.col("most") + slack >= F.col("sure"))).select(
        *open_nodes.columns, "stretch", *keep
    )


def _best_cuts(cells: DataFrame, stretches: DataFrame, open_nodes: DataFrame, small: bool) -> DataFrame:
    """Best cut of each open node: highest gini gain, then lowest threshold.

    ``small`` says that there are few enough open nodes to broadcast with their stretches."""
    chosen = _promising(stretches, F.broadcast(open_nodes) if small else open_nodes)
    return best_of(cells.join(F.broadcast(chosen) if small else chosen, [*KEYS, "stretch"]))


def best_of(cells: DataFrame) -> DataFrame:
    """Best cut of each node among the cells that are joined to it."""
    n, bad = F.col("n_upto") - F.col("start_n"), F.col("bad_upto") - F.col("start_bad")
    inside = (n >= F.col("min_leaf")) & (F.col("n") - n >= F.col("min_leaf"))
    tried = cells.filter(inside).select(
        *KEYS, "id", _gain(n, bad).alias("gain"), n.alias("cut_n"), bad.alias("cut_bad")
    )
    # Running counts grow with the value, so the lowest count is that of the lowest threshold.
    first = F.struct("gain", (-F.col("cut_n")).alias("low"), "cut_n", "cut_bad")
    best = tried.groupBy(*KEYS, "id").agg(F.max(first).alias("b"))
    return best.select(*KEYS, "id", F.struct("b.gain", "b.cut_n", "b.cut_bad").alias("best"))


NODE = (
    "struct<id:bigint, start_n:bigint, start_bad:bigint, n:bigint, bad:bigint, tested:boolean, "
    "gain:double, cut_n:bigint, cut_bad:bigint>"
)


def _node(node_id: str, start_n: str, start_bad: str, n: str, bad: str) -> str:
    return (
        f"CAST(named_struct('id', {node_id}, 'start_n', {start_n}, 'start_bad', {start_bad}, 'n', {n}, 'bad', {bad}, "
        f"'tested', false, 'gain', NULL, 'cut_n', NULL, 'cut_bad', NULL) AS {NODE})"
    )


def _with_choice(state: DataFrame, n_bins: int) -> DataFrame:
    """Add ``chosen``, the node ids a best-first tree splits as far as nodes are tested,
    and ``open``, the untested children of chosen nodes that may be cut."""
    reachable = "(x.id = 1 OR array_contains({c}, x.id DIV 2))"
    pick = (
        "array_max(transform(filter(nodes, x -> x.gain IS NOT NULL AND NOT array_contains(c, x.id) AND "
        f"{reachable.format(c='c')}), x -> struct(x.gain, -x.start_n AS low, x.id AS id))).id"
    )
    chosen = (
        f"aggregate(sequence(1, {n_bins - 1}), CAST(array() AS array<bigint>), "
        f"(c, i) -> concat(c, array_compact(array({pick}))))"
    )
    return state.withColumn("chosen", F.expr(chosen)).withColumn(
        "open",
        F.expr(
            f"filter(nodes, x -> NOT x.tested AND {reachable.format(c='chosen')} "
            "AND x.bad > 0 AND x.bad < x.n AND x.n >= 2 * min_leaf)"
        ),
    )


def tree_leaves(cells: DataFrame, n_bins: int, min_share: float = config.WOE_MIN_BIN_SHARE) -> DataFrame:
    """``grown_leaves`` of a stored table of all cells."""
    stretches = stretches_of(cells)
    return grown_leaves(stretches, lambda nodes, small: _best_cuts(cells, stretches, nodes, small), n_bins, min_share)


def grown_leaves(
    stretches: DataFrame,
    best_cuts: Callable[[DataFrame, bool], DataFrame],
    n_bins: int,
    min_share: float = config.WOE_MIN_BIN_SHARE,
) -> DataFrame:
    """Leaves of the best-first gini tree: (scope, feature, start_n, start_bad, leaf_n, leaf_bad).

    ``best_cuts`` finds those of open nodes, and is told whether the nodes are few.
    ``start_n`` counts the rows below the leaf. The open leaf with the highest gain is
    split first (ties: the lower leaf), until ``n_bins`` leaves exist or no allowed cut
    is left. A pure leaf is never split. A (scope, feature) with too few values or one
    class only has no leaves.

    The best cut of a node does not depend on the other nodes, so one pass tests all
    nodes the tree may still need. Passes follow the depth of the tree, not the number
    of its leaves. The state is one row of a few dozen nodes per (scope, feature).
    """
    totals = stretches.groupBy(*KEYS).agg(F.max("n1").alias("n"), F.max("bad1").alias("bad"))
    roots = totals.filter((F.col("n") >= config.MIN_VALUES_TO_BIN) & F.col("bad").between(1, F.col("n") - 1))
    state = roots.select(
        *KEYS,
        F.ceil(F.lit(float(min_share)) * F.col("n")).alias("min_leaf"),
        F.expr(f"array({_node('1', '0', '0', 'n', 'bad')})").alias("nodes"),
    )
    if n_bins > 1:
        state = checkpointed(_with_choice(state, n_bins))
        # A node is open at most once per pass, and at most two per split.
        small = state.count() * 2 * (n_bins - 1) * STRETCHES <= BROADCAST_ROWS
        left = _node("x.id * 2", "x.start_n", "x.start_bad", "x.cut_n", "x.cut_bad")
        right = _node(
            "x.id * 2 + 1", "x.start_n + x.cut_n", "x.start_bad + x.cut_bad", "x.n - x.cut_n", "x.bad - x.cut_bad"
        )
        tested = F.expr(
            "transform(nodes, x -> IF(array_contains(transform(open, o -> o.id), x.id), struct(x.id, x.start_n, "
            "x.start_bad, x.n, x.bad, true AS tested, cuts[x.id].gain AS gain, cuts[x.id].cut_n AS cut_n, "
            "cuts[x.id].cut_bad AS cut_bad), x))"
        )
        children = F.expr(
            "flatten(transform(filter(nodes, x -> x.gain IS NOT NULL AND array_contains(transform(open, o -> o.id), "
            f"x.id)), x -> array({left}, {right})))"
        )
        while not (waiting := state.filter("size(open) > 0")).isEmpty():
            open_nodes = waiting.select(*KEYS, "min_leaf", F.inline("open")).drop("tested", "gain", "cut_n", "cut_bad")
            cuts = best_cuts(open_nodes, small)
            by_key = cuts.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(F.struct("id", "best"))).alias("cuts"))
            grown = (
                state.join(by_key, KEYS, "left")
                .withColumn("nodes", tested)
                .select(*KEYS, "min_leaf", F.concat("nodes", children).alias("nodes"))
            )
            state = checkpointed(_with_choice(grown, n_bins))
        leaves = "filter(nodes, x -> NOT array_contains(chosen, x.id) AND (x.id = 1 OR array_contains(chosen, x.id DIV 2)))"
    else:
        leaves = "nodes"
    return state.select(*KEYS, F.expr(f"inline({leaves})")).select(
        *KEYS, "start_n", "start_bad", F.col("n").alias("leaf_n"), F.col("bad").alias("leaf_bad")
    )


def leaf_stats(leaves: DataFrame) -> DataFrame:
    """Bins in value order with bad rate, WOE and their part of the information value."""
    whole = Window.partitionBy(*KEYS)
    counted = leaves.select(
        *KEYS,
        (F.row_number().over(whole.orderBy("start_n")) - 1).alias("bin"),
        "start_n",
        F.col("leaf_n").alias("n"),
        F.col("leaf_bad").alias("bad"),
        F.sum("leaf_n").over(whole).alias("n_all"),
        F.sum("leaf_bad").over(whole).alias("bad_all"),
    )
    good_share = (F.col("n") - F.col("bad")) / (F.col("n_all") - F.col("bad_all"))
    bad_share = F.col("bad") / F.col("bad_all")
    woe = woe_of(good_share, bad_share)
    return counted.select(
        *KEYS,
        "bin",
        "start_n",
        "n",
        "bad",
        (F.col("bad") / F.col("n")).alias("bad_rate"),
        woe.alias("woe"),
        ((floored(good_share) - floored(bad_share)) * woe).alias("iv_part"),
    )


def bin_ranges(cells: DataFrame, stats: DataFrame) -> DataFrame:
    """Add each bin's lowest and highest seen value as ``low`` and ``high``."""
    spans = stats.select(*KEYS, "bin", "start_n", F.col("n").alias("bin_n"))
    inside = (F.col("n_upto") > F.col("start_n")) & (F.col("n_upto") <= F.col("start_n") + F.col("bin_n"))
    limits = (
        join_checked(cells, spans, KEYS)
        .filter(inside)
        .groupBy(*KEYS, "bin")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
    )
    return stats.join(limits, [*KEYS, "bin"]).select(
        *KEYS, "bin", "low", "high", "n", "bad", "bad_rate", "woe", "iv_part"
    )
