"""Boosting against a plain version that grows leaf by leaf, codes of texts, shuffled labels and the Parzen search."""

from __future__ import annotations

import heapq
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspark.operators import boosting, encode, parzen, trees
from creditspark.operators.boosting import Settings

BINS = 9


def plain_model(x, y, weights_of, s: Settings, keep):
    """Trees as nested (feature, limit, missing_left, gain, left, right) or leaf values."""
    unit = boosting.UNIT
    base = math.log(y[keep].sum() * s.bad_weight / (1 - y[keep]).sum())
    score, out = np.full(len(y), base), []
    strength = lambda g, h: max(abs(g) - s.l1, 0) ** 2 / (h + s.l2)
    value = lambda g, h: -s.rate * math.copysign(max(abs(g) - s.l1, 0), g) / (h + s.l2)
    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = np.rint(weights_of * (p - y) * unit) / unit, np.rint(weights_of * p * (1 - p) * unit) / unit

        def best(rows):
            found = None
            for f in range(x.shape[0]):
                for missing_left in (False, True):
                    if missing_left and not (x[f, rows] == 0).any():
                        continue
                    for limit in range(1, BINS):
                        goes = np.where(x[f, rows] == 0, missing_left, x[f, rows] <= limit)
                        a, b = rows[goes], rows[~goes]
                        if min(len(a), len(b)) < max(1, s.least_rows) or min(h[a].sum(), h[b].sum()) < s.least_hessian:
                            continue
                        gain = strength(g[a].sum(), h[a].sum()) + strength(g[b].sum(), h[b].sum()) - strength(g[rows].sum(), h[rows].sum())
                        if gain > max(s.least_gain, 1e-12) and (found is None or gain > found[0] + 1e-9):
                            found = (gain, f, limit, missing_left, a, b)
            return found

        root = {"rows": np.flatnonzero(keep), "depth": 0}
        ready, leaves, order = [], 1, 0

        def offer(node):
            nonlocal order
            node["split"] = best(node["rows"]) if node["depth"] < s.depth and len(node["rows"]) >= 2 * s.least_rows else None
            if node["split"]:
                heapq.heappush(ready, (-node["split"][0], order, node))
            order += 1

        offer(root)
        while ready and (s.leaves is None or leaves < s.leaves):
            node = heapq.heappop(ready)[2]
            node["sides"] = [{"rows": r, "depth": node["depth"] + 1} for r in node["split"][4:]]
            leaves += 1
            for side in node["sides"]:
                offer(side)

        def walk(node, rows):
            if "sides" not in node:
                own = value(g[node["rows"]].sum(), h[node["rows"]].sum())
                score[rows] += own
                return own
            gain, f, limit, missing_left = node["split"][:4]
            goes = np.where(x[f, rows] == 0, missing_left, x[f, rows] <= limit)
            return (f, limit, missing_left, gain, walk(node["sides"][0], rows[goes]), walk(node["sides"][1], rows[~goes]))

        out.append(walk(root, np.arange(len(y))))
    return base, out, score


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return tree.value[node]
    left, right = nested(tree, tree.left[node]), nested(tree, tree.right[node])
    return (tree.feature[node], tree.limit[node], tree.missing_left[node], tree.gain[node], left, right)


def flat(tree):
    return [x for part in tree for x in (flat(part) if isinstance(part, tuple) else [part])] if isinstance(tree, tuple) else [tree]


@pytest.fixture(scope="module")
def sample(spark):
    r = np.random.default_rng(4)
    x = r.integers(0, BINS, (3, 700)).astype(np.int16)
    chance = 1 / (1 + np.exp(-((x[0] > 4) * 1.5 + (x[1] == 0) * 2 - (x[2] > 6) * (x[0] > 2) - 1.5)))
    y = (r.random(700) < chance).astype(float)
    rows = [(i, [int(v) for v in x[:, i]], int(y[i]), i % 3) for i in range(700)]
    df = spark.createDataFrame(rows, "row_id long, bins array<short>, y int, fold int").repartition(4)
    return x, y, df


SETTINGS = [
    Settings(rounds=4, rate=0.3, depth=4, leaves=6, least_rows=5, l1=0.4, l2=1.0, least_gain=0.05, bad_weight=1.0),
    Settings(rounds=12, rate=0.2, depth=3, leaves=None, least_rows=1, l2=1.0, least_hessian=1.0, bad_weight=3.0),
    Settings(rounds=3, rate=0.5, depth=6, leaves=4, least_rows=20),
]


def test_models_grow_leaf_by_leaf_on_their_rows(sample, monkeypatch):
    x, y, df = sample
    monkeypatch.setattr(boosting, "STORE_ROUNDS", 5)
    folds = [F.col("fold") != k for k in range(3)]
    table = trees.growing_table(df, folds, [F.lit(False)] * 3, [F.col("y") == 1] * 3)
    models = boosting.grow(table, SETTINGS, 3, BINS)
    for k, (m, s) in enumerate(zip(models, SETTINGS)):
        keep = np.arange(700) % 3 != k
        base, expected, score = plain_model(x, y, np.where(y > 0, s.bad_weight, 1.0), s, keep)
        assert m.base == pytest.approx(base) and len(m.trees) == s.rounds
        for got, want in zip(m.trees, expected):
            assert flat(nested(got)) == pytest.approx(flat(want), abs=1e-6)
            assert s.leaves is None or sum(f < 0 for f in got.feature) <= s.leaves
        assert m.base + boosting.raw_scores(m.trees, x) == pytest.approx(score, abs=1e-6)


def test_sums_added_by_spark_are_the_same(sample, monkeypatch):
    _, _, df = sample
    table = trees.growing_table(df, [F.lit(True)], [F.lit(False)], [F.col("y") == 1])
    s = [Settings(rounds=3, depth=3, row_share=0.6, feature_share=0.6)]
    first = boosting.grow(table, s, 3, BINS)[0]
    monkeypatch.setattr(boosting, "FEW_TASKS", 0)
    again = boosting.grow(table.repartition(7), s, 3, BINS)[0]
    assert [nested(t) for t in first.trees] == [nested(t) for t in again.trees]
    assert 0.4 * 700 < first.trees[0].rows[0] < 0.8 * 700


def test_patience_keeps_the_best_round(sample):
    x, y, df = sample
    held = F.col("fold") == 0
    table = trees.growing_table(df, [~held], [held], [F.col("y") == 1])
    free = Settings(rounds=25, rate=0.9, depth=6)
    m = boosting.grow(table, [Settings(**{**free.__dict__, "patience": 3})], 3, BINS)[0]
    every = boosting.grow(table, [free], 3, BINS)[0]
    own = np.arange(700) % 3 == 0
    losses = []
    for n in range(1, len(every.trees) + 1):
        raw = every.base + boosting.raw_scores(every.trees[:n], x[:, own])
        losses.append(np.logaddexp(0, np.where(y[own] > 0, -raw, raw)).mean())
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= 3:
            break
    assert m.losses == pytest.approx(losses[: len(m.losses)], abs=1e-6)
    assert len(m.trees) == best + 1 < len(m.losses) < 25


def test_one_kind_of_label_grows_nothing(sample):
    _, _, df = sample
    table = trees.growing_table(df, [F.lit(True)] * 3, [F.lit(False)] * 3, [F.lit(False), F.lit(True), F.col("y") == 1])
    models = boosting.grow(table, [Settings(rounds=2)] * 3, 3, BINS)
    assert [len(m.trees) for m in models] == [0, 0, 2] and models[0].base < -10 and models[1].base > 10
    with pytest.raises(ValueError):
        boosting.grow(table, [Settings()] * 63, 3, BINS)


def test_codes_of_texts(spark, monkeypatch):
    r = random.Random(2)
    rows = [("hot" if r.random() < 0.4 else None if r.random() < 0.1 else f"v{r.randrange(300)}", r.choice(["b", "a", "é"]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a string, `b.c` string, id int").repartition(5)
    codes = encode.category_codes(df, ["a", "b.c"])
    for f, at in (("a", 0), ("b.c", 1)):
        known = sorted({x[at] or "nan" for x in rows}, key=str.encode)
        got = {x.value: (x.code, x.n) for x in codes.where(F.col("feature") == f).collect()}
        assert got == {v: (k, sum((x[at] or "nan") == v for x in rows)) for k, v in enumerate(known)}
    new = spark.createDataFrame([("hot", "a", 1), ("zzz", "zzz", 2), (None, None, 3), ("v7", "b", 4)], df.schema)
    expected = {x.id: (x.a, x["b.c"]) for x in encode.with_codes(df.union(new), codes, ["a", "b.c"]).collect()}
    index = {v: k for k, v in enumerate(sorted({x[0] or "nan" for x in rows}, key=str.encode))}
    assert all(expected[i][0] == index[a or "nan"] for a, _, i in rows if i > 4)
    assert expected[2] == (-1.0, -1.0) and expected[3][1] == -1.0
    monkeypatch.setattr(encode, "BROADCAST_ROWS", 1)  # a dictionary too large to broadcast
    monkeypatch.setattr(encode, "HOT_SHARE", 0.05)
    split = {x.id: (x.a, x["b.c"]) for x in encode.with_codes(df.union(new), codes, ["a", "b.c"]).collect()}
    assert split == expected


@pytest.mark.parametrize("ones", [0, 1, 400, 1000])
def test_shuffled_labels_keep_the_counts(spark, ones):
    df = spark.range(1000).selectExpr("id", f"CAST(id < {ones} AS DOUBLE) AS y")
    marked = trees.shuffled_labels(df, "id", "y", 1, runs=5)
    bits = [F.sum(F.shiftright("shuffled", k).bitwiseAND(F.lit(1))).alias(f"r{k}") for k in range(5)]
    assert tuple(marked.agg(*bits).first()) == (ones,) * 5
    if ones == 400:
        moved = marked.filter("id < 400").agg(*bits).first()
        assert all(110 < m < 210 for m in moved) and len(set(moved)) > 1


def test_inputs(spark):
    df = spark.createDataFrame([(1.0, "b"), (3.0, "a"), (None, None)], "x double, c string")
    inputs = trees.fit_inputs(df, ["x", "c"])
    assert inputs.limits == {"x": [3.0], "c": [1.0, 2.0]}
    new = spark.createDataFrame([(2.0, "a"), (None, "zzz"), (float("nan"), None), (9.0, "b")], "x double, c string")
    assert [list(r.bins) for r in inputs.binned(new).collect()] == [[1, 1], [0, 1], [0, 3], [2, 2]]
    fixed = trees.fit_inputs(df, ["x", "c"], limits={"x": [2, 1, 2]})
    assert fixed.limits["x"] == [1.0, 2.0]
    constant = trees.fit_inputs(df.withColumn("k", F.lit(5)), ["k"])
    assert [list(r.bins) for r in constant.binned(df.withColumn("k", F.lit(None).cast("int"))).collect()] == [[0]] * 3


# -- search


def test_densities_are_densities():
    m = parzen.mixture([0.1, 0.12, 0.9], 0, 1)
    x = np.linspace(0, 1, 20001)
    assert np.trapezoid(m.density(x), x) == pytest.approx(1, abs=1e-3)
    assert list(m.centre) == [0.1, 0.12, 0.9, 0.5] and m.width[-1] == 1
    assert list(m.width[:3]) == pytest.approx([0.2, 0.38, 0.4])  # gaps to 0.1/0 (at least a fifth), 0.5 and 0.5


def test_values_stay_in_their_ranges():
    r = random.Random(1)
    space = {"a": parzen.Space(2, 4, whole=True), "b": parzen.Space(0.01, 10, logarithmic=True), "c": parzen.Space(0.5, 1)}
    done = []
    for _ in range(12):
        for d in parzen.propose(space, done, 3, r):
            assert d["a"] in (2, 3, 4) and isinstance(d["a"], int) and 0.01 <= d["b"] <= 10 and 0.5 <= d["c"] <= 1
            done.append((d, -abs(d["c"] - 0.8)))
    assert {d["a"] for d, _ in done} == {2, 3, 4}


def test_search_closes_in_on_the_best():
    space = {"x": parzen.Space(-5, 5), "y": parzen.Space(0.01, 10, logarithmic=True)}
    value = lambda d: -((d["x"] - 2) ** 2) - (math.log(d["y"]) + 1) ** 2

    def best(seed, guided):
        r, done = random.Random(seed), []
        while len(done) < 60:
            drawn = parzen.propose(space, done if guided else [], 2, r)
            done += [(d, value(d)) for d in drawn]
        return max(v for _, v in done), np.mean([v for _, v in done[30:]])

    guided, blind = [best(k, True) for k in range(8)], [best(k, False) for k in range(8)]
    assert np.mean([g[1] for g in guided]) > np.mean([b[1] for b in blind]) + 2
    assert np.mean([g[0] for g in guided]) > np.mean([b[0] for b in blind])


def test_best_trials():
    done = [({"i": i}, v) for i, v in enumerate([3, 9, 9, 1])]
    good, rest = parzen.parted(done)
    assert good == [{"i": 1}] and [d["i"] for d in rest] == [2, 0, 3]
