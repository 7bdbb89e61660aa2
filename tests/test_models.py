import ast
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import creditspark as cs

from . import brute


def rows_of(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = None if rng.random() < 0.1 else float(rng.randint(0, 20)) * 2
        c = rng.choice(["beta", "alpha", "gamma", None])
        y = int(rng.random() < 1 / (1 + math.exp(2 - (x or 0) / 12 - (c == "gamma"))))
        rows.append((f"2023{1 + i * 12 // n:02}01", y, x, rng.gauss(0, 1), c))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "new_date string, new_target int, x double, noise double, c string")


def test_woe_fit_and_transform(spark, buckets, tmp_path):
    rows = rows_of(1)
    fitted = cs.fit_woe(frame(spark, rows), ["x", "c"])
    part = [r for r in rows if r[2] is not None]
    bins = brute.tree_bins([r[2] for r in part], [r[1] for r in part], 10)
    woes, _ = brute.woe_and_iv(bins)
    texts = sorted({r[4] for r in rows if r[4]})
    part = [r for r in rows if r[4]]
    text_bins = brute.tree_bins([texts.index(r[4]) for r in part], [r[1] for r in part], 10)
    text_woes, _ = brute.woe_and_iv(text_bins)
    probes = [(None, None), (-1.0, "alpha"), (1.0, "unseen"), (99.0, "beta"), (20.0, "gamma")]
    df = spark.createDataFrame(probes, "x double, c string")

    def expected(value, bins, woes):
        hits = [w for (low, high, _, _), w in zip(bins, woes) if value is not None and low <= value <= high]
        return hits[0] if hits else 0.0

    fitted.save(f"{tmp_path}/woe")
    for bins_table in (fitted, cs.WoeBins.load(spark, f"{tmp_path}/woe")):
        found = {(r.x, r.c): (r.x_woe, r.c_woe) for r in cs.woe_transform(df, bins_table).collect()}
        for x, c in probes:
            code = texts.index(c) if c in texts else None
            assert found[x, c] == pytest.approx((expected(x, bins, woes), expected(code, text_bins, text_woes)))
    # Below, in a gap and above: the nearest bins reach out when asked to.
    open_ended = {r.x: r.x_woe for r in cs.woe_transform(df, fitted, ["x"], gaps="extend").collect()}
    assert open_ended[-1.0] == pytest.approx(woes[0]) and open_ended[99.0] == pytest.approx(woes[-1])
    assert open_ended[None] == 0.0 and open_ended[1.0] != 0.0
    with pytest.raises(ValueError):
        cs.woe_transform(df, fitted, gaps="other")


def test_woe_of_unusable_features_is_zero(spark):
    df = spark.createDataFrame([(0, 1.0, "a")] * 60, "new_target int, x double, c string")
    fitted = cs.fit_woe(df, ["x", "c"])
    assert {r.feature: r.iv for r in fitted.iv().collect()} == {"x": 0.0, "c": 0.0}
    assert tuple(cs.woe_transform(df, fitted).select("x_woe", "c_woe").first()) == (0.0, 0.0)


def test_scorecard_equals_newton_solution(spark, tmp_path):
    rows = rows_of(2)
    df = frame(spark, rows)
    card = cs.train_scorecard(df, ["x", "c"])
    coded = cs.woe_transform(df, card.woe).select("x_woe", "c_woe", "new_target").toPandas().to_numpy(float)
    design, y = np.c_[coded[:, :2], np.ones(len(coded))], coded[:, 2]
    w, penalty = np.zeros(3), np.diag([1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        w -= np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + penalty, design.T @ (p - y) + penalty @ w)
    assert list(card.coefficients().values()) == pytest.approx(list(w[:2]), abs=1e-7) and card.intercept == pytest.approx(w[2], abs=1e-7)
    assert all(abs(r.gradient) < 1e-6 for r in card.gradient(df).collect())
    assert abs(cs.Scorecard(card.woe, [x + 0.1 for x in card.weights], card.intercept).gradient(df).first().gradient) > 1
    both = {r["sample"]: r for r in cs.scorecard_metrics(card, df, frame(spark, rows_of(12))).collect()}
    assert both["train"].auc == pytest.approx(cs.auc(card.predict(df))) and both["test"].rows == 600
    scored = card.score(df)
    sample = scored.select("p", "score").first()
    factor = 20 / math.log(2)
    offset = 600 - factor * math.log(50)
    assert sample.score == int(offset + factor * math.log(sample.p / (1 - sample.p + 1e-6) + 1e-6))
    card.save(f"{tmp_path}/card")
    again = cs.Scorecard.load(spark, f"{tmp_path}/card").score(df)
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in scored.collect()]
    span = card.score_range(df).first()
    assert span.min_score <= sample.score <= span.max_score and span.n_features == 2
    points = card.score_map().filter("feature = 'x'").first()
    assert points.points == pytest.approx(factor * points.coefficient * points.woe)


def test_score_directions(spark):
    df = spark.createDataFrame([(0.1,), (0.6,)], "p double")
    up = [r.s for r in df.select(cs.score_points(F.col("p")).alias("s")).collect()]
    down = [r.s for r in df.select(cs.score_points(F.col("p"), direction="quality").alias("s")).collect()]
    assert up[0] < up[1] and down[0] > down[1]


def test_tree_model(spark, tmp_path):
    df = frame(spark, rows_of(3))
    model = cs.train_tree(df, ["x", "noise", "c"], frame(spark, rows_of(4)), params={"maxIter": 6, "maxDepth": 3, "stepSize": 0.3})
    assert 1 <= model.best_iteration <= 6
    assert cs.auc(model.predict(df)) > 0.65
    assert model.importance().first().feature in ("x", "c")
    assert model.importance().count() == 3
    model.save(f"{tmp_path}/tree")
    again = cs.TreeModel.load(spark, f"{tmp_path}/tree")
    assert [r.p for r in again.predict(df).collect()] == [r.p for r in model.predict(df).collect()]
    with pytest.raises(ValueError):
        cs.train_tree(df, ["x"], model_type="cat")


def test_null_importance_keeps_the_planted_signal(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(1500):
        x = rng.gauss(0, 1)
        rows.append((int(x + rng.gauss(0, 0.4) > 0.5), x, rng.gauss(0, 1), rng.gauss(0, 1), "t"))
    df = spark.createDataFrame(rows, "new_target int, x double, n1 double, n2 double, txt string")
    kept, detail, drops = cs.filter_null_importance(df, trees=3, depth=3, runs=3)
    assert "x" in kept.columns and "txt" in kept.columns
    assert detail.first().feature == "x" and "x" not in [r.feature for r in drops.collect()]
    assert all(r.reason.startswith("gain差异比") for r in drops.collect())
    other = cs.null_importance_drops(detail, "difference", 1e12).collect()
    assert len(other) == 3 and all(r.reason.startswith("gain差异") and "比" not in r.reason for r in other)
    same, nothing, _ = cs.filter_null_importance(df.select("new_target", "x"))
    assert same.columns == ["new_target", "x"] and nothing is None


def test_cross_validation_and_search(spark):
    df = frame(spark, rows_of(5))
    few = {"maxIter": 3, "maxDepth": 2, "stepSize": 0.3}
    folds = cs.cross_validate(df, ["x", "c"], folds=3, params=few).collect()
    assert [r.fold for r in folds] == [1, 2, 3]
    assert all(r.train_size + r.val_size == 600 for r in folds)
    forward = cs.cross_validate(df, ["x", "c"], folds=3, params=few, mode="forward").collect()
    assert [(r.train_size, r.val_size) for r in forward] == [(150, 150), (300, 150), (450, 150)]
    summary = {r.metric: r for r in cs.cv_summary(spark.createDataFrame(folds)).collect()}
    assert summary["val_auc"].mean == pytest.approx(sum(r.val_auc for r in folds) / 3)
    best, trials = cs.search_params(df, frame(spark, rows_of(6)), ["x", "c"], trials=3, ranges={"maxIter": (2, 3), "maxDepth": (2, 3)})
    found = trials.collect()
    assert len(found) == 3 and found[0].val_auc == max(r.val_auc for r in found)
    assert repr(sorted(best.items())) == found[0].params
    for r in found:
        drawn = dict(ast.literal_eval(r.params))
        assert drawn["maxIter"] in (2, 3) and drawn["maxDepth"] in (2, 3) and 8 <= drawn["maxLeaves"] <= 64
        assert 0.01 <= drawn["stepSize"] <= 0.3 and 0.01 <= drawn["l1"] <= 10 and 20 <= drawn["minInstancesPerNode"] <= 200


def test_feature_selection_uses_the_published_null_importance(spark, tmp_path, monkeypatch):
    """The registered query grows all rounds of all runs, at the published depth, on the sample that reaches that step."""
    from creditspark.operators import trees
    from workload import queries

    rng = random.Random(8)
    rows = []
    for i in range(2400):
        x, y = rng.gauss(0, 1), rng.gauss(0, 1)
        month = f"20230{1 + i % 3}"
        rows.append((i, 1, month + "01", month, int(x + y + rng.gauss(0, 1) > 1), f"o{i % 2}", x, y, rng.gauss(0, 1)))
    df = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, new_date string, new_date_ym string, new_target int, new_org string, "
                                     "x double, y double, noise double")
    monkeypatch.setattr(queries.fx, "sample", lambda *a: df)
    grown = []

    def grow(table, settings, features, bins):
        grown.append((settings, features, table.count()))
        return [trees.Model(k, s, features) for k, s in enumerate(settings)]

    monkeypatch.setattr(trees, "grow", grow)
    queries.feature_selection(spark, str(tmp_path)).collect()
    (settings, features, count), = grown
    assert len(settings) == 1 + cs.config.NULL_RUNS and features >= 2 and count == 2400
    assert {(s.rounds, s.depth) for s in settings} == {(cs.config.NULL_TREES, cs.config.NULL_DEPTH)} == {(100, 5)}
