import math
import random

import pytest

import creditspark as cs
from creditspark.operators import binning

from . import brute


def frame(spark, rows):
    return spark.createDataFrame(rows, "new_org string, new_target int, a double, b double, c double")


def random_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        a = rng.gauss(0, 1)
        b = float(rng.randint(0, 6))
        c = None if rng.random() < 0.3 else (0.0 if rng.random() < 0.5 else round(rng.random(), 2))
        y = int(rng.random() < 1 / (1 + math.exp(1 - a - 0.3 * b)))
        rows.append((rng.choice(["o1", "o1", "o2"]), y, a, b, c))
    return rows


@pytest.mark.parametrize("k", [2, 5, 10])
def test_bins_equal_brute_force(spark, buckets, k):
    rows = random_rows(k)
    df = frame(spark, rows)
    cells = binning.binning_cells(df, ["a", "b", "c"], by_org=True)
    found = binning.bin_ranges(cells, binning.leaf_stats(binning.tree_leaves(cells, k))).collect()
    for scope in ("__overall__", "o1", "o2"):
        for i, feature in enumerate("abc"):
            part = [r for r in rows if (scope == "__overall__" or r[0] == scope) and r[2 + i] is not None]
            expected = brute.tree_bins([r[2 + i] for r in part], [r[1] for r in part], k)
            mine = sorted((r for r in found if r.scope == scope and r.feature == feature), key=lambda r: r.bin)
            assert [(r.low, r.high, r.n, r.bad) for r in mine] == expected
            woes, _ = brute.woe_and_iv(expected)
            assert [r.woe for r in mine] == pytest.approx(woes)


def test_information_value_and_drops(spark):
    rows = random_rows(7)
    iv = {r.feature: r.iv for r in cs.information_value(frame(spark, rows), ["a", "b", "c"]).collect()}
    for i, feature in enumerate("abc"):
        part = [r for r in rows if r[2 + i] is not None]
        _, total = brute.woe_and_iv(brute.tree_bins([r[2 + i] for r in part], [r[1] for r in part], 5))
        assert iv[feature] == pytest.approx(total, abs=6e-5)
    kept, detail, drops, bands = cs.filter_iv(frame(spark, rows), threshold=iv["b"] + 0.001, org_threshold=0.0)
    assert "a" in kept.columns and "b" not in kept.columns
    reasons = {r.feature: r.reason for r in drops.collect()}
    assert reasons["b"].startswith("整体IV=") and "a" not in reasons
    assert bands.count() == 8


def test_small_and_one_class_features_have_no_value(spark):
    rows = [("o", i % 2, float(i) if i < 49 else None, 1.0 if i % 2 else None, float(i)) for i in range(100)]
    assert [r.feature for r in cs.information_value(frame(spark, rows), ["a", "b", "c"]).collect()] == ["c"]


def test_pure_bins_are_clipped_and_constant_value_is_one_bin(spark):
    rows = [("o", int(i >= 50), float(i), 3.0, None) for i in range(100)]
    cells = binning.binning_cells(frame(spark, rows), ["a", "b"], by_org=False)
    stats = binning.leaf_stats(binning.tree_leaves(cells, 5)).orderBy("feature", "bin").collect()
    assert [(r.feature, r.n, r.woe) for r in stats] == [("a", 50, 5.0), ("a", 50, -5.0), ("b", 100, 0.0)]


def test_row_order_does_not_matter(spark):
    rows = random_rows(3)
    one = cs.iv_by_org(frame(spark, rows), ["a", "b", "c"]).collect()
    other = cs.iv_by_org(frame(spark, rows[::-1]).repartition(5), ["a", "b", "c"]).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, other))
