import random
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import creditspark as cs
from creditspark.operators import correlation


def test_correlation_agrees_with_pandas(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(1000, 3, size=(300, 6))
    data[:, 1] += data[:, 0]
    pdf = pd.DataFrame(data, columns=list("abcdef"))
    pdf = pdf.mask(pd.DataFrame(rng.random((300, 6)) < 0.2, columns=pdf.columns))
    df = spark.createDataFrame(pdf)
    names = list("abcdef")
    expected = pdf.corr()
    rows = cs.correlation_pairs(df, names).collect()
    assert len(rows) == 15
    for r in rows:
        assert r.r == pytest.approx(expected.loc[r.feature_1, r.feature_2], abs=1e-10)
    # The number of features changes nothing.
    wider = df.select("*", *[F.col(n).alias(f"{n}{i}") for i in range(5) for n in names])
    again = {(r.feature_1, r.feature_2): r.r for r in cs.correlation_pairs(wider, wider.columns).collect()}
    assert len(again) == 36 * 35 // 2
    assert all(again[r.feature_1, r.feature_2] == pytest.approx(r.r, abs=1e-12) for r in rows)


def test_pair_without_spread_has_no_correlation(spark):
    df = spark.createDataFrame([(float(i), None) if i % 2 else (1.0, float(i)) for i in range(100)], "`a.x` double, b double")
    assert [r.r for r in cs.correlation_pairs(df, ["a.x", "b"]).collect()] == [None]


@pytest.mark.parametrize("iv, expected", [
    ({"a": 3.0, "b": 2.0, "c": 1.0}, ["b", "c"]),
    ({"a": 1.0, "b": 2.0, "c": 3.0}, ["a", "b"]),
    ({"a": 1.0, "b": 1.0, "c": 1.0}, ["a", "b"]),
])
def test_greedy_walk(iv, expected):
    pairs = [(x, y, 0.9, iv[x], iv[y]) for x, y in (("b", "c"), ("a", "c"), ("a", "b"))]
    assert [f for f, _ in correlation.greedy_drops(pairs, "abc", 0.8)] == expected


def test_correlation_filter_keeps_the_stronger(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        x = rng.gauss(0, 1)
        rows.append((int(x + rng.gauss(0, 0.5) > 0), x, x + rng.gauss(0, 0.3), rng.gauss(0, 1), "t"))
    df = spark.createDataFrame(rows, "new_target int, weak double, strong double, other double, txt string")
    df = df.selectExpr("new_target", "strong AS weak", "weak AS strong", "other", "txt")
    kept, pairs, drops = cs.filter_correlation(df)
    assert kept.columns == ["new_target", "strong", "other", "txt"]
    assert "weak" == drops.first().feature and "相关系数=" in drops.first().reason
    assert pairs.count() == 1
    none, pairs, drops = cs.filter_correlation(df.drop("weak"))
    assert pairs.count() == 0 and drops.count() == 0


def test_vif(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3))
    x[:, 2] = x[:, 0] + 0.1 * x[:, 2]
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")))
    expected = np.diag(np.linalg.inv(np.corrcoef(x.T)))
    found = {r.feature: r for r in cs.variance_inflation(df, list("abc")).collect()}
    assert [found[f].vif for f in "abc"] == pytest.approx(list(expected))
    assert [found[f].high for f in "abc"] == [True, False, True]
    same = cs.variance_inflation(df.selectExpr("a", "b", "a + b AS s", "c - a AS d"), ["a", "b", "s", "d"]).collect()
    assert [r.vif == float("inf") for r in same] == [True, True, True, False]


def sample(spark):
    rows = []
    for org, n in (("o1", 60), ("o2", 40)):
        for i in range(n):
            month = "202301" if i < 30 else "202304"
            rows.append((org, month, month + "01", i % 3 == 0 and 1 or 0, None if i % 4 else 2.0, -999.0 if org == "o2" else 1.0, "t"))
    return spark.createDataFrame(
        rows, "new_org string, new_date_ym string, new_date string, new_target int, holes double, sent double, txt string")


def test_missing_rates_filter_and_bands(spark):
    df = sample(spark)
    detail = {(r.feature, r.scope): r.missing_rate for r in cs.missing_detail(df).collect()}
    assert detail["holes", "__overall__"] == 0.75 and detail["sent", "o2"] == 1.0 and detail["txt", "o1"] == 0.0
    kept, _, drops, bands = cs.filter_missing(df, 0.6, 1)
    assert "holes" not in kept.columns and "sent" not in kept.columns and "txt" in kept.columns
    reasons = {r.feature: r.reason for r in drops.collect()}
    assert reasons == {"holes": "整体缺失率0.7500>0.6; 2个机构缺失率>0.6", "sent": "1个机构缺失率>0.6"}
    counted = {(r.org, r.band): (r.n_features, r.share) for r in bands.collect()}
    assert counted["o1", "[15%, 35%)"] == (1, "50.00%") and counted["o1", "[95%, 100%]"] == (1, "50.00%")


def test_months_gaps_and_outliers(spark):
    df = sample(spark)
    kept, months = cs.filter_abnormal_months(df, min_bad=5, min_rows=15)
    assert [(r.org, r.month, r.reason) for r in months.collect()] == [("o2", "202304", "坏样本数4<5")]
    assert kept.count() == 90
    assert [tuple(r) for r in cs.month_gaps(df).collect()] == [
        ("o1", "202301", "202304", 2), ("o2", "202301", "202304", 2)]
    gone, _ = cs.filter_abnormal_months(df, min_bad=10, min_rows=500)
    assert gone.count() == 0
    assert {r.org: r.outlier for r in cs.org_outliers(df).collect()} == {"o1": False, "o2": False}
    stats = cs.org_month_stats(df, ["o2"]).collect()
    assert [r.sample_type for r in stats] == ["建模", "建模", "贷外", "贷外"]
    gates = {r.gate: r.ok for r in cs.sample_gates(df).collect()}
    assert gates == {"bad_rate": False, "rows": False, "bads": False, "features": False}


def test_step_report_as_published(spark, tmp_path):
    """Bands and per-organisation details stay out of the summary, empty tables out of the folder, details are wide."""
    detail = spark.createDataFrame([("x", "__overall__", 0.3), ("x", "o1", 0.2), ("x", "o2", 0.4), ("y", "__overall__", 0.1)], "feature string, scope string, iv double")
    drops = spark.createDataFrame([("y", "low")], "feature string, reason string")
    tables = {"iv_detail": detail, "iv_bands": detail, "iv_drops": drops, "missing_drops": drops.limit(0), "correlation_detail": detail}
    cs.write_step_report(tables, f"{tmp_path}/r", {"iv": 0.2})
    found = {r.step: (r.result, r.condition) for r in spark.read.parquet(f"{tmp_path}/r/summary").collect()}
    assert set(found) == {"Step6-高缺失率处理", "Step7-IV处理", "Step10-相关性明细"}
    assert found["Step7-IV处理"][0] == "剔除 1 个特征" and "0.2" in found["Step7-IV处理"][1]
    assert found["Step6-高缺失率处理"] == ("空", "") and found["Step10-相关性明细"] == ("4 条记录", "")
    assert not (tmp_path / "r" / "missing_drops").exists() and (tmp_path / "r" / "iv_bands").exists()
    rows = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/r/iv_detail").collect()]
    assert rows == [("x", 0.3, 0.2, 0.4), ("y", 0.1, None, None)]


def test_correlation_evaluates_its_input_once(spark):
    rng = random.Random(5)
    # Far from zero, with a column that is missing in the first partition and one that does not vary.
    rows = [(1e9 + i % 97, None if i < 500 else 1e9 + i % 97 + rng.random(), 0.1, rng.random()) for i in range(2_000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartitionByRange(4, "a")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    found = {(r.feature_1, r.feature_2): r.r for r in cs.correlation_pairs(df.mapInArrow(counted, df.schema), list("abcd")).collect()}
    assert seen.value == len(rows)
    for i, j in (("a", "b"), ("a", "d"), ("b", "d")):
        x, y = zip(*[(r["abcd".index(i)], r["abcd".index(j)]) for r in rows if r["abcd".index(i)] is not None and r["abcd".index(j)] is not None])
        assert found[i, j] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9)
    assert found["a", "c"] is None and found["b", "c"] is None and found["c", "d"] is None


def test_selection_evaluates_its_sample_once(spark, tmp_path):
    rng = random.Random(4)
    rows = [("20240101", "202401", int(rng.random() < 0.3), "o1", rng.random(), rng.random()) for _ in range(400)]
    df = spark.createDataFrame(rows, "new_date string, new_date_ym string, new_target int, new_org string, a double, b double").repartition(1)
    folder = str(tmp_path)

    def counted(batches):
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        yield from batches

    cs.select_features(df.mapInArrow(counted, df.schema), run_null_importance=False)
    assert len(list(tmp_path.iterdir())) == 1
