import random

import numpy as np
import pytest

import creditspark as cs

from . import brute


def sample(spark, shift, nulls, seed, text_nulls=0.0, n=400):
    rng = random.Random(seed)
    rows = [
        (int(rng.random() < 0.2), rng.gauss(shift, 1), None if rng.random() < nulls else float(rng.randint(0, 9)),
         None if rng.random() < text_nulls else rng.choice("ab"))
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "new_target int, x double, k double, t string")


def test_baseline_statistics(spark, buckets, tmp_path):
    df = sample(spark, 5, 0.1, 1)
    table = cs.baseline(df, ["x", "k", "t"])
    found = {r.feature: r for r in table.collect()}
    for name in ("x", "k"):
        values = np.array([r[name] for r in df.collect() if r[name] is not None])
        row = found[name]
        assert (row.mean, row.std) == pytest.approx((values.mean(), values.std(ddof=1)))
        assert (row.min, row.max, row.median) == pytest.approx((values.min(), values.max(), np.median(values)))
        for p, value in row.percentiles.items():
            assert value == pytest.approx(np.percentile(values, int(p[1:])))
        assert sum(row.counts) == len(values)
        assert row.missing_rate == pytest.approx(1 - len(values) / 400)
    assert found["t"].mean is None and found["t"].numeric is False
    cs.save_baseline(table, f"{tmp_path}/base")
    assert "created_at" in cs.load_baseline(spark, f"{tmp_path}/base").columns


def test_feature_alerts(spark):
    base = sample(spark, 0, 0.1, 2)
    current = sample(spark, 1.0, 0.3, 3, text_nulls=0.2)
    stored = cs.baseline(base, ["x", "k", "t", "new_target"])
    drift = {r.feature: r for r in cs.feature_drift(stored, current, ["x", "k", "t"]).collect()}
    expected = brute.psi([r.x for r in base.collect()], [r.x for r in current.collect()])
    assert drift["x"].psi == pytest.approx(expected, abs=6e-5) and drift["t"].psi == 0.0
    alerts = {(r.feature, r.type): r for r in cs.monitor_features(stored, current).collect()}
    assert alerts["x", "PSI漂移"].severity == "HIGH"
    assert alerts["x", "PSI漂移"].value == f"PSI={drift['x'].psi:.4f}"
    assert alerts["k", "缺失率变化"].severity == "MEDIUM" and "→" in alerts["k", "缺失率变化"].value
    assert ("t", "缺失率变化") in alerts
    assert cs.monitor_features(stored, base).count() == 0
    assert cs.feature_drift(stored, current.drop("k")).filter("feature = 'k'").count() == 0


@pytest.mark.parametrize("psi, drop, change, expected", [
    (0.1, 0.05, 0.01, []),
    (0.2, 0.06, 0.011, ["MEDIUM", "MEDIUM", "MEDIUM"]),
    (0.26, 0.11, -0.02, ["HIGH", "HIGH", "MEDIUM"]),
])
def test_model_alert_levels(spark, psi, drop, change, expected):
    drift = spark.createDataFrame(
        [(psi, 0.8, 0.8 - drop, drop, 0.5, 0.4, 0.1, 0.1 + change)],
        "score_psi double, baseline_auc double, current_auc double, auc_drop double, baseline_ks double, "
        "current_ks double, baseline_bad_rate double, current_bad_rate double",
    )
    if not expected:
        drift = drift.selectExpr("* EXCEPT (current_bad_rate)", "baseline_bad_rate AS current_bad_rate")
    assert [r.severity for r in cs.model_alerts(drift).collect()] == expected


def test_model_comparison(spark, tmp_path):
    base = sample(spark, 0, 0, 4).selectExpr("new_target", "x + new_target AS p")
    current = sample(spark, 1, 0, 5).selectExpr("new_target", "x AS p")
    record, alerts = cs.monitor_model(base, current)
    row = record.first()
    assert row.baseline_auc == pytest.approx(
        brute.auc([r.new_target for r in base.collect()], [r.p for r in base.collect()]), abs=6e-5)
    assert row.auc_drop > 0.1 and row.score_psi > 0
    assert {r.type for r in alerts.collect()} >= {"AUC退化"}
    features = spark.createDataFrame([("x", "a", "b", "HIGH"), ("k", "a", "b", "MEDIUM")],
                                     "feature string, type string, value string, severity string")
    summary = cs.alert_summary(features, alerts).first()
    assert (summary.total_feature_alerts, summary.high_severity, summary.model_alerts) == (2, 1, alerts.count())
    cs.write_monitoring(record, alerts, features, f"{tmp_path}/m")
    assert spark.read.json(f"{tmp_path}/m/summary").first().high_severity == 1


def test_selection_chain_and_report(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for i in range(3000):
        x = rng.gauss(0, 1)
        rows.append((f"o{i % 2}", f"20230{1 + i % 3}01", f"20230{1 + i % 3}", int(x + rng.gauss(0, 1) > 1), x,
                     x * 2 + rng.gauss(0, 0.2), rng.gauss(0, 1), None if i % 10 else 1.0 + i % 7, "t" if i % 2 else "u"))
    df = spark.createDataFrame(rows, "new_org string, new_date string, new_date_ym string, new_target int, "
                                     "x double, copy double, noise double, holes double, txt string")
    kept, tables = cs.select_features(df, min_rows=100, null_trees=2, null_depth=2, report_folder=f"{tmp_path}/r")
    names = cs.features_of(kept)
    assert "txt" in names and len({"x", "copy"} & set(names)) == 1
    assert "noise" not in names and "holes" not in names
    assert kept.count() == 3000
    summary = {r.step: r for r in spark.read.parquet(f"{tmp_path}/r/summary").collect()}
    assert summary["Step6-高缺失率处理"].result == "剔除 1 个特征"
    assert summary["Step6-高缺失率处理"].condition == "整体缺失率>0.6 的特征剔除"
    assert summary["Step4-异常月份处理"].result == "空"
    assert "变量" in spark.read.parquet(f"{tmp_path}/r/missing_drops").columns
    chosen = {r.feature: r.selected for r in cs.selection_summary(df, kept).collect()}
    assert chosen["txt"] and not chosen["noise"]


def test_model_report(spark, tmp_path):
    rows = [("a", i % 2, i / 60) for i in range(60)]
    df = spark.createDataFrame(rows, "new_org string, new_target int, p double")
    record, lift = cs.evaluate(df)
    cs.write_evaluation(record, lift, f"{tmp_path}/e", cs.segment_stability(df))
    written = spark.read.json(f"{tmp_path}/e/metrics").first()
    assert written.thresholds.auc == 0.7 and written.model_name == "model" and written.generated_at
    assert spark.read.json(f"{tmp_path}/e/segments").count() == 1


@pytest.mark.parametrize("bins", [5, 20])
def test_drift_uses_the_bins_of_the_baseline(spark, bins):
    df = spark.createDataFrame([(i % 2, float(i * 7919 % 1000)) for i in range(1000)], "new_target int, x double")
    assert [r.psi for r in cs.feature_drift(cs.baseline(df, ["x"], bins=bins), df).collect()] == [0.0]


def test_merged_baselines_describe_all_rows(spark, tmp_path):
    parts = [sample(spark, k, 0.1 * k, 20 + k, n=300 * k) for k in (1, 2, 3)]
    for k, part in enumerate(parts[:-1]):
        cs.save_baseline(cs.baseline(part, ["x", "k", "t"]), f"{tmp_path}/b{k}")
    tables = [cs.load_baseline(spark, f"{tmp_path}/b{k}") for k in range(2)] + [cs.baseline(parts[2], ["x", "k", "t"])]
    merged = {r.feature: r for r in cs.merged_baselines(tables).collect()}
    rows = [r for part in parts for r in part.collect()]
    for name in ("x", "k"):
        values = np.array([r[name] for r in rows if r[name] is not None])
        got = merged[name]
        assert (got.n_samples, got.n, got.missing_rate) == pytest.approx((1800, len(values), 1 - len(values) / 1800))
        assert (got.mean, got.std, got.min, got.max) == pytest.approx((values.mean(), values.std(ddof=1), values.min(), values.max()))
        assert got.bad_rate == pytest.approx(np.mean([r.new_target for r in rows]))
        for p, value in got.percentiles.items():
            assert (values < value).mean() - 0.01 <= int(p[1:]) / 100 <= (values <= value).mean() + 0.01
        assert sum(got.counts) == len(values) and len(got.counts) == 10
        edges = [-np.inf, *got.edges, np.inf]
        exact = [((values >= a) & (values < b)).sum() for a, b in zip(edges, edges[1:])]
        assert max(abs(a - b) for a, b in zip(exact, got.counts)) <= 0.01 * len(values)
    assert merged["t"].numeric is False and merged["t"].sketch is None and merged["t"].n_samples == 1800
    # A merged baseline is one like any other: it can be compared with, and merged again.
    again = cs.merged_baselines([cs.merged_baselines(tables[:2]), tables[2]])
    assert {r.feature: r.n for r in again.collect()} == {f: r.n for f, r in merged.items()}
    assert cs.feature_drift(cs.merged_baselines(tables), parts[0]).filter("feature = 'x'").first().psi > 0.1
