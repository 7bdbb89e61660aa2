import random

import pytest

import creditspark as cs

from . import brute


def column(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


CASES = {
    "shift": ([float(i) for i in range(200)], [float(i) + 37 for i in range(150)]),
    "same": ([1.0, 5.0, 2.0, 8.0] * 10, [1.0, 5.0, 2.0, 8.0] * 10),
    "ties": ([0.0] * 60 + [1.0, 2.0, 3.0] * 5, [0.0] * 10 + [2.0] * 30),
    "all_equal": ([4.0] * 30, [4.0] * 10 + [5.0] * 10 + [3.0] * 5),
    "on_edge": ([0.0, 10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0, 80.0, 90.0, 100.0], [10.0, 20.0, 90.0, 100.0]),
    "nulls": ([1.0, None, 2.0, float("nan"), 3.0] * 9, [None, 3.0, 3.0, 1.0]),
    "empty": ([1.0, 2.0], [None]),
}


@pytest.mark.parametrize("name", CASES)
def test_two_samples(spark, buckets, name):
    base, current = CASES[name]
    found = cs.psi_two_samples(column(spark, base), column(spark, current), ["x"]).first().psi
    assert found == pytest.approx(brute.psi(base, current), abs=6e-5)
    if name in ("same", "empty"):
        assert found == 0.0


def sample(spark, rng):
    rows = []
    for org, months, size in (("o1", 5, 120), ("o2", 3, 130), ("o3", 1, 200), ("small", 3, 40)):
        for m in range(months):
            for _ in range(size):
                drift = rng.gauss(m * 0.8, 1)
                rows.append((org, f"20230{m + 1}", drift, rng.gauss(0, 1), None if m else 1.0))
    return rows


def test_by_org_and_month(spark):
    rows = sample(spark, random.Random(5))
    df = spark.createDataFrame(rows, "new_org string, new_date_ym string, d double, s double, gone double")
    found = {(r.org, r.feature, r.period): r.psi for r in cs.psi_by_org(df, ["d", "s", "gone"]).collect()}
    assert not any(org == "o3" for org, _, _ in found)
    assert len(found) == (5 + 3 + 3) * 3
    for (org, feature, period), psi in found.items():
        place = {"d": 2, "s": 3, "gone": 4}[feature]
        base = [r[place] for r in rows if r[0] == org and r[1] == "202301"]
        now = [r[place] for r in rows if r[0] == org and r[1] == period]
        if period == "202301":
            assert psi == 0.0
        elif org == "small":
            assert psi is None
        else:
            assert psi == pytest.approx(brute.psi(base, now), abs=6e-5)


@pytest.mark.parametrize("periods, unstable, expected", [(11, 3, True), (11, 2, False), (2, 1, True), (2, 0, False)])
def test_unstable_rule(spark, periods, unstable, expected):
    rows = [("o", "f", "00", 0.0)] + [("o", "f", f"{i + 1:02}", 0.2 if i < unstable else 0.1) for i in range(periods)]
    detail = spark.createDataFrame(rows, "org string, feature string, period string, psi double")
    assert cs.psi_org_summary(detail).first().unstable is expected


def test_drops_name_the_organisations(spark):
    rows = [(f"o{i}", f, p, 0.0 if p == "1" else (0.5 if f == "bad" or i == 0 else 0.0))
            for i in range(6) for f in ("bad", "good") for p in ("1", "2")]
    detail = spark.createDataFrame(rows, "org string, feature string, period string, psi double")
    drops = cs.psi_drops(detail, org_count=9).collect()
    assert [tuple(r) for r in drops] == [("bad", "PSI不稳定机构数6/9", "o0,o1,o2,o3,o4,o5")]
    bands = {(r.org, r.band): r.n_features for r in cs.psi_bands(detail, ["o1"]).collect()}
    assert bands["o1", "[0.1, inf)"] == 1 and bands["o1", "[0.05, 0.1)"] == 0


def test_categories_use_value_shares(spark):
    base = spark.createDataFrame([("a",)] * 6 + [("b",)] * 4 + [(None,)], "c string")
    now = spark.createDataFrame([("a",)] * 5 + [("new",)] * 5, "c string")
    import math
    expected = (0.5 - 0.6) * math.log(0.5 / 0.6) + (1e-6 - 0.4) * math.log(1e-6 / 0.4) + (0.5 - 1e-6) * math.log(0.5 / 1e-6)
    assert cs.psi_categorical(base, now, ["c"]).first().psi == pytest.approx(expected, abs=6e-5)
    assert cs.psi_categorical(base, base, ["c"]).first().psi == 0.0
