import random

import pytest

import creditspark as cs

from . import brute


def frame(spark, rows):
    return spark.createDataFrame(rows, "new_org string, new_target int, p double")


def scored(seed, n=300, digits=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        p = round(rng.random(), digits)
        rows.append((rng.choice("ab"), int(rng.random() < p), p))
    return rows


@pytest.mark.parametrize("digits", [1, 6])
def test_ranking_metrics(spark, buckets, digits):
    rows = scored(11, digits=digits)
    y, p = [r[1] for r in rows], [r[2] for r in rows]
    found = cs.ranking_metrics(frame(spark, rows)).first()
    assert found.auc == pytest.approx(brute.auc(y, p))
    assert found.ks == pytest.approx(brute.ks(y, p))
    assert found.pr_auc == pytest.approx(brute.average_precision(y, p))
    assert found.gini == pytest.approx(2 * found.auc - 1)
    flipped = cs.ranking_metrics(frame(spark, [(o, t, -s) for o, t, s in rows])).first()
    assert flipped.auc == pytest.approx(1 - found.auc) and flipped.ks >= 0


def test_constant_score_and_one_class(spark):
    found = cs.ranking_metrics(frame(spark, [("a", i % 2, 0.5) for i in range(20)])).first()
    assert (found.auc, found.ks, found.pr_auc) == (0.5, 0.0, 0.5)
    alone = cs.ranking_metrics(frame(spark, [("a", 0, i / 10) for i in range(20)])).first()
    assert alone.auc is None and alone.ks is None


def test_segments(spark):
    rng = random.Random(2)
    rows = []
    for org, n, one_class in (("fifty", 50, False), ("short", 49, False), ("single", 60, True)):
        rows += [(org, 0 if one_class else i % 2, rng.random()) for i in range(n)]
    found = cs.segment_stability(frame(spark, rows)).collect()
    assert [r.segment for r in found] == ["fifty"]
    part = [r for r in rows if r[0] == "fifty"]
    assert found[0].auc == pytest.approx(brute.auc([r[1] for r in part], [r[2] for r in part]), abs=6e-5)


def test_lift(spark, buckets):
    rows = [("a", int(i >= 90), float(i)) for i in range(100)]
    lift = cs.lift_table(frame(spark, rows)).collect()
    assert [(r.decile, r["count"]) for r in lift] == [(i, 10) for i in range(1, 11)]
    assert (lift[0].bad_rate, lift[0].lift, lift[1].lift) == (1.0, 10.0, 0.0)
    # Ties drop edges, and numbering then starts above 1.
    tied = cs.lift_table(frame(spark, [("a", i % 2, 0.0 if i < 80 else 1.0) for i in range(100)])).collect()
    assert [(r.decile, r["count"]) for r in tied] == [(9, 20), (10, 80)]
    assert cs.lift_table(frame(spark, rows[:5])).count() == 0
    assert cs.lift_table(frame(spark, [("a", 0, float(i)) for i in range(30)])).count() == 0


def test_evaluation_record(spark):
    rows = scored(4)
    record, lift = cs.evaluate(frame(spark, rows), "m", threshold=0.5)
    found = cs.pass_flags(record).first()
    hits = [r[1] for r in rows if r[2] >= 0.5]
    assert found.precision == pytest.approx(sum(hits) / len(hits), abs=6e-5)
    assert found.recall == pytest.approx(sum(hits) / sum(r[1] for r in rows), abs=6e-5)
    assert found.n_samples == 300 and found.top10_lift == lift.first().lift
    assert found.auc_pass == (found.auc >= 0.7)
    never = cs.confusion(frame(spark, rows), threshold=2.0).first()
    assert (never.precision, never.recall, never.f1) == (0.0, 0.0, 0.0)


def test_metrics_do_not_depend_on_partitions(spark):
    rows = scored(9)
    one = cs.ranking_metrics(frame(spark, rows)).first()
    other = cs.ranking_metrics(frame(spark, rows[::-1]).repartition(7)).first()
    assert tuple(one) == pytest.approx(tuple(other))
