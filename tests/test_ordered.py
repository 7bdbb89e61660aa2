import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import creditspark as cs
from creditspark.plans import ordered


@pytest.fixture
def frame(spark):
    rng = random.Random(1)
    rows = []
    for i in range(20_000):
        # A third of all rows share one value; one key holds two thirds of the rows.
        rows.append(("big" if i % 3 else "small", 0.0 if i % 3 == 1 else rng.gauss(0, 1), float(rng.randint(0, 50))))
    return spark.createDataFrame(rows, "k string, x double, y double")


PROBS = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


def check(found, frame):
    data = frame.toPandas()
    for row in found.collect():
        values = data[data.k == row.k][row.feature].to_numpy()
        assert row.n_all == len(values)
        assert list(row.edges) == pytest.approx(list(np.percentile(values, [100 * p for p in PROBS])), abs=1e-12)


def test_brackets_hold_every_rank(spark, frame, monkeypatch):
    monkeypatch.setattr(ordered, "SKETCH_ACCURACY", 400)
    cells = ordered._bracketed_cells(frame, ["x", "y"], ["k"], PROBS)
    assert cells.filter("gap").count() > 0
    assert cells.count() < 4_000
    assert cells.agg(F.sum("n")).first()[0] == 40_000
    running = ordered.running_totals(cells, ["k", "feature"], ["value", "gap"], ["n"], True)
    picked = running.withColumn("value", F.when(~F.col("gap"), F.col("value")))
    check(ordered.rank_quantiles(picked, ["k", "feature"], PROBS), frame)


@pytest.mark.parametrize("rows_per_bucket", ["100000", "1000"])
def test_quantiles_are_exact_on_both_routes(spark, frame, rows_per_bucket):
    spark.conf.set("spark.creditspark.rowsPerBucket", rows_per_bucket)
    try:
        check(ordered.exact_quantiles(frame, ["x", "y"], ["k"], PROBS), frame)
    finally:
        spark.conf.unset("spark.creditspark.rowsPerBucket")


def test_running_totals_over_buckets(spark, frame, many_buckets):
    cells, bucketed = ordered.value_cells(frame, ["x", "y"], ["k"], {"n": F.count("*")})
    assert bucketed
    running = ordered.running_totals(cells, ["k", "feature"], ["value"], ["n"], bucketed)
    data = frame.toPandas()
    for row in running.filter("value > 1.5 OR value = 0").collect():
        values = data[data.k == row.k][row.feature]
        assert row.n_upto == (values <= row.value).sum() and row.n_all == len(values)


def test_row_numbers_spread_equal_rows(spark):
    df = spark.createDataFrame([("a", 1)] * 50 + [("a", 0)] * 5 + [("b", 7)] * 20, "k string, v int").repartition(4)
    rows = ordered.row_numbers(df, ["k"], ["v"]).collect()
    assert sorted(r.row_number for r in rows if r.k == "a") == list(range(1, 56))
    assert {r.v for r in rows if r.k == "a" and r.row_number <= 5} == {0}
    assert sorted(r.row_number for r in rows if r.k == "b") == list(range(1, 21))


def test_odd_names_in_value_buckets(spark, many_buckets):
    rows = [(f"o{i % 2}", i % 2, f"{20200101 + i % 28}", float(i % 100), float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "new_org string, new_target int, new_date string, `a.b` double, `c``d` double")
    plain = df.toDF("new_org", "new_target", "new_date", "x", "y")
    found = {r.feature: r.iv for r in cs.information_value(df, ["a.b", "c`d"]).collect()}
    expected = {r.feature: r.iv for r in cs.information_value(plain, ["x", "y"]).collect()}
    assert found == {"a.b": expected["x"], "c`d": expected["y"]}


def test_running_totals_need_no_sketch_of_the_rows(spark, many_buckets, monkeypatch):
    def sketch(*_):
        raise AssertionError("a second pass over all rows")

    rows = [(None if i % 5 == 0 else f"k{i % 3}", float(i * 7 % 101), i % 2) for i in range(3_000)]
    df = spark.createDataFrame(rows, "k string, x double, bad int")
    monkeypatch.setattr(type(df), "approxQuantile", sketch)
    cells, bucketed = ordered.value_cells(df, ["x"], ["k"], {"n": F.count("*"), "bad": F.sum("bad")})
    found = ordered.running_totals(cells, ["k", "feature"], ["value"], ["n", "bad"], bucketed).collect()
    assert bucketed and len(found) == len({(k, x) for k, x, _ in rows})
    for r in found:
        own = [(x, y) for k, x, y in rows if k == r.k]
        assert (r.n_upto, r.n_all) == (sum(x <= r.value for x, _ in own), len(own))
        assert (r.bad_upto, r.bad_all) == (sum(y for x, y in own if x <= r.value), sum(y for _, y in own))


def test_scopes_and_their_whole_come_from_one_sort(spark):
    rng = random.Random(3)
    rows = sorted({(rng.choice(["o1", "o2", "o3", None]), rng.choice("ab"), float(rng.randint(0, 40))) for _ in range(400)}, key=str)
    rows = [(*r, rng.randint(1, 5), rng.choice([None, 0, 1])) for r in rows]
    cells = spark.createDataFrame(rows, "org string, feature string, value double, n long, bad long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # places go on from batch to batch
    try:
        for whole in (None, "all"):
            found = ordered.scoped_totals(cells, "org", ["feature"], "value", ["n", "bad"], whole).collect()
            expected = []
            for scope, feature in {(r[0], r[1]) for r in rows} | {("all", r[1]) for r in rows if whole}:
                own = [r for r in rows if r[1] == feature and scope in (r[0], "all")]
                for value in {r[2] for r in own}:
                    upto = [r for r in own if r[2] <= value]
                    expected.append((scope, feature, value, *(sum(r[k] or 0 for r in part) for part, k in ((upto, 3), (upto, 4), (own, 3), (own, 4)))))
            assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
