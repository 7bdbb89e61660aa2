import random

import pytest

import creditspark as cs


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, new_date string, new_target int")


def random_rows(seed, n, days):
    rng = random.Random(seed)
    return [(i, f"202301{rng.randint(1, days):02}", int(rng.random() < 0.3)) for i in range(n)]


@pytest.mark.parametrize("n, days", [(20, 3), (101, 28), (50, 1)])
def test_time_split_follows_the_order(spark, n, days):
    rows = random_rows(n, n, days)
    placed = {r.id: r.split for r in cs.time_split(frame(spark, rows), tiebreak=["id"]).collect()}
    train, val, test = cs.split_sizes(n)
    expected = ["train"] * train + ["val"] * val + ["test"] * test
    assert [placed[r[0]] for r in sorted(rows, key=lambda r: (r[1], r[0]))] == expected


def test_sizes(spark):
    assert cs.split_sizes(10_000) == (7225, 1275, 1500)
    assert cs.split_sizes(10_000, val_of_rest=False) == (7000, 1500, 1500)


def test_copies_of_one_row_are_split_by_number(spark):
    rows = [(1, "20230101", 0)] * 70 + [(2, "20230102", 1)] * 30
    placed = cs.time_split(frame(spark, rows))
    assert {r.split: r.rows for r in cs.split_summary(placed).collect()} == {"train": 73, "val": 12, "test": 15}
    train, val, test = cs.split_frames(placed)
    assert train.count() == 73 and "split" not in test.columns
    assert {r.id for r in val.collect()} == {2}


@pytest.mark.parametrize("n, folds", [(23, 5), (60, 4)])
def test_stratified_folds(spark, n, folds):
    rows = random_rows(n + 1, n, 9)
    placed = {r.id: r.fold for r in cs.stratified_folds(frame(spark, rows), folds, ["id"]).collect()}
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    lead = ordered[0][2]
    laid = [r for r in ordered if r[2] == lead] + [r for r in ordered if r[2] != lead]
    for label in (0, 1):
        share = [0] * folds
        for place, row in enumerate(laid):
            if row[2] == label:
                share[place % folds] += 1
        expected = [fold + 1 for fold in range(folds) for _ in range(share[fold])]
        assert [placed[r[0]] for r in ordered if r[2] == label] == expected


def test_forward_folds(spark):
    rows = random_rows(3, 47, 9)
    placed = {r.id: r.fold for r in cs.forward_folds(frame(spark, rows), 4, ["id"]).collect()}
    expected = [0] * (47 - 4 * 9) + [f for f in range(1, 5) for _ in range(9)]
    assert [placed[r[0]] for r in sorted(rows, key=lambda r: (r[1], r[0]))] == expected


def test_rows_without_date_or_class_stay(spark):
    rows = [(None if i % 10 == 0 else f"2023{i % 12 + 1:02d}01", None if i % 7 == 0 else i % 2, float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "new_date string, new_target int, x double")
    assert cs.time_split(df).count() == 1000
    assert cs.stratified_folds(df, 3).count() == 1000
    assert cs.forward_folds(df, 3).count() == 1000


def test_inputs_are_evaluated_once(spark):
    """Splits, folds and score tables of a derived table read its source once, over all their jobs."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = [(f"202301{1 + i % 28:02}", i % 2, i / 7) for i in range(500)]
    df = spark.createDataFrame(rows, "new_date string, new_target int, p double").mapInPandas(counted, "new_date string, new_target int, p double")
    for make in (cs.time_split, cs.stratified_folds, cs.forward_folds, cs.score_table):
        before = seen.value
        assert make(df).count() > 0
        assert seen.value - before == 500, make.__name__
