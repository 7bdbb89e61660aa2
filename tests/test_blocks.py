"""Boosting on stored blocks of rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspark.operators import boosting


@pytest.mark.parametrize("bins", [9, 300])
def test_passes_read_blocks_of_rows(spark, monkeypatch, bins):
    monkeypatch.setattr(boosting, "BLOCK", 64)
    rows = [(i, [i % bins, i * 7 % bins], int(i % bins > bins // 2)) for i in range(900)]
    df = spark.createDataFrame(rows, "row_id long, bins array<short>, y long").repartition(3)
    table = df.select("row_id", "bins", F.lit(1).cast("long").alias("trains"), F.lit(0).cast("long").alias("held"), F.col("y").alias("label"))
    written_columns = []
    write = boosting.written_at

    def noted(frame):
        written_columns.append(dict(frame.dtypes))
        return write(frame)

    monkeypatch.setattr(boosting, "written_at", noted)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    model = boosting.grow(table, [boosting.Settings(rounds=2, depth=1, least_rows=1)], 2, bins)[0]
    assert all(set(c.values()) == {"binary"} for c in written_columns)
    assert [t.feature[0] for t in model.trees] == [0, 0] and model.trees[0].limit[0] == bins // 2
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def _table(spark, rows, features, parts):
    r = np.random.default_rng(3)
    x = r.integers(0, 9, (rows, features))
    y = (r.random(rows) < 1 / (1 + np.exp(2 - x[:, 0] / 3 - (x[:, 1] > 4)))).astype(int)
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(rows)], "row_id long, bins array<short>, y long").coalesce(parts)
    return df.select("row_id", "bins", F.lit(1).cast("long").alias("trains"), F.lit(0).cast("long").alias("held"), F.col("y").alias("label"))


def test_a_pass_tells_of_two_levels(spark, monkeypatch):
    table = _table(spark, 600, 3, 2)
    settings = [boosting.Settings(rounds=3, depth=4, leaves=11, row_share=0.8)]
    passes = []
    added = boosting._added
    monkeypatch.setattr(boosting, "_added", lambda *a: (passes.append(1), added(*a))[1])
    by_pairs = boosting.grow(table, settings, 3, 9)[0]
    assert len(passes) <= 3 * 2
    monkeypatch.setattr(boosting, "PAIR_CELLS", 0)
    assert boosting.grow(table, settings, 3, 9)[0].trees == by_pairs.trees
    assert len(passes) > 3 * 4 and max(len(t.feature) for t in by_pairs.trees) > 9


def test_blocks_of_one_partition_are_read_by_all_tasks(spark, monkeypatch):
    tables = []
    sums = boosting._grow_all
    monkeypatch.setattr(boosting, "_grow_all", lambda models, stored, *a: (tables.append(stored), sums(models, stored, *a)))
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        held = list(batches)
        seen.add(any(b.num_rows for b in held))
        yield from held

    monkeypatch.setattr(boosting, "removed", lambda *a: None)
    boosting.grow(_table(spark, 4000, 2, 1), [boosting.Settings(rounds=1, depth=1)], 2, 9)
    tables[0].mapInArrow(noted, tables[0].schema).count()
    assert seen.value > 1


@pytest.mark.parametrize("leaves", [2, 40, 150])
def test_leaves_by_bits_are_those_of_the_splits(leaves):
    r = random.Random(leaves)
    tree = boosting.Tree()
    tree.add(0.5, 1)
    open_ = [0]
    while len(open_) < leaves:
        node = open_.pop(r.randrange(len(open_)))
        tree.feature[node], tree.limit[node], tree.missing_left[node] = r.randrange(5), r.randrange(0, 8), r.random() < 0.5
        tree.left[node], tree.right[node] = tree.add(r.random(), 1), tree.add(r.random(), 1)
        open_ += [tree.left[node], tree.right[node]]
    x = np.random.default_rng(leaves).integers(0, 9, (5, 500)).astype(np.int16)

    def value(i, node=0):
        if tree.feature[node] < 0:
            return tree.value[node]
        b = x[tree.feature[node], i]
        goes = tree.missing_left[node] if b == 0 else b <= tree.limit[node]
        return value(i, tree.left[node] if goes else tree.right[node])

    assert boosting.raw_scores([tree], x).tolist() == [value(i) for i in range(500)]


def test_ids_that_count_up_and_equal_bits_are_stored_once(spark, monkeypatch):
    table = _table(spark, 900, 2, 1)
    packed = boosting._packed(2, 9, [0.0], 400)
    blocks = [r for b in packed(iter(table.toArrow().to_batches())) for r in b.to_pylist()]
    assert len(blocks) == 3 and all(len(b["row_id"]) == 8 and len(b["trains"]) == len(b["held"]) == 1 for b in blocks)
    # The same model from rows with gaps between their ids has the same shares of rows in a round.
    s = [boosting.Settings(rounds=2, depth=2, row_share=0.5)]
    want = boosting.grow(table, s, 2, 9)[0].trees
    mixed = table.orderBy(F.xxhash64("row_id"))
    assert boosting.grow(mixed, s, 2, 9)[0].trees == want
