import random

import pytest
from pyspark.sql import functions as F

from creditspark.operators import binning, iv, scans

from .test_binning import frame


def odd_rows():
    """One hot value, one column of all different values, one of few; values and labels without a link in part."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        a = 0.0 if rng.random() < 0.3 else rng.gauss(0, 1)
        c = None if i % 4 == 0 else float("nan") if i % 9 == 0 else float(rng.randint(-2, 2))
        rows.append((rng.choice(["o1", "o2", None]), int(rng.random() < (0.4 if a > 0.5 else 0.2)), a, rng.random(), c))
    return rows


@pytest.mark.parametrize("listed, held", [(None, None), (0, 1)])
def test_scans_find_the_leaves_of_the_cells(spark, monkeypatch, listed, held):
    if listed is not None:
        monkeypatch.setattr(scans, "LISTED", listed)
        monkeypatch.setattr(scans, "HELD", held)
    monkeypatch.setattr(scans, "STRETCHES_PER_ROOT", 1)
    df = frame(spark, odd_rows())
    cells = binning.tree_leaves(binning.binning_cells(df, ["a", "b", "c"]), 4).collect()
    assert sorted(map(str, scans.scanned_leaves(df, ["a", "b", "c"], 4).collect())) == sorted(map(str, cells))


def test_information_value_shuffles_no_cell_of_every_value(spark, monkeypatch):
    """A round's values are a small part of the rows' different values."""
    df = spark.range(60_000).select(
        F.lit("o").alias("new_org"), (F.xxhash64("id", F.lit(1)) % 10 > F.when(F.col("id") < 20_000, 2).otherwise(6)).cast("int").alias("new_target"),
        F.col("id").cast("double").alias("a"),
    )
    met = []
    whole = scans.best_of
    monkeypatch.setattr(scans, "best_of", lambda cells: (met.append(cells.count()), whole(cells))[1])
    assert [r.feature for r in iv.information_value(df, ["a"]).collect()] == ["a"]
    assert met and max(met) < 20_000
