"""The plans that matter at scale: pruned scans, map-side combines, no Python in the hot path."""

import os
import re

import pytest

import creditspark as cs
from workload import fixtures as fx

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_statistics_read_only_their_columns(spark):
    text = plan(cs.org_month_stats(fx.sample(spark, FOLDER, "quantity")))
    lines = next(s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "l_quantity" in s)
    assert "l_tax" not in lines and "l_extendedprice" not in lines
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_missing_rates_are_one_partial_aggregation(spark):
    text = plan(cs.missing_detail(fx.sample(spark, FOLDER), features=fx.FEATURES))
    assert "partial_count" in text
    assert text.count("FileScan") == len(fx.TABLES)
    # Only the sample grouping and the small roll-up shuffle data above the joins.
    assert "Python" not in text and "NestedLoop" not in text


def test_woe_is_a_projection(spark):
    df = spark.createDataFrame([(i % 2, float(i)) for i in range(100)], "new_target int, x double")
    fitted = cs.fit_woe(df, ["x"])
    text = plan(cs.woe_transform(df, fitted))
    assert "Exchange" not in text and "Join" not in text


def test_first_row_per_key_has_no_window(spark):
    df = spark.createDataFrame([(i, "x" * 20) for i in range(100)] + [(7, "a")], "k int, t string")
    text = plan(cs.dedupe_first(df, ["k"]))
    assert "Window" not in text
    single, compared = text.split("Union", 1)[1].split("SortAggregate", 1)[0], text.split("SortAggregate", 1)[1]
    # Rows of keys that occur once are in no aggregate and no shuffle; the others are found by their keys first.
    assert "LeftAnti" in text and "LeftSemi" in compared and "Exchange" not in single.split("LeftAnti")[0]
    assert cs.dedupe_first(df, ["k"]).where("k = 7").first().t == "a" and cs.dedupe_first(df, ["k"]).count() == 100


def test_tree_passes_sort_nothing(spark):
    from pyspark.sql import functions as F

    from creditspark.operators import binning

    df = spark.createDataFrame([(i % 2, float(i), "o") for i in range(200)], "new_target int, x double, new_org string")
    cells = binning.binning_cells(df, ["x"])
    node = cells.select("scope", "feature").distinct().selectExpr(
        "*", "1L AS min_leaf", "1L AS id", "0L AS start_n", "0L AS start_bad", "200L AS n", "100L AS bad")
    stretches = binning.stretches_of(cells)
    text = plan(binning._best_cuts(cells, stretches, node, True))
    # Cells meet the few promising stretches in a broadcast join; only what is left there is compared.
    scanned = text.split("BroadcastHashJoin")[0]
    assert "Exchange hashpartitioning(scope" not in scanned.split("SortAggregate")[-1] and "BroadcastHashJoin [scope" in text
    chosen = binning._promising(stretches, node)
    assert chosen.where("scope = '__overall__'").count() < 0.2 * stretches.where("scope = '__overall__'").count()
    assert binning._best_cuts(cells, stretches, node, True).filter(F.col("best.gain").isNull()).isEmpty()


def test_correlation_keeps_the_partitioning(spark):
    text = plan(cs.correlation_pairs(fx.sample(spark, FOLDER, "quantity", "tax"), ["quantity", "tax"]))
    assert "Coalesce" not in text


def test_scores_need_one_scan_for_all_segments(spark):
    text = plan(cs.segment_stability(fx.scored(spark, FOLDER)))
    assert len(re.findall("FileScan parquet.*l_quantity", text)) == 1
    assert "Python" not in text
