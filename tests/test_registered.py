"""Every registered query against its SQL, on the smallest data folder."""

import os

import pytest

import __spark_entry__ as entry_module
from workload.oracles import ORACLES
from workload.queries import QUERIES

from . import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
# Fitted models, driver-side walks and reports.
WITHOUT_SQL = {
    "cv_summary", "tree_segments", "scorecard_fit", "scorecard_points", "tree_fit", "tree_importance", "cv_report", "search_report",
    "null_importance", "feature_selection", "selection_report", "tree_published", "null_importance_published", "scorecard_auc",
}


@pytest.fixture(scope="module")
def connection():
    return compare.duck(FOLDER)


def test_registration():
    assert set(ORACLES) | WITHOUT_SQL == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    result = QUERIES[name](spark, FOLDER)
    assert compare.differences(result, connection, ORACLES[name]) is None
