from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("creditspark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from creditspark import release

    release(session)
    session.stop()


@pytest.fixture
def many_buckets(spark):
    """Run with very small value buckets, as on a table of billions of rows."""
    spark.conf.set("spark.creditspark.rowsPerBucket", "40")
    yield
    spark.conf.unset("spark.creditspark.rowsPerBucket")


@pytest.fixture(params=[False, True], ids=["one_bucket", "many_buckets"])
def buckets(request):
    if request.param:
        request.getfixturevalue("many_buckets")
    return request.param
