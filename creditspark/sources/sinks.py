"""Writing samples and reports."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.texts import HEADERS
from ..plans.longform import MONTH

# Fixed value: byte order mark that makes spreadsheet programs read UTF-8.
BOM = "\ufeff"


def write_parquet(df: DataFrame, path: str, by_month: bool = False, mode: str = "overwrite") -> None:
    """Parquet table, optionally one folder per month so later reads prune months."""
    writer = df.write.mode(mode)
    if by_month and MONTH in df.columns:
        writer = writer.partitionBy(MONTH)
    writer.parquet(path)


def with_report_headers(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: h for c, h in HEADERS.items() if c in df.columns})


def write_csv(df: DataFrame, path: str, bom: bool = True, report_headers: bool = False) -> None:
    """Header CSV files; the first header cell carries a byte order mark."""
    if report_headers:
        df = with_report_headers(df)
    if bom and df.columns:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_feature_list(spark: SparkSession, features: Sequence[str], path: str) -> None:
    """The selected features as a JSON array of one file, as ``read_feature_list`` takes it."""
    text = json.dumps(list(features), ensure_ascii=False, indent=1)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def stamped(df: DataFrame, name: str = "generated_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())
