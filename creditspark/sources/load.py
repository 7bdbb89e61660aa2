"""Reading and cleaning a labelled application sample."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.scalars import yyyymmdd
from ..plans.longform import DATE, MONTH, ORG, TARGET, constant_columns, named
from ..plans.storage import as_stored, is_small, reads_stored, removed, row_width, written, written_at

FORMATS = ("parquet", "csv", "json", "orc")


def read_table(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None
) -> DataFrame:
    """Read one of the supported formats, named by ``fmt`` or by the file ending.

    A path without a known ending is read as parquet. Nothing is guessed by
    trying readers in turn: a wrong format fails with Spark's own error.
    """
    ending = path.rstrip("/*").rsplit(".", 1)[-1].lower()
    fmt = fmt or (ending if ending in FORMATS else "parquet")
    if fmt not in FORMATS:
        raise ValueError(f"cannot read {path}: format {fmt!r} is none of {', '.join(FORMATS)}")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    return reader.load(path)


def read_feature_list(spark: SparkSession, path: str, df: DataFrame | None = None) -> list[str]:
    """Feature names from a JSON array file, kept only where ``df`` has them."""
    names = json.loads(spark.read.text(path, wholetext=True).first().value)
    return [n for n in names if df is None or n in df.columns]


def null_sentinels(df: DataFrame, sentinels: Sequence[float] = config.SENTINELS) -> DataFrame:
    """Sentinel numbers and NaN become null in every numeric column."""
    columns = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.NumericType):
            bad = value.isin(*sentinels) if sentinels else F.lit(False)
            if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
                bad = bad | F.isnan(value)
            value = F.when(~bad, value)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def valid_labels(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isin(0, 1))


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row per key: lowest in ``order``, then in all columns. Nulls in keys count as equal.

    Keys alone are counted first, by hash. Rows whose key occurs once, usually nearly all, pass through as they
    are; only rows of repeated keys are compared, by a minimum over the row, which combines map-side, so a
    key with very many copies never gathers in one task. ``df`` is read three times. Where it reads a stored table and
    the repeated keys are few, the result costs only scans of that table.
    """
    lead = list(order or [])
    rest = [c for c in df.columns if c not in keys and c not in lead]
    repeated = df.groupBy(*map(named, keys)).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    repeated = written(repeated).toDF(*[f"_key_{i}" for i in range(len(keys))])
    small = F.broadcast(repeated) if is_small(repeated, width=row_width(repeated)) else repeated
    same = reduce(Column.__and__, [named(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    kept = F.min(F.struct(*map(named, [*lead, *rest]))).alias("_row")
    compared = df.join(small, same, "left_semi").groupBy(*map(named, keys)).agg(kept).select(
        *[named(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    )
    found = df.join(small, same, "left_anti").unionByName(compared)
    return as_stored(found, df) if small is not repeated else found


def clean_sample(
    df: DataFrame,
    date_col: str,
    label_col: str,
    org_col: str | None = None,
    key_cols: Sequence[str] = (),
    drop_cols: Sequence[str] = (),
    sentinels: Sequence[float] = config.SENTINELS,
    order_cols: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    drop_constants: bool = True,
) -> DataFrame:
    """Cleaned sample with role columns ``new_date, new_date_ym, new_target, new_org``.

    Steps in order: sentinels to null, valid labels, named drops (``exclude`` takes
    a compliance list such as ``config.EXCLUDED_FEATURES``), first row per key,
    constant features out, role names, date text and month, default organisation.
    ``drop_constants=False`` saves the extra pass that looks for constant features.
    """
    missing = [c for c in (date_col, label_col) if c not in df.columns]
    if missing:
        raise ValueError(f"the sample has no column {', '.join(missing)}")
    df = valid_labels(null_sentinels(df, sentinels), label_col)
    roles = {date_col, label_col, org_col}
    keys = [k for k in key_cols if k in df.columns]
    df = df.drop(*drop_cols, *[c for c in exclude if c not in roles and c not in keys])
    keys = [k for k in keys if k in df.columns]
    if keys:
        # Stored before keys are compared, which reads the rows three times, and again if that shuffles rows: the constant
        # test below and the caller both read the result.
        rows, path = (df, None) if reads_stored(df) else written_at(df)
        found = dedupe_first(rows, keys, order_cols)
        df = found.drop(*keys)
        if not reads_stored(found):
            df = written(df)
            if path is not None:
                removed(df.sparkSession, path)
    if drop_constants:
        df = df.drop(*constant_columns(df, [c for c in df.columns if c not in roles]))

    names = {date_col: DATE, label_col: TARGET}
    if org_col and org_col in df.columns:
        names[org_col] = ORG
    df = df.withColumnsRenamed(names)
    df = df.withColumns(
        {DATE: yyyymmdd(DATE, df.schema[DATE].dataType), TARGET: F.col(TARGET).cast("int")}
    )
    df = df.withColumn(MONTH, F.substring(DATE, 1, 6))
    if ORG not in df.columns:
        df = df.withColumn(ORG, F.lit("default"))
    return df


def load_sample(spark: SparkSession, path: str, date_col: str, label_col: str, **options) -> DataFrame:
    """Read a file and clean it; ``fmt`` and ``schema`` go to the reader."""
    reading = {k: options.pop(k) for k in ("fmt", "schema") if k in options}
    return clean_sample(read_table(spark, path, **reading), date_col, label_col, **options)
