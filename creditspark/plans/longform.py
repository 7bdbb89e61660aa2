"""Column roles and the long (feature, value) form most operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE, MONTH, TARGET, ORG = "new_date", "new_date_ym", "new_target", "new_org"
ROLES = (DATE, MONTH, TARGET, ORG)

# Name of the whole-sample scope next to the organisations.
OVERALL = "__overall__"


def features_of(df: DataFrame) -> list[str]:
    """Every column that is not a role column; reads the schema only."""
    return [c for c in df.columns if c not in ROLES]


def numeric_features(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.name not in ROLES and isinstance(f.dataType, T.NumericType)]


def text_features(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.name not in ROLES and isinstance(f.dataType, T.StringType)]


def present(features: Sequence[str], df: DataFrame) -> list[str]:
    """The listed features that the table really has, in list order."""
    return [f for f in features if f in df.columns]


def named(column: str) -> Column:
    """The column of exactly this name, also with dots or backticks in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def clean_double(column: Column | str) -> Column:
    """Value as double with NaN read as missing."""
    value = named(column).cast("double") if isinstance(column, str) else column.cast("double")
    return F.when(~F.isnan(value), value)


def _is_number(column: str, df: DataFrame) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def constant_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at most one distinct non-null value, found in one pass."""
    if not columns:
        return []
    picks = [clean_double(c) if _is_number(c, df) else named(c) for c in columns]
    row = df.agg(
        *[F.min(p).eqNullSafe(F.max(p)).alias(f"c{i}") for i, p in enumerate(picks)]
    ).first()
    return [c for i, c in enumerate(columns) if row[f"c{i}"]]


def varying_numeric_features(df: DataFrame) -> list[str]:
    """Numeric features with more than one distinct value."""
    names = numeric_features(df)
    fixed = set(constant_columns(df, names))
    return [n for n in names if n not in fixed]


def to_long(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rows (keep..., feature, value) for the non-missing values of all features.

    A narrow operation: the scan reads ``keep`` and ``features`` only.
    """
    wide = df.select(*map(named, keep), *[clean_double(f).alias(f) for f in features])
    return unpivoted(wide, keep, features).filter(F.col("value").isNotNull())


def unpivoted(wide: DataFrame, keep: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Rows (keep..., feature, value); none without features."""
    if not features:
        empty = [F.lit(None).cast("string").alias("feature"), F.lit(None).cast("double").alias("value")]
        return wide.select(*map(named, keep), *empty).filter(F.lit(False))
    return wide.unpivot([named(k) for k in keep], [named(f) for f in features], "feature", "value")
