"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config


def is_missing(column: str, data_type: T.DataType, sentinels: Sequence[float]) -> Column:
    """Null, NaN or (for numbers) one of the sentinel values."""
    value = F.col("`" + column.replace("`", "``") + "`")
    missing = value.isNull()
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(value)
    if sentinels and isinstance(data_type, T.NumericType):
        missing = missing | F.coalesce(value.isin(*sentinels), F.lit(False))
    return missing


def floored(share: Column) -> Column:
    return F.greatest(share, F.lit(config.SHARE_FLOOR))


def woe_of(good_share: Column, bad_share: Column) -> Column:
    """Log ratio of the floored shares, clipped to the WOE limit."""
    ratio = F.ln(floored(good_share) / floored(bad_share))
    return F.greatest(F.lit(-config.WOE_LIMIT), F.least(F.lit(config.WOE_LIMIT), ratio))


def percent_text(share: Column) -> Column:
    """Share as text such as ``12.34%``."""
    return F.format_string("%.2f%%", F.bround(share * 100, 2))


def yyyymmdd(column: str, data_type: T.DataType) -> Column:
    """Eight-digit date text from a date, a timestamp or a date-like text; never null."""
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(F.col(column), "yyyyMMdd")
    else:
        text = F.substring(F.regexp_replace(F.col(column).cast("string"), "-", ""), 1, 8)
    return F.coalesce(text, F.lit("nan"))


def severity(value: Column, high: float) -> Column:
    return F.when(value > high, F.lit("HIGH")).otherwise(F.lit("MEDIUM"))
