"""Alphabetical codes of text features, from a dictionary that never reaches the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.longform import named
from ..plans.ranking import with_places
from ..plans.storage import BROADCAST_ROWS, written

# A missing text is this text; a text that was not there when the codes were made gets this code.
MISSING = "nan"
UNSEEN = -1
# Texts with more than this share of the rows are hot: they are coded by a small broadcast table.
HOT_SHARE = 1e-3


def _filled(feature: str) -> Column:
    return F.coalesce(named(feature), F.lit(MISSING))


def category_codes(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value, n, code): every text of each feature, its rows, and its place in alphabetical order."""
    each = [F.struct(F.lit(f).alias("feature"), _filled(f).alias("value")) for f in features]
    long = df.select(F.explode(F.array(*each)).alias("x")).select("x.feature", "x.value")
    return with_places(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")), ["feature"], ["value"], "code")


def with_codes(df: DataFrame, codes: DataFrame, features: Sequence[str]) -> DataFrame:
    """Replace each text feature by its code (``UNSEEN`` for new texts) as a double.

    A small dictionary is broadcast. Of a large one only the hot texts are (at most
    ``1 / HOT_SHARE`` of them); the other rows meet the rest of the dictionary by hash, and rows already
    coded are spread over keys of their own there.
    """
    for f in features:
        own = codes.where(F.col("feature") == f).select(F.col("value").alias("_value"), "n", F.col("code").cast("double").alias("_code"))
        total, n = own.agg(F.sum("n"), F.count(F.lit(1))).first()
        df = df.withColumn("_value", _filled(f))
        if n <= BROADCAST_ROWS:
            df = df.join(F.broadcast(own.drop("n")), "_value", "left")
        else:
            is_hot = F.col("n") > HOT_SHARE * total
            hot = own.where(is_hot).select("_value", F.col("_code").alias("_hot"))
            df = df.join(F.broadcast(hot), "_value", "left")
            spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*map(named, df.columns)), F.lit(100_000)).cast("string"))
            df = df.withColumn("_value", F.when(F.col("_hot").isNull(), F.col("_value")).otherwise(spread))
            df = df.join(own.where(~is_hot).drop("n"), "_value", "left").withColumn("_code", F.coalesce("_hot", "_code")).drop("_hot")
        code = F.coalesce("_code", F.lit(float(UNSEEN)))
        df = df.select(*[code.alias(c) if c == f else named(c) for c in df.columns if c not in ("_value", "_code")])
    return df


def stored_codes(df: DataFrame, features: Sequence[str]) -> DataFrame | None:
    return written(category_codes(df, features)) if features else None
