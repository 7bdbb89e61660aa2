"""Missing rates, value-ratio bands and the missing-rate filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import texts
from ..functions.scalars import is_missing
from ..plans.longform import ORG, OVERALL, features_of, numeric_features
from ..plans.storage import as_stored, checkpointed
from .bands import band_counts


def missing_counts(df: DataFrame, features: Sequence[str], sentinels: Sequence[float]) -> DataFrame:
    """(org, feature, rows, missing): one wide aggregation over the sample, turned
    long only after it shrank to one row per organisation."""
    tests = [is_missing(f, df.schema[f].dataType, sentinels) for f in features]
    wide = df.groupBy(F.col(ORG).alias("org")).agg(
        F.count("*").alias("rows"), *[F.count_if(t).alias(f) for f, t in zip(features, tests)]
    )
    return wide.unpivot(["org", "rows"], list(features), "feature", "missing")


def missing_detail(
    df: DataFrame, sentinels: Sequence[float] = config.SENTINELS, features: Sequence[str] | None = None
) -> DataFrame:
    """(feature, scope, missing_rate) overall and per organisation, rounded to 4 digits."""
    # Two identifier names that are never reported.
    chosen = [f for f in (features or features_of(df)) if f not in ("record_id", "target")]
    counts = missing_counts(df, chosen, sentinels)
    rate = F.bround(F.sum("missing") / F.sum("rows"), 4)
    scoped = counts.select(
        "feature", F.explode(F.array(F.lit(OVERALL), F.col("org"))).alias("scope"), "missing", "rows"
    )
    return scoped.groupBy("feature", "scope").agg(rate.alias("missing_rate"))


def missing_drops(
    detail: DataFrame, threshold: float = config.MISSING_THRESHOLD, max_orgs: int = config.MAX_UNSTABLE_ORGS
) -> DataFrame:
    """(feature, reason) for features missing too often overall or in too many organisations."""
    rate, overall = F.col("missing_rate"), F.col("scope") == OVERALL
    rolled = detail.groupBy("feature").agg(
        F.max(F.when(overall, rate)).alias("overall"),
        F.count_if(~overall & (rate > threshold)).alias("orgs"),
    )
    reasons = F.concat_ws(
        "; ",
        F.when(
            F.col("overall") > threshold,
            F.format_string(texts.HIGH_MISSING, texts.four(F.col("overall")), F.lit(str(threshold))),
        ),
        F.when(
            F.col("orgs") >= max_orgs,
            F.format_string(texts.HIGH_MISSING_ORGS, F.col("orgs"), F.lit(str(threshold))),
        ),
    )
    return rolled.select("feature", reasons.alias("reason")).filter("reason != ''")


def value_ratio_bands(
    df: DataFrame,
    features: Sequence[str] | None = None,
    oos_orgs: Sequence[str] = (),
    limits: Sequence[float] = config.VALUE_BANDS,
) -> DataFrame:
    """Number and share of features per organisation and band of the non-null share."""
    chosen = list(features) if features is not None else numeric_features(df)
    shares = missing_counts(df, chosen, ()).select(
        "org", "feature", ((F.col("rows") - F.col("missing")) / F.col("rows")).alias("value")
    )
    labels = []
    for low, high in zip(limits, limits[1:]):
        start = "0" if low == 0 else f"{low:.0%}"
        labels.append(f"[{start}, {high:.0%}{']' if high == 1.0 else ')'}")
    return band_counts(shares, limits, labels, oos_orgs, closed_end=1.0)


def filter_missing(
    df: DataFrame,
    threshold: float = config.MISSING_THRESHOLD,
    max_orgs: int = config.MAX_UNSTABLE_ORGS,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Narrowed sample, missing detail, drop list and value-ratio bands."""
    detail = checkpointed(missing_detail(df))
    drops = checkpointed(missing_drops(detail, threshold, max_orgs))
    bands = value_ratio_bands(df)
    return as_stored(df.drop(*[r.feature for r in drops.collect()]), df), detail, drops, bands
