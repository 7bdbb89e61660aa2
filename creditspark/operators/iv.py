"""Information value, overall and per organisation, and its filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import texts
from ..plans.longform import OVERALL, TARGET, varying_numeric_features
from ..plans.storage import as_stored, checkpointed
from .bands import iv_bands
from .binning import KEYS, leaf_stats
from .scans import scanned_leaves


def _iv(df, features, n_bins, by_org, target) -> DataFrame:
    stats = leaf_stats(scanned_leaves(df, features, n_bins, by_org, target))
    return stats.groupBy(*KEYS).agg(F.bround(F.sum("iv_part"), 4).alias("iv"))


def information_value(
    df: DataFrame, features: Sequence[str], target: str = TARGET, n_bins: int = config.IV_BINS
) -> DataFrame:
    """(feature, iv), highest first. Nulls are left out; a feature with fewer than
    50 values or one class has no row."""
    return _iv(df, features, n_bins, False, target).select("feature", "iv").orderBy(F.desc("iv"), "feature")


def iv_by_org(
    df: DataFrame, features: Sequence[str], target: str = TARGET, n_bins: int = config.IV_BINS
) -> DataFrame:
    """(feature, scope, iv) for the whole sample and every organisation in one job
    per tree round; a feature without an overall value is left out."""
    detail = checkpointed(_iv(df, features, n_bins, True, target))
    known = detail.filter(F.col("scope") == OVERALL).select("feature")
    return detail.join(known, "feature", "left_semi").select("feature", "scope", "iv")


def wide_by_scope(detail: DataFrame, value: str, scopes: Sequence[str]) -> DataFrame:
    """Report form: one row per feature, the overall value, then one column per organisation."""
    wide = detail.groupBy("feature").pivot("scope", [OVERALL, *scopes]).agg(F.first(value))
    return wide.withColumnRenamed(OVERALL, "overall").orderBy(F.desc("overall"), "feature")


def iv_drops(
    detail: DataFrame,
    threshold: float = config.IV_THRESHOLD,
    org_threshold: float = config.ORG_IV_THRESHOLD,
    max_orgs: int = config.MAX_ORG_LOW_IV,
) -> DataFrame:
    """(feature, reason) for features weak overall or in too many organisations."""
    iv, overall = F.col("iv"), F.col("scope") == OVERALL
    rolled = detail.groupBy("feature").agg(
        F.max(F.when(overall, iv)).alias("overall"),
        F.count_if(~overall & (iv < org_threshold)).alias("orgs"),
    )
    reasons = F.concat_ws(
        "; ",
        F.when(
            F.col("overall") < threshold,
            F.format_string(texts.LOW_IV, texts.four(F.col("overall")), F.lit(str(threshold))),
        ),
        F.when(
            F.col("orgs") >= max_orgs,
            F.format_string(texts.LOW_IV_ORGS, F.col("orgs"), F.lit(str(org_threshold))),
        ),
    )
    return rolled.select("feature", reasons.alias("reason")).filter("reason != ''")


def filter_iv(
    df: DataFrame,
    threshold: float = config.IV_THRESHOLD,
    org_threshold: float = config.ORG_IV_THRESHOLD,
    max_orgs: int = config.MAX_ORG_LOW_IV,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Narrowed sample, IV detail, drop list and IV bands. Text features pass."""
    features = varying_numeric_features(df)
    detail = checkpointed(iv_by_org(df, features))
    drops = checkpointed(iv_drops(detail, threshold, org_threshold, max_orgs))
    return as_stored(df.drop(*[r.feature for r in drops.collect()]), df), detail, drops, iv_bands(detail)
