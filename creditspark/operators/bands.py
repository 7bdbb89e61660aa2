"""Distribution of per-feature values over fixed bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.scalars import percent_text
from ..functions.texts import sample_tag
from ..plans.longform import OVERALL


def band_labels(limits: Sequence[float]) -> list[str]:
    return [f"[{low:g}, {high:g})" for low, high in zip(limits, limits[1:])]


def band_counts(
    values: DataFrame,
    limits: Sequence[float],
    labels: Sequence[str],
    oos_orgs: Sequence[str] = (),
    closed_end: float | None = None,
) -> DataFrame:
    """(org, sample_type, band, n_features, share) from rows (org, feature, value).

    Every band is kept, also with no feature in it. Null values do not count.
    """
    value = F.col("value")
    counted = []
    for i, (low, high) in enumerate(zip(limits, limits[1:])):
        inside = value >= low
        if high != float("inf"):
            inside = inside & ((value <= high) if high == closed_end else (value < high))
        counted.append(F.count_if(inside).alias(f"n{i}"))
    totals = values.groupBy("org").agg(F.count("value").alias("total"), *counted)
    bands = [
        F.struct(F.lit(label).alias("band"), F.col(f"n{i}").alias("n_features"))
        for i, label in enumerate(labels)
    ]
    rows = totals.select("org", "total", F.inline(F.array(*bands)))
    share = F.when(F.col("total") > 0, F.col("n_features") / F.col("total")).otherwise(F.lit(0.0))
    return rows.select(
        "org",
        sample_tag("org", oos_orgs).alias("sample_type"),
        "band",
        "n_features",
        percent_text(share).alias("share"),
    )


def iv_bands(
    iv_detail: DataFrame, oos_orgs: Sequence[str] = (), limits: Sequence[float] = config.IV_BANDS
) -> DataFrame:
    """Bands of the per-organisation information values (rows of the overall scope are skipped)."""
    values = iv_detail.filter(F.col("scope") != OVERALL).select(
        F.col("scope").alias("org"), "feature", F.col("iv").alias("value")
    )
    return band_counts(values, limits, band_labels(limits), oos_orgs)


def psi_bands(
    psi_detail: DataFrame, oos_orgs: Sequence[str] = (), limits: Sequence[float] = config.PSI_BANDS
) -> DataFrame:
    """Bands of each feature's highest stability index over the periods of an organisation."""
    values = psi_detail.groupBy("org", "feature").agg(F.max("psi").alias("value"))
    return band_counts(values, limits, band_labels(limits), oos_orgs)
