"""Population stability index: of two samples, and per organisation and period."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import texts
from ..functions.scalars import floored
from ..plans.longform import MONTH, ORG, named, to_long, varying_numeric_features
from ..plans.ordered import exact_quantiles, long_of, plain_names, slots
from ..plans.storage import as_stored, checkpointed, join_checked
from .bands import psi_bands


def base_edges(base: DataFrame, features: Sequence[str], keys: Sequence[str], bins: int) -> DataFrame:
    """Stored inner quantile edges of the base sample per (keys, feature), exact at any size."""
    probs = [i / bins for i in range(1, bins)]
    return exact_quantiles(base, features, keys, probs).select(*keys, "feature", "edges")


def bin_counts(long: DataFrame, edges: DataFrame, keys: Sequence[str], by: Sequence[str], bins: int) -> DataFrame:
    """(by..., feature, counts): rows per bin ``[edge, next edge)`` as one array.

    The long rows meet the few edge rows in a size-checked broadcast join and are
    counted map-side, so only one row per group and task is shuffled.
    """
    joined = join_checked(long, edges, [*keys, "feature"])
    place = sum(
        ((F.col("value") >= F.element_at("edges", i)).cast("int") for i in range(1, bins)), F.lit(0)
    )
    counted = joined.select(*by, "feature", place.alias("_bin")).groupBy(*by, "feature").agg(
        *[F.count_if(F.col("_bin") == i).alias(f"_c{i}") for i in range(bins)]
    )
    return counted.select(*by, "feature", F.array(*[F.col(f"_c{i}") for i in range(bins)]).alias("counts"))


def bin_counts_by_search(df: DataFrame, edges: DataFrame, by: Sequence[str], bins: int) -> DataFrame:
    """``bin_counts`` of wide rows with edges per feature only: these few are literals, and a value finds its
    bin by binary search, without a join."""
    found = {r.feature: sorted(r.edges) for r in edges.select("feature", "edges").collect()}
    wide, names = plain_names(df, list(found), by)
    wide = slots(wide, {names[f]: sorted(set(e)) for f, e in found.items()})
    parts = {}
    for f, e in found.items():
        at = [-math.inf, *sorted(set(e))]
        parts[f] = F.get(F.array(*[F.lit(sum(x <= p for x in e)) for p in at]), F.col(f"{names[f]}__slot"))
    if not parts:
        return wide.select(*by, F.lit(None).cast("string").alias("feature"), F.array().cast("array<bigint>").alias("counts")).where(F.lit(False))
    long = long_of(wide, by, parts).where(F.col("x").isNotNull())
    counted = long.groupBy(*by, "feature").agg(*[F.count_if(F.col("x") == i).alias(f"_c{i}") for i in range(bins)])
    return counted.select(*by, "feature", F.array(*[F.col(f"_c{i}") for i in range(bins)]).alias("counts"))


def _size(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda total, n: total + n)


def psi_of(base: Column, actual: Column) -> Column:
    """Index of two count arrays, rounded to 4 digits; 0 when a side is empty."""
    base_n, actual_n = _size(base), _size(actual)

    def part(b: Column, a: Column) -> Column:
        base_share, actual_share = floored(b / base_n), floored(a / actual_n)
        return (actual_share - base_share) * F.ln(actual_share / base_share)

    total = F.aggregate(F.zip_with(base, actual, part), F.lit(0.0), lambda s, p: s + p)
    empty = base.isNull() | actual.isNull() | (base_n == 0) | (actual_n == 0)
    return F.when(empty, F.lit(0.0)).otherwise(F.bround(total, 4))


def psi_two_samples(
    base: DataFrame, current: DataFrame, features: Sequence[str], bins: int = config.PSI_BINS
) -> DataFrame:
    """(feature, psi) of two samples for all features in one job."""
    edges = base_edges(base, features, [], bins)
    sides = base.select(*map(named, features), F.lit("base").alias("_side")).unionByName(
        current.select(*map(named, features), F.lit("current").alias("_side"))
    )
    counts = bin_counts_by_search(sides, edges, ["_side"], bins).withColumnRenamed("_side", "side")
    pairs = counts.groupBy("feature").agg(
        F.max(F.when(F.col("side") == "base", F.col("counts"))).alias("base"),
        F.max(F.when(F.col("side") == "current", F.col("counts"))).alias("current"),
    )
    names = base.sparkSession.range(1).select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    return names.join(pairs, "feature", "left").select("feature", psi_of(F.col("base"), F.col("current")).alias("psi"))


def psi_by_org(
    df: DataFrame,
    features: Sequence[str],
    min_sample: int = config.PSI_MIN_SAMPLE,
    period_col: str = MONTH,
    bins: int = config.PSI_BINS,
) -> DataFrame:
    """(org, feature, period, psi) against each organisation's first period.

    The first period has index 0. The index is null where the period or the first
    period has fewer than ``min_sample`` rows. Organisations with one period have
    no rows. Every (org, period, feature) appears, also with no value at all.
    """
    sample = df.select(F.col(ORG).alias("org"), F.col(period_col).alias("period"), *features)
    sizes = checkpointed(
        sample.groupBy("org", "period")
        .agg(F.count("*").alias("rows"))
        .withColumn("first", F.min("period").over(Window.partitionBy("org")))
        .withColumn("periods", F.count("*").over(Window.partitionBy("org")))
        .filter("periods > 1")
    )
    firsts = sizes.filter("period = first").select("org", "period", F.col("rows").alias("base_rows"))
    base = join_checked(sample, firsts.select("org", "period"), ["org", "period"], "left_semi")
    edges = base_edges(base, features, ["org"], bins)
    counts = bin_counts(to_long(sample, features, ["org", "period"]), edges, ["org"], ["org", "period"], bins)

    names = F.explode(F.array(*[F.lit(f) for f in features])).alias("feature")
    grid = sizes.join(firsts.drop("period"), "org").select("org", "period", "first", "rows", "base_rows", names)
    filled = grid.join(counts, ["org", "period", "feature"], "left")
    whole = Window.partitionBy("org", "feature")
    with_base = filled.withColumn(
        "base_counts", F.max(F.when(F.col("period") == F.col("first"), F.col("counts"))).over(whole)
    )
    index = (
        F.when(F.col("period") == F.col("first"), F.lit(0.0))
        .when((F.col("rows") < min_sample) | (F.col("base_rows") < min_sample), F.lit(None))
        .otherwise(psi_of(F.col("base_counts"), F.col("counts")))
    )
    return with_base.select("org", "feature", "period", index.alias("psi"), "rows")


def psi_org_summary(
    detail: DataFrame, threshold: float = config.PSI_THRESHOLD, max_ratio: float = config.MAX_MONTHS_RATIO
) -> DataFrame:
    """(org, feature, unstable_periods, periods, unstable) over the periods with an index."""
    later = detail.withColumn("first", F.min("period").over(Window.partitionBy("org", "feature"))).filter(
        (F.col("period") > F.col("first")) & F.col("psi").isNotNull()
    )
    counted = later.groupBy("org", "feature").agg(
        F.count_if(F.col("psi") > threshold).alias("unstable_periods"), F.count("*").alias("periods")
    )
    allowed = F.greatest(F.lit(1), F.floor(F.col("periods") * F.lit(float(max_ratio))))
    return counted.withColumn("unstable", F.col("unstable_periods") >= allowed)


def psi_drops(
    detail: DataFrame,
    threshold: float = config.PSI_THRESHOLD,
    max_ratio: float = config.MAX_MONTHS_RATIO,
    max_orgs: int = config.MAX_UNSTABLE_ORGS,
    org_count: int | None = None,
) -> DataFrame:
    """(feature, reason, unstable_orgs) for features unstable in ``max_orgs`` or more organisations.

    ``org_count`` is the number of organisations in the sample (default: in the detail).
    """
    if org_count is None:
        org_count = detail.select("org").distinct().count()
    rolled = psi_org_summary(detail, threshold, max_ratio).groupBy("feature").agg(
        F.count_if("unstable").alias("orgs"),
        F.concat_ws(",", F.sort_array(F.collect_list(F.when(F.col("unstable"), F.col("org"))))).alias(
            "unstable_orgs"
        ),
    )
    return rolled.filter(F.col("orgs") >= max_orgs).select(
        "feature",
        F.format_string(texts.UNSTABLE_ORGS, F.col("orgs"), F.lit(str(org_count))).alias("reason"),
        "unstable_orgs",
    )


def filter_psi(
    df: DataFrame,
    threshold: float = config.PSI_THRESHOLD,
    max_ratio: float = config.MAX_MONTHS_RATIO,
    max_orgs: int = config.MAX_UNSTABLE_ORGS,
    min_sample: int = config.PSI_MIN_SAMPLE,
    period_col: str = MONTH,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Narrowed sample, PSI detail, drop list and PSI bands. Text features pass."""
    features = varying_numeric_features(df)
    detail = checkpointed(psi_by_org(df, features, min_sample, period_col))
    org_count = df.select(ORG).distinct().count()
    drops = checkpointed(psi_drops(detail, threshold, max_ratio, max_orgs, org_count))
    return as_stored(df.drop(*[r.feature for r in drops.collect()]), df), detail, drops, psi_bands(detail)


def psi_categorical(base: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, psi) of text features from the share of each value instead of bins."""
    names = list(features)

    def counts(df: DataFrame, name: str) -> DataFrame:
        long = df.select(*[F.col(f).cast("string").alias(f) for f in names]).unpivot([], names, "feature", "value")
        return long.filter("value IS NOT NULL").groupBy("feature", "value").agg(F.count("*").alias(name))

    both = counts(base, "base").unionByName(counts(current, "current"), allowMissingColumns=True)
    merged = both.groupBy("feature", "value").agg(
        F.coalesce(F.sum("base"), F.lit(0)).alias("base"), F.coalesce(F.sum("current"), F.lit(0)).alias("current")
    )
    # Sizes come from a second small aggregation: a window per feature would put
    # all values of a feature in one task.
    sizes = merged.groupBy("feature").agg(F.sum("base").alias("base_n"), F.sum("current").alias("current_n"))
    shares = merged.join(F.broadcast(sizes), "feature").select(
        "feature",
        floored(F.col("base") / F.col("base_n")).alias("b"),
        floored(F.col("current") / F.col("current_n")).alias("a"),
        ((F.col("base_n") == 0) | (F.col("current_n") == 0)).alias("empty"),
    )
    part = (F.col("a") - F.col("b")) * F.ln(F.col("a") / F.col("b"))
    index = F.when(F.max("empty"), F.lit(0.0)).otherwise(F.bround(F.sum(part), 4))
    return shares.groupBy("feature").agg(index.alias("psi"))
