"""Drift monitoring against a stored baseline."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import texts
from ..functions.scalars import is_missing, severity
from ..plans.longform import TARGET, named
from ..plans.ordered import exact_quantiles, plain_names
from ..plans.storage import checkpointed, written
from .metrics import ranking_metrics
from .psi import bin_counts_by_search, psi_of, psi_two_samples

# Fixed value: the reported percentiles.
PERCENTILES = (1, 5, 25, 50, 75, 95, 99)
# Items of a quantile sketch at its widest level.
SKETCH_SIZE = 2048
_STATE = "struct<n: bigint, mean: double, min: double, max: double, std: double, sketch: binary>"


def _numeric(df: DataFrame, features: Sequence[str]) -> list[str]:
    return [f for f in features if isinstance(df.schema[f].dataType, T.NumericType)]


def missing_rates(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, rows, missing_rate) of null values, in one wide aggregation."""
    row = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(is_missing(f, df.schema[f].dataType, ())).alias(f) for f in features],
    )
    long = row.unpivot(["rows"], list(features), "feature", "missing")
    return long.select("feature", "rows", F.try_divide("missing", "rows").alias("missing_rate"))


def _state(value: Column) -> Column:
    """Moments and a quantile sketch of one feature; such states of parts of a table add up."""
    n = F.count(value)
    return F.struct(
        n.alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.stddev_samp(value).alias("std"), F.when(n > 0, F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE))).alias("sketch"),
    )


def baseline(
    df: DataFrame, features: Sequence[str], target: str = TARGET, bins: int = config.PSI_BINS
) -> DataFrame:
    """One row per feature with everything monitoring needs later.

    Numeric features: mean, sample std, min, max, median, exact percentiles as a map,
    and the bin edges and counts for the stability index. Text features: missing rate. ``n`` and ``sketch``
    let later rows be added by ``merged_baselines``. The few columns are stored once, as three passes read them.
    """
    spark = df.sparkSession
    numeric = _numeric(df, features)
    kept = list(dict.fromkeys([*features, target]))
    df = written(df.select(*map(named, kept)))
    wide, names = plain_names(df, numeric, [c for c in kept if c not in numeric])
    wide = wide if target not in numeric else wide.withColumn(target, F.col(names[target]))
    missing = {f: F.count_if(F.col(names[f]).isNull()) if f in names else F.count_if(is_missing(f, df.schema[f].dataType, ())) for f in features}
    row = wide.agg(
        F.count("*").alias("rows"), F.avg(named(target)).alias("bad_rate"),
        F.array(*[
            F.struct(F.lit(f).alias("feature"), F.lit(f in names).alias("numeric"), missing[f].alias("missing"),
                     (_state(F.col(names[f])) if f in names else F.lit(None).cast(_STATE)).alias("state"))
            for f in features
        ]).alias("each"),
    )
    head = checkpointed(row.select("rows", "bad_rate", F.explode("each").alias("x")).select("rows", "bad_rate", "x.feature", "x.numeric", "x.missing", "x.state.*"))
    if numeric:
        probs = [p / 100 for p in PERCENTILES] + [i / bins for i in range(1, bins)]
        edges = exact_quantiles(df, numeric, [], probs).select("feature", *_ranks(F.col("edges"), bins))
        body = edges.join(bin_counts_by_search(df, edges.select("feature", "edges"), [], bins), "feature")
    else:
        body = spark.createDataFrame(
            [], "feature string, median double, percentiles map<string,double>, edges array<double>, counts array<bigint>"
        )
    return head.join(body, "feature", "left").select(
        "feature", "numeric", F.col("rows").alias("n_samples"), F.col("bad_rate").cast("double").alias("bad_rate"),
        "mean", "std", "min", "max", "median", F.try_divide("missing", "rows").alias("missing_rate"), "percentiles", "edges", "counts",
        "n", "sketch",
    )


def _ranks(found: Column, bins: int) -> list[Column]:
    """Median, percentiles and edges out of the array of all quantiles of a baseline."""
    names = F.array(*[F.lit(f"p{p}") for p in PERCENTILES])
    return [
        F.element_at(found, PERCENTILES.index(50) + 1).alias("median"),
        F.map_from_arrays(names, F.slice(found, 1, len(PERCENTILES))).alias("percentiles"),
        F.slice(found, len(PERCENTILES) + 1, bins - 1).alias("edges"),
    ]


def merged_baselines(tables: Sequence[DataFrame], bins: int = config.PSI_BINS) -> DataFrame:
    """The baseline of all rows behind several baselines, such as a stored one and that of a new month, without those rows.

    Counts, rates and moments are exact. Median, percentiles, edges and bin counts come from the merged sketches,
    whose ranks are off by a few thousandths of the rows at most.
    """
    every = reduce(DataFrame.unionByName, [t.drop("created_at") for t in tables])
    n, m2 = F.col("n"), F.pow("std", 2) * (F.col("n") - 1)
    summed = every.groupBy("feature").agg(
        F.bool_or("numeric").alias("numeric"), F.sum("n_samples").alias("n_samples"),
        F.try_divide(F.sum(F.col("bad_rate") * F.col("n_samples")), F.sum("n_samples")).alias("bad_rate"),
        F.try_divide(F.sum(F.col("missing_rate") * F.col("n_samples")), F.sum("n_samples")).alias("missing_rate"),
        F.sum("n").alias("n"), F.try_divide(F.sum(n * F.col("mean")), F.sum("n")).alias("mean"),
        F.sum(F.coalesce(m2, F.lit(0.0))).alias("_within"), F.sum(n * F.pow("mean", 2)).alias("_squares"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    between = F.greatest(F.lit(0.0), F.col("_squares") - n * F.pow("mean", 2))
    std = F.when(n > 1, F.sqrt((F.col("_within") + between) / (n - 1)))
    probs = F.array(*[F.lit(q) for q in [p / 100 for p in PERCENTILES] + [i / bins for i in range(1, bins)]])
    held = checkpointed(summed.withColumn("std", std).withColumn("sketch", F.when((n > 0) & F.col("numeric"), F.col("sketch"))))
    found = held.where("sketch IS NOT NULL").withColumn("_q", F.kll_sketch_get_quantile_double("sketch", probs)).select("feature", "n", "sketch", *_ranks(F.col("_q"), bins))
    found = checkpointed(found)
    # Rows below each edge, by the sketch, which wants the edges as literals; bins reach from one edge to below the next.
    ranks = [
        F.when(F.col("feature") == r.feature, F.kll_sketch_get_rank_double("sketch", F.array(*[F.lit(math.nextafter(e, -math.inf)) for e in r.edges])))
        for r in found.select("feature", "edges").collect()
    ]
    below = F.transform(F.coalesce(F.array().cast("array<double>") if not ranks else ranks[0], *ranks[1:]), lambda share: F.round(share * n).cast("long"))
    upto = F.concat(F.array(F.lit(0).cast("long")), below, F.array(n))
    counts = F.zip_with(F.slice(upto, 1, bins), F.slice(upto, 2, bins), lambda low, high: high - low)
    body = found.select("feature", "median", "percentiles", "edges", counts.alias("counts"))
    return held.join(body, "feature", "left").select(
        "feature", "numeric", "n_samples", "bad_rate", "mean", "std", "min", "max", "median", "missing_rate", "percentiles", "edges", "counts",
        "n", "sketch",
    )


def save_baseline(table: DataFrame, path: str) -> None:
    table.withColumn("created_at", F.current_timestamp()).write.mode("overwrite").parquet(path)


def load_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def feature_drift(base: DataFrame, current: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """(feature, psi, base_missing, current_missing) for features on both sides."""
    known = {r.feature: r.numeric for r in base.select("feature", "numeric").collect()}
    chosen = [f for f in (features or list(known)) if f in known and f in current.columns]
    numeric = [f for f in _numeric(current, chosen) if known[f]]
    now = missing_rates(current, chosen).select("feature", F.col("missing_rate").alias("current_missing"))
    both = base.select("feature", F.col("missing_rate").alias("base_missing"), "edges", "counts").join(now, "feature")
    if not numeric:
        return both.select("feature", F.lit(0.0).alias("psi"), "base_missing", "current_missing")
    edges = base.filter(F.col("edges").isNotNull()).select("feature", "edges")
    bins = base.agg(F.max(F.size("counts"))).first()[0]
    chosen_edges = edges.where(F.col("feature").isin(numeric))
    counts = bin_counts_by_search(current, chosen_edges, [], bins).withColumnRenamed("counts", "current_counts")
    return both.join(counts, "feature", "left").select(
        "feature", psi_of(F.col("counts"), F.col("current_counts")).alias("psi"), "base_missing", "current_missing"
    )


def feature_alerts(drift: DataFrame, psi_threshold: float = config.MONITOR_PSI) -> DataFrame:
    """(feature, type, value, severity) of drifted features."""
    change = F.col("current_missing") - F.col("base_missing")
    arrow = F.format_string("%.4f→%.4f", "base_missing", "current_missing")
    checks = F.array(
        F.when(
            F.col("psi") > psi_threshold,
            F.struct(
                F.lit(texts.PSI_ALERT).alias("type"),
                F.format_string("PSI=%.4f", "psi").alias("value"),
                severity(F.col("psi"), config.MONITOR_PSI_HIGH).alias("severity"),
            ),
        ),
        F.when(
            F.abs(change) > config.MONITOR_MISSING_CHANGE,
            F.struct(
                F.lit(texts.MISSING_ALERT).alias("type"), arrow.alias("value"), F.lit("MEDIUM").alias("severity")
            ),
        ),
    )
    return drift.select("feature", F.inline(F.array_compact(checks)))


def monitor_features(
    base: DataFrame, current: DataFrame, features: Sequence[str] | None = None, psi_threshold: float = config.MONITOR_PSI
) -> DataFrame:
    """Alerts of a current sample against a baseline table."""
    return feature_alerts(feature_drift(base, current, features), psi_threshold)


def model_drift(base: DataFrame, current: DataFrame, score: str = "p", target: str = TARGET) -> DataFrame:
    """One row: score stability index, AUC, KS and bad rate of both scored samples (unrounded)."""
    index = psi_two_samples(base.select(score), current.select(score), [score])
    sides = base.select(F.lit("base").alias("side"), target, score).unionByName(
        current.select(F.lit("current").alias("side"), target, score)
    )
    wide = ranking_metrics(sides, score, target, ["side"]).groupBy().agg(
        *[
            F.max(F.when(F.col("side") == side, F.col(m))).alias(f"{name}_{m}")
            for side, name in (("base", "baseline"), ("current", "current"))
            for m in ("auc", "ks", "bad_rate")
        ]
    )
    one = F.lit(1).alias("_one")
    return wide.select(one, "*").join(index.select(one, F.col("psi").alias("score_psi")), "_one").select(
        "score_psi", "baseline_auc", "current_auc", (F.col("baseline_auc") - F.col("current_auc")).alias("auc_drop"),
        "baseline_ks", "current_ks", "baseline_bad_rate", "current_bad_rate",
    )


def model_alerts(drift: DataFrame, psi_threshold: float = config.MONITOR_PSI) -> DataFrame:
    """(type, value, severity) of a degraded model."""
    drop, change = F.col("auc_drop"), F.col("current_bad_rate") - F.col("baseline_bad_rate")
    checks = F.array(
        F.when(
            F.col("score_psi") > psi_threshold,
            F.struct(
                F.lit(texts.SCORE_ALERT).alias("type"),
                F.format_string("PSI=%.4f", "score_psi").alias("value"),
                severity(F.col("score_psi"), config.MONITOR_PSI_HIGH).alias("severity"),
            ),
        ),
        F.when(
            drop > config.MONITOR_AUC_DROP,
            F.struct(
                F.lit(texts.AUC_ALERT).alias("type"),
                F.format_string("%.4f→%.4f (drop=%.4f)", "baseline_auc", "current_auc", "auc_drop").alias("value"),
                severity(drop, config.MONITOR_AUC_DROP_HIGH).alias("severity"),
            ),
        ),
        F.when(
            F.abs(change) > config.MONITOR_BAD_RATE_CHANGE,
            F.struct(
                F.lit(texts.BAD_RATE_ALERT).alias("type"),
                F.format_string("%.4f→%.4f", "baseline_bad_rate", "current_bad_rate").alias("value"),
                F.lit("MEDIUM").alias("severity"),
            ),
        ),
    )
    return drift.select(F.inline(F.array_compact(checks)))


def monitor_model(
    base: DataFrame, current: DataFrame, score: str = "p", target: str = TARGET
) -> tuple[DataFrame, DataFrame]:
    """Rounded comparison record and alerts of two scored samples."""
    drift = checkpointed(model_drift(base, current, score, target))
    return drift.select(*[F.bround(c, 4).alias(c) for c in drift.columns]), model_alerts(drift)


def alert_summary(features: DataFrame, model: DataFrame) -> DataFrame:
    """One row: total and high feature alerts, and model alerts."""
    both = features.select(F.lit("feature").alias("kind"), "severity").unionByName(
        model.select(F.lit("model").alias("kind"), "severity")
    )
    is_feature = F.col("kind") == "feature"
    return both.agg(
        F.count_if(is_feature).alias("total_feature_alerts"),
        F.count_if(is_feature & (F.col("severity") == "HIGH")).alias("high_severity"),
        F.count_if(~is_feature).alias("model_alerts"),
    )
