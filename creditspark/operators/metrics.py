"""Ranking metrics of a scored sample, exact under tied scores.

All metrics come from one table of distinct scores with running class counts, so
the sample is scanned once, whole or per segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..plans.longform import ORG, TARGET
from ..plans.ordered import bucket_count, rank_quantiles, running_totals, value_cells
from ..plans.storage import written


def score_table(
    df: DataFrame, score: str = "p", target: str = TARGET, keys: Sequence[str] = ()
) -> DataFrame:
    """(keys..., value, n, pos) per distinct score with running and total counts."""
    valid = df.filter(F.col(target).isNotNull()).select(*keys, target, score)
    sums = {"n": F.count("*"), "pos": F.sum(F.col(target).cast("long"))}
    # The rows are evaluated once; what decides about buckets are the distinct scores.
    cells = written(value_cells(valid, [score], list(keys), sums, rows=0)[0])
    bucketed = bucket_count(df.sparkSession, cells.count()) > 1
    running = running_totals(cells, [*keys, "feature"], ["value"], ["n", "pos"], bucketed)
    return running.drop("feature")


def _ranking(table: DataFrame) -> dict[str, Column]:
    """Aggregates over a score table; null when one class is absent."""
    number = {c: F.col(c).cast("double") for c in ("n", "pos", "n_upto", "pos_upto", "n_all", "pos_all")}
    neg, neg_all = number["n"] - number["pos"], number["n_all"] - number["pos_all"]
    neg_below = number["n_upto"] - number["pos_upto"] - neg
    pos_below = number["pos_upto"] - number["pos"]
    # Counts at the threshold "score >= value".
    hits, false_hits = number["pos_all"] - pos_below, neg_all - neg_below
    tpr, fpr = F.try_divide(hits, number["pos_all"]), F.try_divide(false_hits, neg_all)
    both = F.max("pos_all").between(1, F.max("n_all") - 1)
    pairs = F.max(number["pos_all"]) * F.max(neg_all)
    return {
        "auc": F.try_divide(F.sum(number["pos"] * (neg_below + neg / 2)), pairs),
        "ks": F.when(both, F.greatest(F.max(tpr - fpr), F.lit(0.0))),
        "pr_auc": F.when(
            F.max("pos_all") > 0, F.sum(F.try_divide(number["pos"], number["pos_all"]) * hits / (hits + false_hits))
        ),
    }


def ranking_metrics(df: DataFrame, score: str = "p", target: str = TARGET, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., rows, bad_rate, auc, ks, gini, pr_auc), unrounded."""
    table = score_table(df, score, target, keys)
    return table_metrics(table, keys)


def table_metrics(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    rank = _ranking(table)
    found = table.groupBy(*keys).agg(
        F.max("n_all").alias("rows"),
        (F.max("pos_all") / F.max("n_all")).alias("bad_rate"),
        *[expr.alias(name) for name, expr in rank.items()],
    )
    return found.select(*keys, "rows", "bad_rate", "auc", "ks", (2 * F.col("auc") - 1).alias("gini"), "pr_auc")


def auc(df: DataFrame, score: str = "p", target: str = TARGET) -> float | None:
    return ranking_metrics(df, score, target).first().auc


def table_lift(table: DataFrame, bins: int = 10) -> DataFrame:
    """Lift per quantile bin of a score table without keys; decile 1 has the highest scores.

    Bins are right-closed between distinct quantiles, so ties may leave fewer bins
    and then the numbering starts above 1. Empty without bads or with too few rows.
    """
    keyed = table.withColumn("_all", F.lit(1))
    edges = rank_quantiles(keyed, ["_all"], [i / bins for i in range(bins + 1)])
    usable = edges.filter(F.col("n_all") >= bins).select("_all", F.array_distinct("edges").alias("edges"))
    inner = F.slice(F.col("edges"), 2, bins)
    code = F.size(F.filter(inner, lambda edge: edge < F.col("value")))
    # ``usable`` is one row by construction.
    counted = keyed.join(F.broadcast(usable), "_all").groupBy((F.lit(bins) - code).alias("decile")).agg(
        F.sum("n").alias("count"),
        F.sum("pos").alias("bad_count"),
        F.max(F.col("pos_all") / F.col("n_all")).alias("overall"),
    )
    rate = F.col("bad_count") / F.col("count")
    return counted.filter("overall > 0").select(
        "decile", "count", "bad_count",
        F.bround(rate, 4).alias("bad_rate"), F.bround(rate / F.col("overall"), 2).alias("lift"),
    )


def lift_table(df: DataFrame, score: str = "p", target: str = TARGET, bins: int = 10) -> DataFrame:
    return table_lift(written(score_table(df, score, target)), bins).orderBy("decile")


def confusion(df: DataFrame, score: str = "p", target: str = TARGET, threshold: float = 0.5) -> DataFrame:
    """(tp, fp, fn, tn, precision, recall, f1) at ``score >= threshold``; 0 where undefined."""
    hit, bad = F.col(score) >= threshold, F.col(target) == 1
    counts = df.filter(F.col(score).isNotNull() & F.col(target).isNotNull()).agg(
        F.count_if(hit & bad).alias("tp"),
        F.count_if(hit & ~bad).alias("fp"),
        F.count_if(~hit & bad).alias("fn"),
        F.count_if(~hit & ~bad).alias("tn"),
    )
    return with_rates(counts)


def with_rates(counts: DataFrame) -> DataFrame:
    def share(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    rated = counts.withColumn("precision", share(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn(
        "recall", share(F.col("tp"), F.col("tp") + F.col("fn"))
    )
    both = F.col("precision") + F.col("recall")
    return rated.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), both))


def evaluate(
    df: DataFrame, model_name: str = "model", score: str = "p", target: str = TARGET, threshold: float = 0.5
) -> tuple[DataFrame, DataFrame]:
    """One-row evaluation record and the lift table, both from one stored score table."""
    table = written(score_table(df, score, target))
    lift = table_lift(table)
    hit, pos, neg = F.col("value") >= threshold, F.col("pos"), F.col("n") - F.col("pos")
    counts = table.agg(
        F.coalesce(F.sum(F.when(hit, pos)), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, neg)), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~hit, pos)), F.lit(0)).alias("fn"),
        F.coalesce(F.sum(F.when(~hit, neg)), F.lit(0)).alias("tn"),
    )
    # Three one-row frames side by side.
    one = F.lit(1).alias("_one")
    top = lift.agg(F.min_by("lift", "decile").alias("top10_lift")).select(one, "*")
    ranks = table_metrics(table).select(one, "*")
    rates = with_rates(counts).select(one, "*")
    record = ranks.join(top, "_one").join(rates, "_one").select(
        F.lit(model_name).alias("model_name"),
        *[F.bround(c, 4).alias(c) for c in ("auc", "ks", "gini", "pr_auc")],
        F.coalesce("top10_lift", F.lit(0.0)).alias("top10_lift"),
        *[F.bround(c, 4).alias(c) for c in ("precision", "recall", "f1")],
        F.lit(float(threshold)).alias("threshold"),
        F.col("rows").alias("n_samples"),
        F.bround("bad_rate", 4).alias("bad_rate"),
    )
    return record, lift.orderBy("decile")


def pass_flags(
    record: DataFrame,
    auc: float = config.AUC_PASS,
    ks: float = config.KS_PASS,
    gini: float = config.GINI_PASS,
    lift: float = config.TOP_LIFT_PASS,
) -> DataFrame:
    """Record with one boolean per pass line."""
    return record.withColumns(
        {
            "auc_pass": F.col("auc") >= auc,
            "ks_pass": F.col("ks") >= ks,
            "gini_pass": F.col("gini") >= gini,
            "lift_pass": F.col("top10_lift") >= lift,
        }
    )


def segment_stability(
    df: DataFrame,
    segment_col: str = ORG,
    score: str = "p",
    target: str = TARGET,
    min_rows: int = config.SEGMENT_MIN_ROWS,
) -> DataFrame:
    """(segment, n_samples, bad_rate, auc, ks) for all segments in one job; small
    and one-class segments are left out."""
    found = ranking_metrics(df, score, target, [segment_col])
    return found.filter((F.col("rows") >= min_rows) & F.col("ks").isNotNull()).select(
        F.col(segment_col).alias("segment"),
        F.col("rows").alias("n_samples"),
        *[F.bround(c, 4).alias(c) for c in ("bad_rate", "auc", "ks")],
    )
