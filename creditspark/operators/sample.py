"""Sample statistics per organisation and month, and sample checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import texts
from ..plans.longform import MONTH, ORG, TARGET, features_of
from ..plans.storage import as_stored, checkpointed, join_checked


def month_counts(df: DataFrame) -> DataFrame:
    """(org, month, bads, rows, bad_rate): one map-side combined aggregation."""
    return df.groupBy(F.col(ORG).alias("org"), F.col(MONTH).alias("month")).agg(
        F.sum(TARGET).alias("bads"),
        F.count(TARGET).alias("rows"),
        F.avg(TARGET).alias("bad_rate"),
    )


def org_month_stats(df: DataFrame, oos_orgs: Sequence[str] = ()) -> DataFrame:
    """Monthly and total counts and bad rates per organisation, sorted by tag, org, month."""
    whole = Window.partitionBy("org")
    stats = month_counts(df).withColumns(
        {"org_bads": F.sum("bads").over(whole), "org_rows": F.sum("rows").over(whole)}
    )
    return (
        stats.withColumn("org_bad_rate", F.col("org_bads") / F.col("org_rows"))
        .withColumn("sample_type", texts.sample_tag("org", oos_orgs))
        .orderBy("sample_type", "org", "month")
    )


def org_summary(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col(ORG).alias("org")).agg(
        F.count(TARGET).alias("rows"), F.avg(TARGET).alias("bad_rate")
    )


def abnormal_months(
    df: DataFrame, min_bad: int = config.MIN_MONTH_BAD, min_rows: int = config.MIN_MONTH_ROWS
) -> DataFrame:
    """Months with too few bads or rows, with the reason (bads are named first)."""
    few_bads = F.col("bads") < min_bad
    reason = F.when(
        few_bads, F.format_string(texts.LOW_BADS, F.col("bads"), F.lit(str(min_bad)))
    ).otherwise(F.format_string(texts.LOW_ROWS, F.col("rows"), F.lit(str(min_rows))))
    return month_counts(df).filter(few_bads | (F.col("rows") < min_rows)).withColumn("reason", reason)


def drop_months(df: DataFrame, months: DataFrame) -> DataFrame:
    """Rows outside the listed (org, month) pairs."""
    keys = months.select(F.col("org").alias(ORG), F.col("month").alias(MONTH))
    return as_stored(join_checked(df, keys, [ORG, MONTH], "left_anti"), df)


def filter_abnormal_months(
    df: DataFrame, min_bad: int = config.MIN_MONTH_BAD, min_rows: int = config.MIN_MONTH_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Sample without its abnormal months, and the list of them."""
    months = checkpointed(abnormal_months(df, min_bad, min_rows))
    return drop_months(df, months), months


def sample_gates(df: DataFrame) -> DataFrame:
    """Sanity checks of size, bad rate and feature count as (gate, value, ok)."""
    totals = df.agg(F.count("*").alias("n"), F.sum(TARGET).alias("bads"), F.avg(TARGET).alias("rate"))
    low, high = config.GATE_BAD_RATE
    few, many = config.GATE_FEATURES
    n_features = F.lit(len(features_of(df))).cast("double")
    gates = [
        ("bad_rate", F.col("rate"), F.col("rate").between(low, high)),
        ("rows", F.col("n").cast("double"), F.col("n") >= config.GATE_MIN_ROWS),
        ("bads", F.col("bads").cast("double"), F.col("bads") >= config.GATE_MIN_BADS),
        ("features", n_features, n_features.between(few, many)),
    ]
    rows = [F.struct(F.lit(g).alias("gate"), v.alias("value"), ok.alias("ok")) for g, v, ok in gates]
    return totals.select(F.inline(F.array(*rows)))


def month_gaps(df: DataFrame) -> DataFrame:
    """Holes in the month series of each organisation: (org, after, before, missing_months)."""
    months = df.select(F.col(ORG).alias("org"), F.col(MONTH).alias("month")).distinct()
    index = F.substring("month", 1, 4).cast("int") * 12 + F.substring("month", 5, 2).cast("int")
    by_org = Window.partitionBy("org").orderBy("month")
    steps = months.withColumn("index", index).select(
        "org",
        F.lag("month").over(by_org).alias("after"),
        F.col("month").alias("before"),
        (F.col("index") - F.lag("index").over(by_org) - 1).alias("missing_months"),
    )
    return steps.filter("missing_months > 0")


def org_outliers(df: DataFrame, factor: float = 2.0) -> DataFrame:
    """Organisations whose bad rate is ``factor`` times above or below the overall rate."""
    orgs = df.groupBy(F.col(ORG).alias("org")).agg(
        F.sum(TARGET).alias("bads"), F.count(TARGET).alias("rows")
    )
    # A window over the per-organisation totals: one row per organisation.
    everything = Window.partitionBy()
    rates = orgs.select(
        "org",
        "rows",
        (F.col("bads") / F.col("rows")).alias("bad_rate"),
        (F.sum("bads").over(everything) / F.sum("rows").over(everything)).alias("overall_rate"),
    )
    return rates.withColumn(
        "outlier",
        (F.col("bad_rate") > F.col("overall_rate") * factor)
        | (F.col("bad_rate") < F.col("overall_rate") / factor),
    )
