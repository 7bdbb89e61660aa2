"""Weight-of-evidence bins: fit for all features at once, and transform."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..plans.longform import OVERALL, TARGET
from ..plans.ordered import row_numbers, value_cells
from ..plans.storage import checkpointed, join_checked
from .binning import bin_ranges, leaf_stats, tree_leaves, with_running_counts


def _text_columns(df: DataFrame, features: Sequence[str]) -> list[str]:
    return [f for f in features if isinstance(df.schema[f].dataType, T.StringType)]


def category_codes(df: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    """(feature, text, code, n, bad): alphabetical 0-based codes of the seen categories."""
    long = df.select(target, *features).unpivot([target], list(features), "feature", "text")
    seen = long.filter("text IS NOT NULL").groupBy("feature", "text").agg(
        F.count("*").alias("n"), F.sum(target).alias("bad")
    )
    return row_numbers(seen, ["feature"], ["text"], "place").select(
        "feature", "text", (F.col("place") - 1).alias("code"), "n", "bad"
    )


@dataclass
class WoeBins:
    """Fitted bins as tables: ``bins`` (feature, bin, low, high, n, bad, bad_rate, woe,
    iv_part) and ``categories`` (feature, text, code) for text features."""

    features: list[str]
    bins: DataFrame
    categories: DataFrame

    def iv(self) -> DataFrame:
        """(feature, iv) with 0 for features that could not be binned."""
        names = self.bins.sparkSession.range(1).select(
            F.explode(F.array(*[F.lit(f) for f in self.features])).alias("feature")
        )
        found = self.bins.groupBy("feature").agg(F.bround(F.sum("iv_part"), 4).alias("iv"))
        return names.join(found, "feature", "left").select("feature", F.coalesce("iv", F.lit(0.0)).alias("iv"))

    def save(self, folder: str) -> None:
        self.bins.write.mode("overwrite").parquet(f"{folder}/bins")
        self.categories.write.mode("overwrite").parquet(f"{folder}/categories")
        names = self.bins.sparkSession.range(1).select(F.array(*[F.lit(f) for f in self.features]).alias("features"))
        names.write.mode("overwrite").json(f"{folder}/features")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> WoeBins:
        names = spark.read.schema("features array<string>").json(f"{folder}/features").first().features
        return cls(list(names), spark.read.parquet(f"{folder}/bins"), spark.read.parquet(f"{folder}/categories"))


def fit_woe(
    df: DataFrame,
    features: Sequence[str],
    target: str = TARGET,
    n_bins: int = config.WOE_BINS,
    min_share: float = config.WOE_MIN_BIN_SHARE,
) -> WoeBins:
    """Tree bins of every feature. Text features are binned over alphabetical codes;
    nulls are left out; features with too few values or one class get no bin."""
    text = _text_columns(df, features)
    numeric = [f for f in features if f not in text]
    spark = df.sparkSession
    categories = spark.createDataFrame([], "feature string, text string, code bigint, n bigint, bad bigint")
    cells, bucketed = None, False
    if numeric:
        sums = {"n": F.count("*"), "bad": F.sum(target)}
        cells, bucketed = value_cells(df.select(target, *numeric), numeric, [], sums)
    if text:
        categories = checkpointed(category_codes(df, text, target))
        coded = categories.select("feature", F.col("code").cast("double").alias("value"), "n", "bad")
        cells = coded if cells is None else cells.unionByName(coded)
    stored = with_running_counts(cells.withColumn("scope", F.lit(OVERALL)), bucketed)
    bins = bin_ranges(stored, leaf_stats(tree_leaves(stored, n_bins, min_share)))
    return WoeBins(list(features), checkpointed(bins.drop("scope")), categories.select("feature", "text", "code"))


def woe_case(column: Column, bins: Sequence, gaps: str = "zero") -> Column:
    """CASE expression over at most a few dozen bins, inside whole-stage codegen.

    ``gaps="zero"``: a value outside every closed bin gives 0. ``gaps="extend"``:
    bins meet half-way between their seen values and the end bins are open.
    """
    bins = sorted(bins, key=lambda b: b.low)
    result = F.when(column.isNull() | F.isnan(column), F.lit(0.0))
    for i, b in enumerate(bins):
        if gaps == "zero":
            inside = column.between(b.low, b.high)
        else:
            inside = F.lit(True) if i == len(bins) - 1 else column < (b.high + bins[i + 1].low) / 2
        result = result.when(inside, F.lit(float(b.woe)))
    return result.otherwise(F.lit(0.0))


def woe_transform(df: DataFrame, fitted: WoeBins, features: Sequence[str] | None = None, gaps: str = "zero") -> DataFrame:
    """Add ``<feature>_woe``. Null, unknown category and unbinned feature give 0.

    Numeric features need no join. A category list is joined by its text, broadcast
    only when counted small.
    """
    if gaps not in ("zero", "extend"):
        raise ValueError("gaps must be 'zero' or 'extend'")
    chosen = list(features) if features is not None else fitted.features
    by_feature: dict[str, list] = {}
    for row in fitted.bins.select("feature", "low", "high", "woe").collect():
        by_feature.setdefault(row.feature, []).append(row)
    text = _text_columns(df, chosen)
    added = {
        f"{f}_woe": woe_case(F.col(f).cast("double"), by_feature[f], gaps) if f in by_feature else F.lit(0.0)
        for f in chosen
        if f not in text
    }
    out = df.withColumns(added) if added else df
    for f in text:
        if f not in by_feature:
            out = out.withColumn(f"{f}_woe", F.lit(0.0))
            continue
        known = fitted.categories.filter(F.col("feature") == f).select(
            F.col("text").alias("_text"),
            woe_case(F.col("code").cast("double"), by_feature[f]).alias("_woe"),
        )
        joined = join_checked(out, known, out[f] == known["_text"], "left")
        out = joined.withColumn(f"{f}_woe", F.coalesce("_woe", F.lit(0.0))).drop("_text", "_woe")
    return out
