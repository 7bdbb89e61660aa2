"""Gradient-boosted trees: training, cross-validation, search and null importance."""

from __future__ import annotations

import json
import random
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import texts
from ..plans.longform import TARGET, clean_double, named, varying_numeric_features
from ..plans.storage import written
from .boosting import Model, Settings, Tree, bins_of, grow, raw_scores
from .encode import stored_codes, with_codes
from .metrics import ranking_metrics
from .parzen import Space, propose
from .split import forward_folds, stratified_folds

# The two published parameter presets. ``minHessian`` is the smallest weight of a leaf.
PRESETS = {
    "lgb": dict(maxIter=100, stepSize=0.03, maxDepth=4, maxLeaves=10, minInstancesPerNode=50, subsamplingRate=0.7,
                featureSubsetStrategy="0.7", l1=5.0, l2=5.0, minGain=0.1, minHessian=1e-3, bad_weight=1.0),
    "xgb": dict(maxIter=200, stepSize=0.1, maxDepth=6, maxLeaves=None, minInstancesPerNode=1, subsamplingRate=0.8,
                featureSubsetStrategy="0.8", l1=0.0, l2=1.0, minGain=0.0, minHessian=1.0, bad_weight=5.0),
}
# Fixed value: rounds without a lower validation loss after which training stops.
PATIENCE = 50
# Value bins of a feature, besides the one for missing values.
BINS = 63


@dataclass
class Inputs:
    """How features become bins: limits between the bins, learned from a table, and codes of texts.

    Text becomes its alphabetical code (null is the text ``nan``, unseen text is -1)
    and is used as an ordered number. Bin 0 is for missing numbers.
    """

    features: list[str]
    limits: dict[str, list[float]]
    codes: DataFrame | None

    @property
    def texts(self) -> list[str]:
        return [r.feature for r in self.codes.select("feature").distinct().collect()] if self.codes is not None else []

    def coded(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Features as doubles, null where missing, and the columns ``keep`` under ``_keep_`` names."""
        kept = df.select(*map(named, self.features), *[named(c).alias(f"_keep_{c}") for c in keep])
        if self.codes is not None:
            kept = with_codes(kept, self.codes, self.texts)
        return kept.select(*[clean_double(f).alias(f) for f in self.features], *[named(f"_keep_{c}") for c in keep])

    def binned(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The columns ``keep`` and ``bins``, an array of one number per feature."""
        wide = self.coded(df, keep)
        wide = wide.select(*[F.coalesce(named(f), F.lit(float("nan"))).alias(f"_v{i}") for i, f in enumerate(self.features)], *[named(f"_keep_{c}").alias(c) for c in keep])
        cut = [i for i, f in enumerate(self.features) if self.limits[f]]
        if cut:
            wide = Bucketizer(
                splitsArray=[[-float("inf"), *self.limits[self.features[i]], float("inf")] for i in cut],
                inputCols=[f"_v{i}" for i in cut], outputCols=[f"_b{i}" for i in cut], handleInvalid="keep",
            ).transform(wide)
        bins = [F.when(F.isnan(f"_v{i}"), 0).otherwise(F.col(f"_b{i}") + 1 if i in cut else F.lit(1)).cast("short") for i in range(len(self.features))]
        return wide.select(*map(named, keep), F.array(*bins).alias("bins"))


def fit_inputs(df: DataFrame, features: Sequence[str], bins: int = BINS, limits: dict[str, Sequence[float]] | None = None) -> Inputs:
    """Learn codes of texts and, where ``limits`` doesn't name them, limits between about equally full bins."""
    text = [f for f in features if isinstance(df.schema[f].dataType, T.StringType)]
    inputs = Inputs(list(features), {f: sorted(set(map(float, x))) for f, x in (limits or {}).items()}, stored_codes(df, text))
    open_ = [f for f in features if f not in inputs.limits]
    if open_:
        found = inputs.coded(df).select(*map(named, open_)).toDF(*[f"c{i}" for i in range(len(open_))])
        marks = found.approxQuantile(found.columns, [i / bins for i in range(bins + 1)], 1 / (4 * bins))
        # The lowest mark is the lowest value, which begins the first bin.
        inputs.limits.update({f: sorted(set(points))[1:] for f, points in zip(open_, marks)})
    return inputs


def _settings(params: dict, seed: int, patience: int | None = None) -> Settings:
    return Settings(
        rounds=int(params["maxIter"]), rate=params["stepSize"], depth=int(params["maxDepth"]), leaves=params["maxLeaves"],
        least_rows=int(params["minInstancesPerNode"]), least_hessian=params["minHessian"], row_share=params["subsamplingRate"],
        feature_share=float(params["featureSubsetStrategy"]), l1=params["l1"], l2=params["l2"], least_gain=params["minGain"],
        bad_weight=params["bad_weight"], patience=patience, seed=seed,
    )


def _bits(values: Sequence[Column]) -> Column:
    """Conditions as the bits of a number."""
    return reduce(Column.bitwiseOR, [F.when(v, F.lit(1 << k)).otherwise(0).cast("long") for k, v in enumerate(values)])


def growing_table(binned: DataFrame, trains: Sequence[Column], held: Sequence[Column], labels: Sequence[Column]) -> DataFrame:
    """Rows for ``grow``: per model, whether the row trains it, is held for its validation, and its label.
    Rows that have no ``row_id`` yet are numbered; the table is written once."""
    numbered = binned if "row_id" in binned.columns else binned.withColumn("row_id", F.monotonically_increasing_id())
    return written(numbered.select("row_id", "bins", _bits(trains).alias("trains"), _bits(held).alias("held"), _bits(labels).alias("label")))


@dataclass
class TreeModel:
    features: list[str]
    inputs: Inputs
    base: float
    trees: list[Tree]
    best_iteration: int

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``p``, the probability of bad."""
        return with_chances(self.inputs.binned(df, df.columns), [self], ["p"]).drop("bins")

    def importance(self) -> DataFrame:
        """(feature, importance): summed split gain, highest first."""
        return total_gain(self.trees, self.features).withColumnRenamed("gain", "importance").orderBy(
            F.desc("importance"), "feature"
        )

    def nodes(self) -> DataFrame:
        """(tree, node, feature, below, missing_left, left, right, value, gain, rows): a row per node; a node
        with a feature sends values under ``below`` to the left, or only missing ones to a side if it is null."""
        return SparkSession.getActiveSession().createDataFrame(
            [
                (k, i, self.features[t.feature[i]] if t.feature[i] >= 0 else None, _below(self, t, i), bool(t.missing_left[i]),
                 t.left[i], t.right[i], t.value[i], t.gain[i], t.rows[i])
                for k, t in enumerate(self.trees) for i in range(len(t.feature))
            ],
            "tree int, node int, feature string, below double, missing_left boolean, left int, right int, value double, gain double, rows long",
        )

    def save(self, folder: str) -> None:
        spark = SparkSession.getActiveSession()
        if self.inputs.codes is not None:
            self.inputs.codes.write.mode("overwrite").parquet(f"{folder}/codes")
        kept = dict(features=self.features, limits=self.inputs.limits, base=self.base, best_iteration=self.best_iteration,
                    coded=self.inputs.codes is not None, trees=[asdict(t) for t in self.trees])
        spark.createDataFrame([(json.dumps(kept),)], "model string").write.mode("overwrite").text(f"{folder}/model")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> TreeModel:
        kept = json.loads(spark.read.text(f"{folder}/model").first()[0])
        codes = spark.read.parquet(f"{folder}/codes") if kept["coded"] else None
        inputs = Inputs(kept["features"], kept["limits"], codes)
        return cls(kept["features"], inputs, kept["base"], [Tree(**t) for t in kept["trees"]], kept["best_iteration"])


def _below(model: TreeModel, tree: Tree, node: int) -> float | None:
    limits = model.inputs.limits[model.features[tree.feature[node]]] if tree.feature[node] >= 0 else []
    return limits[tree.limit[node] - 1] if 0 < tree.limit[node] <= len(limits) else None


def with_chances(binned: DataFrame, models: Sequence[TreeModel | Model], names: Sequence[str], of: Column | None = None) -> DataFrame:
    """Add the probability of bad by each model; with ``of`` (a column of model numbers from 0) only that model's, under one name."""
    @F.arrow_udf("double")
    def chance(bins: pa.Array, number: pa.Array) -> pa.Array:
        out = np.zeros(len(bins))
        if len(bins):
            x, k = bins_of(bins, len(bins[0])), number.to_numpy(zero_copy_only=False)
            for which in np.unique(k):
                base, trees = ensembles[which]
                raw = base + raw_scores(trees, x[:, k == which])
                out[k == which] = 1 / (1 + np.exp(-np.clip(raw, -700, 700)))
        return pa.array(out)

    ensembles = [(m.base, m.trees) for m in models]
    numbers = [of.cast("int")] if of is not None else [F.lit(k) for k in range(len(models))]
    for name, number in zip(names, numbers):
        binned = binned.withColumn(name, chance("bins", number))
    return binned


def _params(model_type: str, params: dict | None) -> dict:
    if model_type not in PRESETS:
        raise ValueError(f"model_type must be one of {', '.join(PRESETS)}")
    return {**PRESETS[model_type], **(params or {})}


def _is_one(column: Column) -> Column:
    return F.coalesce(column == 1, F.lit(False))


def train_tree(
    df: DataFrame,
    features: Sequence[str],
    validation: DataFrame | None = None,
    target: str = TARGET,
    model_type: str = "lgb",
    params: dict | None = None,
    limits: dict[str, Sequence[float]] | None = None,
    seed: int = config.RANDOM_SEED,
) -> TreeModel:
    """Boosted trees. With validation rows the ``lgb`` preset stops after 50 rounds without a lower
    validation loss and keeps the best round; ``xgb``, and any training without validation
    rows (such as the last one with the best parameters found), keep all rounds.
    ``limits`` replaces the learned limits between the bins of a feature."""
    settings = _params(model_type, params)
    stops = validation is not None and model_type == "lgb"
    inputs = fit_inputs(df, features, limits=limits)
    rows = inputs.binned(df, [target]).withColumn("_held", F.lit(False))
    if stops:
        rows = rows.unionByName(inputs.binned(validation, [target]).withColumn("_held", F.lit(True)))
    table = growing_table(rows, [~F.col("_held")], [F.col("_held")], [_is_one(named(target))])
    model = grow(table, [_settings(settings, seed, PATIENCE if stops else None)], len(features), _width(inputs))[0]
    return TreeModel(list(features), inputs, model.base, model.trees, len(model.trees))


def _width(inputs: Inputs) -> int:
    """Bins of the widest feature, with the one for missing values."""
    return 2 + max((len(x) for x in inputs.limits.values()), default=0)


def _gains(trees: Sequence[Tree], features: Sequence[str]) -> list[float]:
    """Summed split gain per feature, 0 for unused ones."""
    gains = [0.0] * len(features)
    for tree in trees:
        for f, gain in zip(tree.feature, tree.gain):
            if f >= 0:
                gains[f] += gain
    return gains


def total_gain(trees: Sequence[Tree], features: Sequence[str]) -> DataFrame:
    """(feature, gain) over all trees, 0 for unused features."""
    return SparkSession.getActiveSession().createDataFrame(list(zip(features, _gains(trees, features))), "feature string, gain double")


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    target: str = TARGET,
    model_type: str = "lgb",
    folds: int = config.CV_FOLDS,
    params: dict | None = None,
    mode: str = "stratified",
    tiebreak: Sequence[str] | None = None,
    seed: int = config.RANDOM_SEED,
) -> DataFrame:
    """(fold, train_size, val_size, val_auc, val_ks, val_gini) without early stopping.

    ``mode="stratified"``: contiguous blocks per class, later rows also train earlier
    folds. ``mode="forward"``: each fold trains on earlier blocks only. The models of all folds
    grow in the same scans of one table, in which a bit per fold says who trains on a row.
    Codes and limits between bins, which know no labels, are learned from the whole table.
    """
    if mode not in ("stratified", "forward"):
        raise ValueError("mode must be 'stratified' or 'forward'")
    settings = _params(model_type, params)
    assign = stratified_folds if mode == "stratified" else forward_folds
    placed = written(assign(df, folds, tiebreak).select(*map(named, [target, *features]), "fold"))
    inputs = fit_inputs(placed, features)
    binned = written(inputs.binned(placed, [target, "fold"]).withColumn("row_id", F.monotonically_increasing_id()))
    trains = [F.col("fold") != k if mode == "stratified" else F.col("fold") < k for k in range(1, folds + 1)]
    label = _is_one(named(target))
    table = growing_table(binned, trains, [F.lit(False)] * folds, [label] * folds)
    models = grow(table, [_settings(settings, seed)] * folds, len(features), _width(inputs))
    scored = with_chances(binned.where("fold > 0"), models, ["p"], F.col("fold") - 1).select("fold", named(target), "p")
    measured = ranking_metrics(written(scored), "p", target, ["fold"])
    sizes = placed.groupBy("fold").agg(F.count("*").alias("val_size"))
    if mode == "stratified":
        trained = F.sum("val_size").over(Window.partitionBy()) - F.col("val_size")
    else:
        trained = F.sum("val_size").over(Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.withColumn("train_size", trained).join(measured, "fold").select(
        "fold", "train_size", "val_size",
        F.bround("auc", 4).alias("val_auc"), F.bround("ks", 4).alias("val_ks"), F.bround("gini", 4).alias("val_gini"),
    ).orderBy("fold")


def cv_summary(folds: DataFrame) -> DataFrame:
    """(metric, mean, std) over the folds."""
    long = folds.unpivot([], ["val_auc", "val_ks", "val_gini"], "metric", "value")
    return long.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))


# The published search ranges.
SEARCH_RANGES = {
    "maxIter": (50, 500), "stepSize": (0.01, 0.3), "maxDepth": (3, 10), "subsamplingRate": (0.5, 1.0),
    "featureSubsetStrategy": (0.5, 1.0),
}
SEARCH_RANGES_OF = {
    "lgb": {"maxLeaves": (8, 64), "minInstancesPerNode": (20, 200), "l1": (0.01, 10.0), "l2": (0.01, 10.0)},
    "xgb": {"minHessian": (1, 10), "bad_weight": (1, 20)},
}
_WHOLE = ("maxIter", "maxDepth", "maxLeaves", "minInstancesPerNode", "minHessian")
_BY_LOGARITHM = ("stepSize", "l1", "l2")
# What a learner has where the search draws nothing: its library's own values, not the preset's.
SEARCH_DEFAULTS = {
    "lgb": dict(minGain=0.0, minHessian=1e-3, bad_weight=1.0),
    "xgb": dict(maxLeaves=None, minInstancesPerNode=1, l1=0.0, l2=1.0, minGain=0.0),
}


def search_space(model_type: str, ranges: dict | None = None) -> dict[str, Space]:
    """The published ranges, or those of ``ranges`` where it names a parameter."""
    chosen = {**SEARCH_RANGES, **SEARCH_RANGES_OF[model_type], **(ranges or {})}
    return {name: Space(low, high, whole=name in _WHOLE, logarithmic=name in _BY_LOGARITHM) for name, (low, high) in chosen.items()}


def search_params(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    target: str = TARGET,
    model_type: str = "lgb",
    trials: int = config.SEARCH_TRIALS,
    parallel: int = 4,
    ranges: dict | None = None,
    seed: int = config.RANDOM_SEED,
) -> tuple[dict, DataFrame]:
    """Best parameters by validation AUC, and all trials, of a tree-structured Parzen search.

    ``parallel`` trials at a time are proposed from the finished ones and grow in the same scans. ``ranges``
    replaces published ranges, for example ``{"maxIter": (5, 20)}`` on a small machine.
    """
    space = search_space(model_type, ranges)
    base = {**_params(model_type, None), **SEARCH_DEFAULTS[model_type]}
    inputs = fit_inputs(train, features)
    # The stored tables keep bins and labels; rows, limits and codes are the same for all trials.
    rows = inputs.binned(train, [target]).withColumn("_held", F.lit(False))
    rows = written(rows.withColumn("row_id", F.monotonically_increasing_id()))
    held = written(inputs.binned(validation, [target]))
    generator, finished, results = random.Random(seed), [], []
    while len(finished) < trials:
        count = min(parallel, trials - len(finished))
        drawn = propose(space, finished, count, generator)
        params = [{**base, **d} for d in drawn]
        table = growing_table(rows, [F.lit(True)] * count, [F.lit(False)] * count, [_is_one(named(target))] * count)
        models = grow(table, [_settings(p, seed) for p in params], len(features), _width(inputs))
        names = [f"p{k}" for k in range(count)]
        scored = with_chances(held, models, names).select(named(target), F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(n).alias("p")) for k, n in enumerate(names)])).alias("x"))
        values = {r.k: r.auc for r in ranking_metrics(written(scored.select(target, "x.k", "x.p")), "p", target, ["k"]).collect()}
        for k, (d, p) in enumerate(zip(drawn, params)):
            value = values.get(k)
            results.append((len(results), value, repr(sorted(p.items()))))
            finished.append((d, value if value is not None else 0.0, p))
    report = train.sparkSession.createDataFrame(results, "trial int, val_auc double, params string")
    best = max(range(len(finished)), key=lambda k: (finished[k][1], -k))
    return finished[best][2], report.orderBy(F.desc("val_auc"), "trial")


def shuffled_labels(stored: DataFrame, row_id: str, target: str, seed: int, runs: int = 1, name: str = "shuffled") -> DataFrame:
    """Add ``runs`` random permutations of a 0/1 label over rows with unique ids, as bits of one number.

    Permuting ones and zeros is the same as giving the ones to as many rows chosen at
    random: those with the smallest hash of their id. The border hashes of all runs are found
    together, by counting leading hash bits: 16 of them, 16 more at the border, then the few hashes left.
    """
    hashes = [F.xxhash64(named(row_id), F.lit(seed + k)) for k in range(runs)]
    need = int(stored.agg(F.sum(F.when(_is_one(named(target)), 1).otherwise(0))).first()[0] or 0)
    if need == 0:
        return stored.withColumn(name, F.lit(0).cast("long"))
    long = stored.select(F.posexplode(F.array(*hashes)).alias("run", "h"))
    missing, border = dict.fromkeys(range(runs), need), {}
    for shift in (48, 32):
        prefix = F.shiftright("h", shift)
        inside = long if shift == 48 else long.where(_at_border(border, F.shiftright("h", 48)))
        # 2**16 prefixes per run at most.
        counts = inside.groupBy("run", prefix.alias("prefix")).agg(F.count("*").alias("n")).toArrow().sort_by([("run", "ascending"), ("prefix", "ascending")])
        run, value, n = (counts.column(c).to_numpy() for c in ("run", "prefix", "n"))
        for k in range(runs):
            own = run == k
            upto = np.cumsum(n[own])
            at = int(np.searchsorted(upto, missing[k]))
            missing[k] -= int(upto[at] - n[own][at])
            border[k] = int(value[own][at])
    # About one row in four billion per run is left.
    left = long.where(_at_border(border, F.shiftright("h", 32))).toArrow()
    limits = [int(np.sort(left.column("h").to_numpy()[left.column("run").to_numpy() == k])[missing[k] - 1]) for k in range(runs)]
    return stored.withColumn(name, _bits([h <= limit for h, limit in zip(hashes, limits)]))


def _at_border(border: dict[int, int], prefix: Column) -> Column:
    return reduce(Column.__or__, [(F.col("run") == k) & (prefix == b) for k, b in border.items()])


def null_importance(
    df: DataFrame,
    features: Sequence[str],
    target: str = TARGET,
    trees: int = config.NULL_TREES,
    depth: int = config.NULL_DEPTH,
    runs: int = config.NULL_RUNS,
    seed: int = config.RANDOM_SEED,
) -> DataFrame:
    """(feature, gain, null_gain, gain_difference, gain_ratio): gain on the true label
    against the median gain over shuffled labels.

    The model of the true label and those of all shuffled labels grow in the same scans.
    """
    settings = Settings(rounds=trees, depth=depth, rate=0.05, row_share=0.7, feature_share=0.7, least_rows=20, leaves=31)
    inputs = fit_inputs(df, features)
    stored = written(inputs.binned(df, [target]).withColumn("row_id", F.monotonically_increasing_id()))
    marked = shuffled_labels(stored, "row_id", target, seed + 1, runs)
    labels = [_is_one(named(target)), *[F.shiftright("shuffled", k).bitwiseAND(F.lit(1)) == 1 for k in range(runs)]]
    table = growing_table(marked, [F.lit(True)] * (runs + 1), [F.lit(False)] * (runs + 1), labels)
    models = grow(table, [Settings(**{**asdict(settings), "seed": seed + k}) for k in range(runs + 1)], len(features), _width(inputs))
    gains = np.array([_gains(m.trees, features) for m in models])
    rows = zip(features, gains[0].tolist(), np.median(gains[1:], 0).tolist())
    found = df.sparkSession.createDataFrame(list(rows), "feature string, gain double, null_gain double")
    return found.select(
        "feature", "gain", "null_gain",
        (F.col("gain") - F.col("null_gain")).alias("gain_difference"),
        (F.col("gain") / F.greatest("null_gain", F.lit(1e-6))).alias("gain_ratio"),
    ).orderBy(F.desc("gain_difference"), "feature")


def null_importance_drops(
    detail: DataFrame, rule: str = "ratio", threshold: float | None = None
) -> DataFrame:
    """(feature, gain, null_gain, gain_difference, reason) of noise features.

    ``rule="ratio"`` (default 2) compares gain to null gain and fits any learner;
    ``rule="difference"`` (default 50) is in the gain unit of the learner.
    """
    if rule not in ("ratio", "difference"):
        raise ValueError("rule must be 'ratio' or 'difference'")
    column = f"gain_{rule}"
    if threshold is None:
        threshold = config.NULL_GAIN_RATIO if rule == "ratio" else config.NULL_GAIN_THRESHOLD
    text = texts.LOW_GAIN_RATIO if rule == "ratio" else texts.LOW_GAIN
    reason = F.format_string(text, F.format_string("%.1f", F.col(column)), F.lit(str(threshold)))
    return detail.filter(F.col(column) < threshold).select(
        "feature", "gain", "null_gain", "gain_difference", reason.alias("reason")
    )


def filter_null_importance(
    df: DataFrame,
    trees: int = config.NULL_TREES,
    depth: int = config.NULL_DEPTH,
    rule: str = "ratio",
    threshold: float | None = None,
    runs: int = config.NULL_RUNS,
    seed: int = config.RANDOM_SEED,
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Narrowed sample, detail and drop list; nothing is dropped with fewer than two features."""
    features = varying_numeric_features(df)
    if len(features) < 2:
        return df, None, None
    detail = null_importance(df, features, TARGET, trees, depth, runs, seed)
    drops = null_importance_drops(detail, rule, threshold)
    return df.drop(*[r.feature for r in drops.collect()]), detail, drops
