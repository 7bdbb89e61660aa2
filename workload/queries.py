"""Registered queries: (spark, sf_dir) -> DataFrame, each over the whole tables."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import creditspark as cs
from creditspark.operators import binning, correlation, parzen, trees
from creditspark.plans.longform import ORG, TARGET, constant_columns
from creditspark.plans.ranking import with_places
from creditspark.plans.storage import checkpoint_folder, written
from creditspark.sources.load import valid_labels

from . import fixtures as fx

QUERIES = {}
TIEBREAK = ("l_orderkey", "l_linenumber", "quantity", "discount")
# Day that parts the sample into a base and a current half.
HALF = "19980701"
# Rounds of the boosted trees in registered queries; the library defaults are larger.
FEW_TREES = {"maxIter": 5, "maxDepth": 3, "stepSize": 0.2}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )


def stored_sample(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Sample with the listed features, stored once for operators that scan it repeatedly."""
    df = fx.sample(spark, sf_dir, *columns)
    return written(df if not columns else df.drop("l_orderkey", "l_linenumber"))


def with_year(df: DataFrame) -> DataFrame:
    return df.withColumn("new_date_y", F.substring("new_date", 1, 4))


def halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col("new_date") < HALF), df.filter(F.col("new_date") >= HALF)


# --- loading -----------------------------------------------------------------


@query
def load_clean(spark, sf_dir):
    return rounded(
        cs.clean_sample(
            fx.raw_sample(spark, sf_dir), "apply_date", "label", "org_info", key_cols=["l_orderkey", "l_linenumber"]
        )
    )


@query
def load_clean_options(spark, sf_dir):
    """Named drops, a compliance list, and no organisation column."""
    raw = fx.raw_sample(spark, sf_dir).withColumn("gender", F.col("l_linenumber") % 2)
    clean = cs.clean_sample(
        raw, "apply_date", "label", drop_cols=["sparse", "not_there"], exclude=["gender", "race"], sentinels=[-999]
    )
    return rounded(clean.drop("org_info"))


@query
def dedupe_keys(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return cs.dedupe_first(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query
def label_filter(spark, sf_dir):
    label = F.when(F.col("l_linenumber") % 4 != 3, F.col("l_linenumber") % 4).alias("label")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", label)
    return valid_labels(lines, "label")


@query
def sentinel_null(spark, sf_dir):
    return cs.null_sentinels(fx.raw_sample(spark, sf_dir).select("l_orderkey", "l_linenumber", "balance"))


@query
def constant_features(spark, sf_dir):
    raw = fx.raw_sample(spark, sf_dir).withColumn("nothing", F.lit(None).cast("double"))
    names = [c for c in raw.columns if c not in ("apply_date", "org_info", "label")]
    fixed = set(constant_columns(raw, names))
    rows = [F.struct(F.lit(n).alias("feature"), F.lit(n in fixed).alias("constant")) for n in names]
    return spark.range(1).select(F.inline(F.array(*rows)))


@query
def sample_gates(spark, sf_dir):
    return rounded(cs.sample_gates(fx.sample(spark, sf_dir)))


@query
def csv_round_trip(spark, sf_dir):
    path = f"{checkpoint_folder(spark)}/csv-{uuid.uuid4().hex}"
    cs.write_csv(fx.sample(spark, sf_dir, "quantity", "segment"), path, bom=False)
    back = cs.load_sample(
        spark, path, "new_date", "new_target", fmt="csv", org_col="new_org", drop_cols=["new_date_ym"]
    )
    return rounded(back.groupBy("new_org", "new_date_ym", "segment").agg(
        F.count("*").alias("n"), F.sum("quantity").alias("quantity"), F.sum("new_target").alias("bads")))


@query
def csv_with_mark(spark, sf_dir):
    """A written report table with the byte order mark, read again; the mark is part of no value."""
    path = f"{checkpoint_folder(spark)}/csv-{uuid.uuid4().hex}"
    cs.write_csv(fx.sample(spark, sf_dir, "quantity").groupBy(ORG, "new_date_ym").agg(F.sum("quantity").alias("quantity")), path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).where("length > 0")
    heads = files.agg(F.array_join(F.collect_set(F.hex(F.substring("content", 1, 3))), ",").alias("heads"))
    back = spark.read.option("header", True).csv(path).toDF(ORG, "new_date_ym", "quantity")
    return back.select(ORG, "new_date_ym", F.col("quantity").cast("double").alias("quantity")).crossJoin(F.broadcast(heads))


@query
def feature_list_saved(spark, sf_dir):
    """Numeric features that vary, written as a list and read against a table that lacks some of them."""
    df = fx.sample(spark, sf_dir).withColumn("const", F.lit(1))
    path = f"{checkpoint_folder(spark)}/features-{uuid.uuid4().hex}"
    cs.write_feature_list(spark, cs.varying_numeric_features(df.drop("l_orderkey", "l_linenumber")), path)
    found = cs.read_feature_list(spark, path, df.drop("tax", "drift"))
    values = df.agg(*[F.count_distinct(f).alias(f) for f in found])
    return values.unpivot([], found, "feature", "n_values")


@query
def metrics_saved(spark, sf_dir):
    """Evaluation written as JSON and read again, its lift table beside the pass lines of its record."""
    record, lift = cs.evaluate(fx.scored(spark, sf_dir), "formula", threshold=0.3)
    folder = f"{checkpoint_folder(spark)}/metrics-{uuid.uuid4().hex}"
    cs.write_evaluation(record, lift, folder)
    lines = spark.read.json(f"{folder}/metrics").select("thresholds.auc", "thresholds.lift_top10", F.col("generated_at").isNotNull().alias("has_time"))
    return spark.read.json(f"{folder}/lift").crossJoin(F.broadcast(lines))


@query
def parquet_by_month(spark, sf_dir):
    path = f"{checkpoint_folder(spark)}/months-{uuid.uuid4().hex}"
    cs.write_parquet(fx.sample(spark, sf_dir, "quantity"), path, by_month=True)
    back = cs.read_table(spark, path, schema=spark.read.parquet(path).schema)
    recent = back.filter(F.col("new_date_ym").cast("string") >= "200001")
    return recent.groupBy("new_org").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"))


# --- sample statistics -------------------------------------------------------


@query
def org_month_stats(spark, sf_dir):
    return rounded(cs.org_month_stats(fx.sample(spark, sf_dir, "quantity"), oos_orgs=["org3"]))


@query
def org_summary(spark, sf_dir):
    return rounded(cs.org_summary(fx.sample(spark, sf_dir, "quantity")))


@query
def abnormal_months(spark, sf_dir):
    return rounded(cs.abnormal_months(fx.sample(spark, sf_dir, "quantity"), min_bad=10, min_rows=80))


@query
def month_filtered(spark, sf_dir):
    kept, _ = cs.filter_abnormal_months(fx.sample(spark, sf_dir, "quantity"), min_bad=10, min_rows=80)
    return kept.groupBy(ORG, "new_date_ym").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"))


@query
def month_gaps(spark, sf_dir):
    kept, _ = cs.filter_abnormal_months(fx.sample(spark, sf_dir, "quantity"), min_bad=10, min_rows=80)
    return cs.month_gaps(kept)


@query
def org_outliers(spark, sf_dir):
    return rounded(cs.org_outliers(fx.sample(spark, sf_dir, "quantity"), factor=1.05))


@query
def missing_detail(spark, sf_dir):
    raw = fx.raw_sample(spark, sf_dir)
    roles = raw.withColumnsRenamed({"org_info": ORG, "label": TARGET})
    return cs.missing_detail(roles, features=[*fx.FEATURES, "const"])


@query
def missing_wide(spark, sf_dir):
    detail = cs.missing_detail(fx.sample(spark, sf_dir), features=fx.FEATURES)
    return cs.wide_by_scope(detail, "missing_rate", [f"org{i}" for i in range(8)])


@query
def missing_drop(spark, sf_dir):
    return cs.missing_drops(cs.missing_detail(fx.sample(spark, sf_dir), features=fx.FEATURES), 0.25, 6)


@query
def value_ratio_bands(spark, sf_dir):
    return cs.value_ratio_bands(fx.sample(spark, sf_dir), fx.NUMERIC, oos_orgs=["org1"])


# --- stability ---------------------------------------------------------------


@query
def psi_pair(spark, sf_dir):
    base, current = halves(stored_sample(spark, sf_dir, *fx.NUMERIC))
    return cs.psi_two_samples(base, current, fx.NUMERIC)


@query
def psi_categorical(spark, sf_dir):
    base, current = halves(fx.sample(spark, sf_dir, "segment"))
    return cs.psi_categorical(base.withColumn("org", F.col(ORG)), current.withColumn("org", F.col(ORG)), ["segment", "org"])


@query
def psi_by_org_period(spark, sf_dir):
    df = with_year(stored_sample(spark, sf_dir, *fx.NUMERIC))
    return cs.psi_by_org(df, fx.NUMERIC, period_col="new_date_y")


@query
def psi_by_org_month(spark, sf_dir):
    df = stored_sample(spark, sf_dir, "quantity", "balance", "drift")
    return cs.psi_by_org(df, ["quantity", "balance", "drift"], min_sample=80)


def _year_detail(spark, sf_dir):
    df = with_year(stored_sample(spark, sf_dir, *fx.NUMERIC))
    return written(cs.psi_by_org(df, fx.NUMERIC, period_col="new_date_y"))


@query
def psi_org_summary(spark, sf_dir):
    return cs.psi_org_summary(_year_detail(spark, sf_dir), 0.05)


@query
def psi_drop(spark, sf_dir):
    return cs.psi_drops(_year_detail(spark, sf_dir), 0.1, max_orgs=6)


@query
def psi_bands(spark, sf_dir):
    return cs.psi_bands(_year_detail(spark, sf_dir), oos_orgs=["org2"])


# --- binning and information value ------------------------------------------


def _bins(spark, sf_dir, k, by_org, *features):
    cells = binning.binning_cells(stored_sample(spark, sf_dir, *features), features, by_org)
    stats = binning.leaf_stats(binning.tree_leaves(cells, k))
    return rounded(binning.bin_ranges(cells, stats).drop("iv_part"))


@query
def cart_bins_k2(spark, sf_dir):
    return _bins(spark, sf_dir, 2, False, *fx.NUMERIC)


@query
def cart_bins_k3(spark, sf_dir):
    return _bins(spark, sf_dir, 3, True, *fx.NUMERIC)


@query
def cart_bins_k5(spark, sf_dir):
    return _bins(spark, sf_dir, 5, True, "quantity", "discount", "price", "balance")


@query
def iv_overall(spark, sf_dir):
    return cs.information_value(stored_sample(spark, sf_dir, *fx.NUMERIC), fx.NUMERIC)


@query
def iv_by_org(spark, sf_dir):
    return cs.iv_by_org(stored_sample(spark, sf_dir, *fx.NUMERIC), fx.NUMERIC)


@query
def iv_wide(spark, sf_dir):
    detail = cs.iv_by_org(stored_sample(spark, sf_dir, *fx.NUMERIC), fx.NUMERIC)
    return cs.wide_by_scope(detail, "iv", [f"org{i}" for i in range(8)])


@query
def iv_bands(spark, sf_dir):
    detail = cs.iv_by_org(stored_sample(spark, sf_dir, *fx.NUMERIC), fx.NUMERIC)
    return cs.iv_bands(detail, oos_orgs=["org5"])


@query
def iv_drop(spark, sf_dir):
    detail = cs.iv_by_org(stored_sample(spark, sf_dir, *fx.NUMERIC), fx.NUMERIC)
    return cs.iv_drops(detail)


# --- correlation -------------------------------------------------------------


@query
def corr_pairs(spark, sf_dir):
    return rounded(cs.correlation_pairs(fx.sample(spark, sf_dir, *fx.NUMERIC), fx.NUMERIC))


@query
def corr_pairs_gaps(spark, sf_dir):
    """``flat`` varies only where the balance is missing, so that pair has no correlation."""
    df = fx.sample(spark, sf_dir, "balance", "quantity")
    df = df.withColumn("flat", F.when(F.col("balance").isNull(), F.col("quantity")).otherwise(1.0))
    return rounded(cs.correlation_pairs(df, ["balance", "quantity", "flat"]))


@query
def corr_wide(spark, sf_dir):
    """Correlations of 300 derived columns, some with gaps; the pairs of four of them, in several tiles, are shown."""
    wide = fx.read_lines(spark, sf_dir).selectExpr(*[f"{e} AS {c}" for c, e in fx.WIDE.items()])
    pairs = cs.correlation_pairs(wide, list(fx.WIDE))
    return rounded(pairs.where(F.col("feature_1").isin(*fx.WIDE_SHOWN)), 5)


@query
def corr_high_pairs(spark, sf_dir):
    pairs = cs.correlation_pairs(fx.sample(spark, sf_dir, *fx.NUMERIC), fx.NUMERIC)
    return correlation.high_pairs(pairs, 0.5)


@query
def corr_drop(spark, sf_dir):
    return cs.correlation_drops(stored_sample(spark, sf_dir, *fx.NUMERIC), fx.NUMERIC)[1]


@query
def vif(spark, sf_dir):
    names = ["quantity", "discount", "price"]
    return rounded(cs.variance_inflation(fx.sample(spark, sf_dir, *names), names))


# --- split and folds ---------------------------------------------------------


def _split_rows(spark, sf_dir):
    return fx.sample(spark, sf_dir, "quantity", "discount")


@query
def time_split(spark, sf_dir):
    placed = cs.time_split(_split_rows(spark, sf_dir), tiebreak=TIEBREAK)
    return placed.groupBy("split", "new_date").agg(
        F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"), F.sum("quantity").alias("quantity"))


@query
def split_summary(spark, sf_dir):
    placed = cs.time_split(_split_rows(spark, sf_dir), tiebreak=TIEBREAK, val_of_rest=False)
    return rounded(cs.split_summary(placed))


@query
def stratified_folds(spark, sf_dir):
    placed = cs.stratified_folds(_split_rows(spark, sf_dir), 5, TIEBREAK)
    return placed.groupBy("fold", "new_target").agg(
        F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"), F.min("new_date").alias("first_date"),
        F.max("new_date").alias("last_date"))


@query
def forward_folds(spark, sf_dir):
    placed = cs.forward_folds(_split_rows(spark, sf_dir), 5, TIEBREAK)
    return placed.groupBy("fold").agg(
        F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"), F.min("new_date").alias("first_date"),
        F.max("new_date").alias("last_date"))


# --- metrics -----------------------------------------------------------------


@query
def score_table(spark, sf_dir):
    return rounded(cs.score_table(fx.scored(spark, sf_dir)))


@query
def auc_ks_gini(spark, sf_dir):
    return rounded(cs.ranking_metrics(fx.scored(spark, sf_dir)).drop("pr_auc"))


@query
def pr_auc(spark, sf_dir):
    return rounded(cs.ranking_metrics(fx.scored(spark, sf_dir)).select("pr_auc"))


@query
def metrics_by_org_month(spark, sf_dir):
    found = cs.ranking_metrics(fx.scored(spark, sf_dir), keys=[ORG, "new_date_ym"])
    return rounded(found.select(ORG, "new_date_ym", "rows", "auc", "ks", "pr_auc"))


@query
def lift_table(spark, sf_dir):
    return cs.lift_table(fx.scored(spark, sf_dir))


@contextmanager
def small_buckets(spark, rows: int = 500):
    """Value buckets as small, against these tables, as they are on tables of billions of rows."""
    spark.conf.set("spark.creditspark.rowsPerBucket", str(rows))
    try:
        yield
    finally:
        spark.conf.unset("spark.creditspark.rowsPerBucket")


@query
def lift_table_buckets(spark, sf_dir):
    with small_buckets(spark):
        return lift_table(spark, sf_dir)


@query
def iv_by_org_buckets(spark, sf_dir):
    with small_buckets(spark):
        return iv_by_org(spark, sf_dir)


@query
def woe_bins_buckets(spark, sf_dir):
    with small_buckets(spark):
        return woe_bins(spark, sf_dir)


@query
def odd_names(spark, sf_dir):
    """Information value and stability index of a column with a dot in its name."""
    df = stored_sample(spark, sf_dir, "balance").withColumnRenamed("balance", "bal.avg")
    base, current = halves(df)
    return rounded(cs.information_value(df, ["bal.avg"]).join(cs.psi_two_samples(base, current, ["bal.avg"]), "feature"))


@query
def confusion(spark, sf_dir):
    return rounded(cs.confusion(fx.scored(spark, sf_dir), threshold=0.3))


@query
def eval_record(spark, sf_dir):
    return cs.pass_flags(cs.evaluate(fx.scored(spark, sf_dir), "formula", threshold=0.3)[0])


@query
def segment_stability(spark, sf_dir):
    return cs.segment_stability(fx.scored(spark, sf_dir))


@query
def segment_sizes(spark, sf_dir):
    """Stability of segments of a day and more than a few rows: those of 49 rows go, those of 50 stay."""
    rows = with_places(fx.scored(spark, sf_dir), ["new_org"], ["l_orderkey", "l_linenumber", "quantity", "discount", "p"])
    # Per organisation segments of 49, 50 and 51 rows, then the rest.
    cut = F.expr("CASE WHEN place < 49 THEN 'a' WHEN place < 99 THEN 'b' WHEN place < 150 THEN 'c' ELSE 'd' END")
    named = written(rows.withColumn("segment", F.concat_ws("-", "new_org", cut)))
    return cs.segment_stability(named, "segment").select("segment", "n_samples", "bad_rate", "auc", "ks")


# --- WOE, scorecard ----------------------------------------------------------

SCORECARD_FEATURES = ("quantity", "discount", "balance", "segment")


@query
def woe_bins(spark, sf_dir):
    fitted = cs.fit_woe(stored_sample(spark, sf_dir, *SCORECARD_FEATURES), SCORECARD_FEATURES)
    return rounded(fitted.bins.drop("iv_part"))


@query
def woe_iv(spark, sf_dir):
    return cs.fit_woe(stored_sample(spark, sf_dir, *SCORECARD_FEATURES), SCORECARD_FEATURES).iv()


@query
def woe_transform(spark, sf_dir):
    """Bins of the base half, applied to all rows."""
    df = stored_sample(spark, sf_dir, *SCORECARD_FEATURES)
    coded = cs.woe_transform(df, cs.fit_woe(halves(df)[0], SCORECARD_FEATURES))
    return rounded(coded.select(
        "new_date", ORG, *[c for f in SCORECARD_FEATURES for c in (f, f"{f}_woe")]))


@query
def score_formula(spark, sf_dir):
    return fx.scored(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", cs.score_points(F.col("p")).alias("score"),
        cs.score_points(F.col("p"), direction="quality").alias("quality_score"))


def _train_val_test(spark, sf_dir, *features):
    placed = written(cs.time_split(stored_sample(spark, sf_dir, *features), val_of_rest=False))
    return cs.split_frames(placed)


@query
def scorecard_fit(spark, sf_dir):
    train, val, _ = _train_val_test(spark, sf_dir, *SCORECARD_FEATURES)
    card = cs.train_scorecard(train, SCORECARD_FEATURES)
    return cs.evaluate(card.predict(val), "scorecard")[0]


@query
def scorecard_certificate(spark, sf_dir):
    """Whether the gradient of the penalised loss is zero in every weight of a scorecard that was saved and loaded."""
    df = stored_sample(spark, sf_dir, *SCORECARD_FEATURES)
    folder = _saved(spark)
    cs.train_scorecard(df, SCORECARD_FEATURES).save(folder)
    found = cs.Scorecard.load(spark, folder).gradient(df)
    return found.select(F.coalesce("feature", F.lit("intercept")).alias("feature"), (F.abs("gradient") <= 1e-6).alias("flat"))


@query
def scorecard_auc(spark, sf_dir):
    train, _, test = _train_val_test(spark, sf_dir, *SCORECARD_FEATURES)
    return rounded(cs.scorecard_metrics(cs.train_scorecard(train, SCORECARD_FEATURES), train, test))


@query
def scorecard_points(spark, sf_dir):
    card = cs.train_scorecard(stored_sample(spark, sf_dir, *SCORECARD_FEATURES), SCORECARD_FEATURES)
    return rounded(card.score_map(), 4)


# --- trees -------------------------------------------------------------------

TREE_FEATURES = ("quantity", "discount", "balance", "tax", "segment")


@query
def tree_fit(spark, sf_dir):
    train, val, test = _train_val_test(spark, sf_dir, *TREE_FEATURES)
    model = cs.train_tree(train, TREE_FEATURES, val, params=FEW_TREES)
    return cs.evaluate(model.predict(test), "lgb")[0]


def _saved(spark) -> str:
    """A fresh folder for a model or table that is written and read again."""
    return f"{checkpoint_folder(spark)}/saved-{uuid.uuid4().hex}"


@query
def tree_published(spark, sf_dir):
    """The published preset with all its rounds, early stopping included."""
    train, val, test = _train_val_test(spark, sf_dir, *TREE_FEATURES)
    return cs.evaluate(cs.train_tree(train, TREE_FEATURES, val).predict(test), "lgb")[0]


@query
def tree_first_round(spark, sf_dir):
    """The first tree of the published preset on all rows and features, two levels deep, saved and loaded."""
    df = stored_sample(spark, sf_dir, *fx.TREE_LIMITS)
    whole = {"maxIter": 1, "maxDepth": 2, "subsamplingRate": 1.0, "featureSubsetStrategy": "1.0"}
    folder = _saved(spark)
    cs.train_tree(df, list(fx.TREE_LIMITS), params=whole, limits=fx.TREE_LIMITS).save(folder)
    return rounded(cs.TreeModel.load(spark, folder).nodes().select("feature", "below", "gain", "value", "rows"), 4)


@query
def category_codes(spark, sf_dir):
    """Alphabetical codes of a text column with nearly as many values as rows."""
    lines = fx.read_lines(spark, sf_dir)
    return cs.category_codes(lines.select(F.concat_ws("-", "l_partkey", "l_suppkey").alias("pair")), ["pair"])


@query
def shuffled_ones(spark, sf_dir):
    """Ones of five shuffled labels, and how many of them stay where they were."""
    df = fx.sample(spark, sf_dir, "quantity").select(F.concat_ws("-", "l_orderkey", "l_linenumber", "quantity").alias("row_id"), TARGET)
    marked = trees.shuffled_labels(written(df.distinct()), "row_id", TARGET, 42, runs=5)
    run = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("run")
    one = F.expr("shiftright(shuffled, run) & 1")
    return marked.select(TARGET, "shuffled", run).groupBy("run").agg(
        F.count("*").alias("rows"), F.sum(one).alias("ones"),
        (F.abs(F.avg(one * F.col(TARGET)) - F.avg(TARGET) * F.avg(TARGET)) < 0.02).alias("independent"))


@query
def tree_segments(spark, sf_dir):
    train, val, _ = _train_val_test(spark, sf_dir, *TREE_FEATURES)
    return cs.training_report(cs.train_tree(train, TREE_FEATURES, model_type="xgb", params=FEW_TREES), val)["segments"]


@query
def tree_importance(spark, sf_dir):
    model = cs.train_tree(stored_sample(spark, sf_dir, *TREE_FEATURES), TREE_FEATURES, model_type="xgb", params=FEW_TREES)
    return rounded(model.importance(), 3)


@query
def cv_report(spark, sf_dir):
    df = fx.sample(spark, sf_dir, *TREE_FEATURES)
    return cs.cross_validate(written(df), TREE_FEATURES, params=FEW_TREES, tiebreak=TIEBREAK)


@query
def cv_sizes(spark, sf_dir):
    """Rows that train and validate each fold."""
    df = fx.sample(spark, sf_dir, "quantity", "discount")
    few = {**FEW_TREES, "maxIter": 1}
    return cs.cross_validate(written(df), ["quantity", "discount"], params=few, tiebreak=TIEBREAK).select("fold", "train_size", "val_size")


@query
def cv_summary(spark, sf_dir):
    df = fx.sample(spark, sf_dir, *TREE_FEATURES)
    folds = cs.cross_validate(written(df), TREE_FEATURES, folds=3, params=FEW_TREES, tiebreak=TIEBREAK, mode="forward")
    return rounded(cs.cv_summary(folds), 3)


@query
def summary_of_folds(spark, sf_dir):
    """Mean and spread over five folds of the metrics of a score that needs no fit."""
    rows = fx.sample(spark, sf_dir, "quantity", "discount").withColumn("p", F.expr(fx.SCORE))
    placed = cs.stratified_folds(rows, tiebreak=["l_orderkey", "l_linenumber", "quantity", "discount"])
    found = cs.ranking_metrics(placed, "p", TARGET, ["fold"])
    return rounded(cs.cv_summary(found.select("fold", *[F.bround(m, 4).alias(f"val_{m}") for m in ("auc", "ks", "gini")])), 6)


@query
def tree_gain(spark, sf_dir):
    """Summed split gain of the first tree, with a feature that it does not use."""
    df = stored_sample(spark, sf_dir, *fx.TREE_LIMITS)
    whole = {"maxIter": 1, "maxDepth": 2, "subsamplingRate": 1.0, "featureSubsetStrategy": "1.0"}
    return rounded(cs.train_tree(df, list(fx.TREE_LIMITS), params=whole, limits=fx.TREE_LIMITS).importance(), 3)


@query
def search_densities(spark, sf_dir):
    """Twenty trials of the weight of a score, the densities that the search sees at their places, and which it would try again."""
    rows = fx.sample(spark, sf_dir, "quantity", "discount")
    each = [F.struct(F.lit(k).alias("trial"), F.expr(fx.trial_score(w)).alias("p")) for k, w in enumerate(fx.TRIALS)]
    long = rows.select(TARGET, F.explode(F.array(*each)).alias("x")).select(TARGET, "x.*")
    found = {r.trial: round(r.auc, 6) for r in cs.ranking_metrics(long, "p", TARGET, ["trial"]).collect()}
    finished = [({"w": w, "trial": k}, found[k]) for k, w in enumerate(fx.TRIALS)]
    good, rest = parzen.parted(finished)
    better, worse = [parzen.mixture([d["w"] for d in part], 0, 1).density(fx.TRIALS) for part in (good, rest)]
    ratio = better / worse
    table = [
        (k, found[k], k in {d["trial"] for d in good}, float(better[k]), float(worse[k]), bool(ratio[k] == ratio.max()))
        for k in range(len(fx.TRIALS))
    ]
    return rounded(spark.createDataFrame(table, "trial int, auc double, good boolean, better double, worse double, next boolean"), 4)


@query
def search_report(spark, sf_dir):
    train, val, _ = _train_val_test(spark, sf_dir, *TREE_FEATURES)
    return cs.search_params(train, val, TREE_FEATURES, ranges={"maxIter": (2, 5), "maxDepth": (2, 3)})[1]


@query
def null_importance(spark, sf_dir):
    df = stored_sample(spark, sf_dir, "quantity", "discount", "tax", "price")
    return rounded(cs.null_importance(df, ["quantity", "discount", "tax", "price"], trees=3, depth=3), 3)


@query
def null_importance_published(spark, sf_dir):
    df = stored_sample(spark, sf_dir, "quantity", "discount", "tax", "price")
    return rounded(cs.null_importance(df, ["quantity", "discount", "tax", "price"]), 3)


@query
def feature_selection(spark, sf_dir):
    df = fx.sample(spark, sf_dir).drop("l_orderkey", "l_linenumber")
    kept, _ = cs.select_features(df, min_bad=5, min_rows=30, run_null_importance=True)
    return cs.selection_summary(df, kept)


@query
def selection_report(spark, sf_dir):
    df = fx.sample(spark, sf_dir).drop("l_orderkey", "l_linenumber")
    _, tables = cs.select_features(df, min_bad=5, min_rows=30, run_null_importance=False)
    return cs.step_summary(tables, {"min_bad": 5, "min_rows": 30})


# --- monitoring --------------------------------------------------------------


@query
def baseline_stats(spark, sf_dir):
    table = cs.baseline(fx.sample(spark, sf_dir), fx.FEATURES)
    flat = [F.col("percentiles")[f"p{p}"].alias(f"p{p}") for p in (1, 5, 25, 50, 75, 95, 99)]
    return rounded(table.select(
        "feature", "numeric", "n_samples", "bad_rate", "mean", "std", "min", "max", "median", "missing_rate", *flat), 5)


@query
def baseline_merge(spark, sf_dir):
    """The stored baseline of one half brought up to all rows by that of the other half; whether the ranks
    of its percentiles are right within a two-hundredth of the rows."""
    df = stored_sample(spark, sf_dir, *fx.NUMERIC)
    base, current = halves(df)
    folder = _saved(spark)
    cs.save_baseline(cs.baseline(base, fx.NUMERIC), folder)
    table = written(cs.merged_baselines([cs.load_baseline(spark, folder), cs.baseline(current, fx.NUMERIC)]))
    found = {r.feature: r for r in table.collect()}
    off = []
    for f in fx.NUMERIC:
        n = F.count(f)
        shares = [(int(p[1:]) / 100, F.count_if(F.col(f) < v) / n, F.count_if(F.col(f) <= v) / n) for p, v in found[f].percentiles.items()]
        right = reduce(Column.__and__, [(low <= q + 0.005) & (high >= q - 0.005) for q, low, high in shares])
        off.append(F.struct(F.lit(f).alias("feature"), right.alias("ranks_right")))
    checked = df.agg(F.array(*off).alias("x")).select(F.inline("x"))
    counted = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)
    return rounded(table.join(checked, "feature").select(
        "feature", "n_samples", "bad_rate", "mean", "std", "min", "max", "missing_rate", counted.alias("counted"), "ranks_right"), 5)


def _drifted(spark, sf_dir):
    """Base half, and a current half whose balance goes missing for large orders."""
    base, current = halves(stored_sample(spark, sf_dir, *fx.FEATURES))
    current = current.withColumn("balance", F.when(F.col("quantity") <= 40, F.col("balance")))
    return cs.baseline(base, fx.FEATURES), current


@query
def feature_drift(spark, sf_dir):
    base, current = _drifted(spark, sf_dir)
    return rounded(cs.feature_drift(base, current))


@query
def feature_alerts(spark, sf_dir):
    base, current = _drifted(spark, sf_dir)
    return cs.monitor_features(base, current)


def _scored_halves(spark, sf_dir):
    """The current half has fewer good rows and a score that falls with the quantity, so that the
    score drifts, the model degrades and the bad rate changes."""
    base, current = halves(written(fx.scored(spark, sf_dir)))
    return base, current.filter(fx.WORSE_ROWS).withColumn("p", F.expr(fx.WORSE_SCORE))


@query
def model_drift(spark, sf_dir):
    return rounded(cs.model_drift(*_scored_halves(spark, sf_dir)))


@query
def model_alerts(spark, sf_dir):
    return cs.monitor_model(*_scored_halves(spark, sf_dir))[1]


@query
def alert_summary(spark, sf_dir):
    base, current = _drifted(spark, sf_dir)
    return cs.alert_summary(
        cs.monitor_features(base, current), cs.monitor_model(*_scored_halves(spark, sf_dir))[1])
