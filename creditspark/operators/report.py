"""Report tables of evaluation, monitoring and feature selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..plans.longform import OVERALL
from ..plans.storage import written
from ..sources.sinks import stamped, with_report_headers, write_json
from .iv import wide_by_scope
from .metrics import evaluate, pass_flags, segment_stability
from .monitor import alert_summary

# Report step names in order, with what each step removes and its condition.
STEPS = {
    "abnormal_months": ("Step4-异常月份处理", "坏样本数<{min_bad} 或 总样本数<{min_rows} 的月份剔除"),
    "value_ratio_bands": ("Step5-有值率分布统计", ""),
    "missing_drops": ("Step6-高缺失率处理", "整体缺失率>{missing} 的特征剔除"),
    "missing_detail": ("Step6-缺失率明细", ""),
    "iv_detail": ("Step7-IV明细", ""),
    "iv_bands": ("Step7-IV分布统计", ""),
    "iv_drops": ("Step7-IV处理", "整体IV<{iv} 或 {iv_orgs}+个机构IV<{org_iv} 的特征剔除"),
    "psi_detail": ("Step8-PSI明细", ""),
    "psi_bands": ("Step8-PSI分布统计", ""),
    "psi_drops": ("Step8-PSI处理", "PSI>{psi} 不稳定月份占比≥{ratio:.0%} 的机构≥{psi_orgs}个则剔除"),
    "null_importance_drops": ("Step9-Null Importance处理", "{null_condition} 视为噪声剔除"),
    "null_importance_detail": ("Step9-Null Importance明细", ""),
    "correlation_drops": ("Step10-高相关性剔除", "相关性>{corr} 的特征剔除"),
    "correlation_detail": ("Step10-相关性明细", ""),
}
# Tables that the summary does not list.
NOT_IN_SUMMARY = ("value_ratio_bands", "iv_detail", "iv_bands", "psi_detail", "psi_bands")
# Details that a report shows with a column per organisation, and the value shown.
WIDE_DETAILS = {"missing_detail": "missing_rate", "iv_detail": "iv"}
DEFAULTS = {
    "min_bad": config.MIN_MONTH_BAD, "min_rows": config.MIN_MONTH_ROWS, "missing": config.MISSING_THRESHOLD,
    "iv": config.IV_THRESHOLD, "org_iv": config.ORG_IV_THRESHOLD, "iv_orgs": config.MAX_ORG_LOW_IV,
    "psi": config.PSI_THRESHOLD, "ratio": config.MAX_MONTHS_RATIO, "psi_orgs": config.MAX_UNSTABLE_ORGS,
    "null_rule": "ratio", "null_threshold": None, "corr": config.CORRELATION_THRESHOLD,
}


def step_condition(step: str, params: dict | None = None) -> str:
    """Condition text of a filter step with the thresholds really used."""
    used = {**DEFAULTS, **(params or {})}
    ratio = used["null_rule"] == "ratio"
    threshold = used["null_threshold"]
    if threshold is None:
        threshold = config.NULL_GAIN_RATIO if ratio else config.NULL_GAIN_THRESHOLD
    used["null_condition"] = f"原始gain与置换gain之{'比' if ratio else '差'}<{threshold}"
    return STEPS[step][1].format(**used)


def step_summary(tables: dict[str, DataFrame], params: dict | None = None) -> DataFrame:
    """(position, step, action, result, condition) of a selection run; of details and bands only
    those that the published summary lists."""
    parts = []
    for position, (step, (title, _)) in enumerate(STEPS.items()):
        if step not in tables or step in NOT_IN_SUMMARY:
            continue
        table, condition = tables[step], step_condition(step, params)
        n = F.col("n")
        counted = F.when(n > 0, F.format_string("%d 条记录", n)).otherwise(F.lit("空"))
        if condition:
            unit = "%d 个特征" if "feature" in table.columns else "%d 条记录"
            counted = F.when(n > 0, F.format_string("剔除 " + unit, n)).otherwise(F.lit("空"))
        parts.append(
            table.agg(F.count("*").alias("n")).select(
                F.lit(position).alias("position"), F.lit(title).alias("step"),
                F.lit(title.split("-", 1)[1]).alias("action"), counted.alias("result"),
                # A step that removed nothing states no condition.
                F.when(n > 0, F.lit(condition)).otherwise(F.lit("")).alias("condition"),
            )
        )
    return reduce(DataFrame.unionByName, parts).orderBy("position")


def write_step_report(tables: dict[str, DataFrame], folder: str, params: dict | None = None) -> None:
    """A summary table and one table per step that has rows, with report headers; missing rates and information
    values with one column per organisation."""
    stamped(step_summary(tables, params)).write.mode("overwrite").parquet(f"{folder}/summary")
    for step in STEPS:
        if step in tables and not tables[step].isEmpty():
            with_report_headers(report_form(step, tables[step])).write.mode("overwrite").parquet(f"{folder}/{step}")


def report_form(step: str, table: DataFrame) -> DataFrame:
    """The table of a step as a report shows it."""
    if step not in WIDE_DETAILS:
        return table
    scopes = [r.scope for r in table.select("scope").distinct().orderBy("scope").collect() if r.scope != OVERALL]
    return wide_by_scope(table, WIDE_DETAILS[step], scopes)


def model_report(record: DataFrame) -> DataFrame:
    """Evaluation records with the pass lines and a time stamp."""
    lines = F.struct(
        F.lit(config.AUC_PASS).alias("auc"), F.lit(config.KS_PASS).alias("ks"), F.lit(config.GINI_PASS).alias("gini"),
        F.lit(config.TOP_LIFT_PASS).alias("lift_top10"), F.lit(config.MONITOR_PSI).alias("psi"),
    )
    return stamped(record.withColumn("thresholds", lines))


def write_evaluation(record: DataFrame, lift: DataFrame, folder: str, segments: DataFrame | None = None) -> None:
    write_json(model_report(record), f"{folder}/metrics")
    write_json(lift, f"{folder}/lift")
    if segments is not None:
        write_json(segments, f"{folder}/segments")


def training_report(model, df: DataFrame, model_name: str = "model") -> dict[str, DataFrame]:
    """Metrics with pass flags, lift, feature importance (if the model has one) and
    per-organisation stability of a fitted model on held-out rows."""
    scored = written(model.predict(df))
    record, lift = evaluate(scored, model_name)
    tables = {"metrics": pass_flags(record), "lift": lift, "segments": segment_stability(scored)}
    if hasattr(model, "importance"):
        tables["importance"] = model.importance()
    return tables


def write_monitoring(comparison: DataFrame, model: DataFrame, features: DataFrame, folder: str) -> None:
    write_json(stamped(comparison), f"{folder}/model")
    write_json(model, f"{folder}/model_alerts")
    write_json(features, f"{folder}/feature_alerts")
    write_json(stamped(alert_summary(features, model)), f"{folder}/summary")
