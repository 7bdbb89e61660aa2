"""The chained feature selection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import config
from ..plans.longform import features_of
from ..plans.storage import stored
from .correlation import filter_correlation
from .iv import filter_iv
from .missing import filter_missing
from .psi import filter_psi
from .report import write_step_report
from .sample import filter_abnormal_months
from .trees import filter_null_importance


def select_features(
    df: DataFrame,
    run_psi: bool = True,
    run_null_importance: bool = True,
    report_folder: str | None = None,
    min_bad: int = config.MIN_MONTH_BAD,
    min_rows: int = config.MIN_MONTH_ROWS,
    missing_threshold: float = config.MISSING_THRESHOLD,
    iv_threshold: float = config.IV_THRESHOLD,
    org_iv_threshold: float | None = None,
    psi_threshold: float = config.PSI_THRESHOLD,
    max_unstable_orgs: int = config.MAX_UNSTABLE_ORGS,
    correlation_threshold: float = config.CORRELATION_THRESHOLD,
    null_trees: int = config.NULL_TREES,
    null_depth: int = config.NULL_DEPTH,
    null_rule: str = "ratio",
    null_threshold: float | None = None,
    null_runs: int = config.NULL_RUNS,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Run months, missing, IV, PSI, null importance and correlation filters in this order.

    Returns the narrowed sample and the tables of every step. The sample is evaluated and stored
    once; its abnormal months are left out as it is read, and the later filters only drop columns from it, so
    each of them scans just the columns still alive. Text features pass every filter
    but the missing-rate one.
    """
    tables: dict[str, DataFrame] = {}
    df, tables["abnormal_months"] = filter_abnormal_months(stored(df), min_bad, min_rows)
    df, tables["missing_detail"], tables["missing_drops"], tables["value_ratio_bands"] = filter_missing(
        df, missing_threshold, max_unstable_orgs
    )
    org_iv = iv_threshold if org_iv_threshold is None else org_iv_threshold
    df, tables["iv_detail"], tables["iv_drops"], tables["iv_bands"] = filter_iv(df, iv_threshold, org_iv)
    if run_psi:
        df, tables["psi_detail"], tables["psi_drops"], tables["psi_bands"] = filter_psi(
            df, psi_threshold, max_orgs=max_unstable_orgs
        )
    if run_null_importance:
        df, detail, drops = filter_null_importance(df, null_trees, null_depth, null_rule, null_threshold, null_runs)
        if detail is not None:
            tables["null_importance_detail"], tables["null_importance_drops"] = detail, drops
    df, tables["correlation_detail"], tables["correlation_drops"] = filter_correlation(df, correlation_threshold)
    if report_folder is not None:
        write_step_report(
            tables,
            report_folder,
            {
                "min_bad": min_bad, "min_rows": min_rows, "missing": missing_threshold, "iv": iv_threshold,
                "org_iv": org_iv, "psi": psi_threshold, "psi_orgs": max_unstable_orgs, "corr": correlation_threshold,
                "null_rule": null_rule, "null_threshold": null_threshold,
            },
        )
    return df, tables


def selection_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """(feature, selected) over the features before selection."""
    kept = set(features_of(after))
    rows = [(f, f in kept) for f in features_of(before)]
    return before.sparkSession.createDataFrame(rows, "feature string, selected boolean")
