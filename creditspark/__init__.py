"""Credit-risk sample analysis, feature selection, scorecards and monitoring on Spark.

Every operator is a function from DataFrame to DataFrame.
"""

from .operators.bands import iv_bands, psi_bands
from .operators.correlation import correlation_drops, correlation_pairs, filter_correlation, variance_inflation
from .operators.iv import filter_iv, information_value, iv_by_org, iv_drops, wide_by_scope
from .operators.metrics import (
    auc, confusion, evaluate, lift_table, pass_flags, ranking_metrics, score_table, segment_stability,
)
from .operators.missing import filter_missing, missing_detail, missing_drops, value_ratio_bands
from .operators.monitor import (
    alert_summary, baseline, feature_alerts, feature_drift, load_baseline, merged_baselines, model_alerts, model_drift, monitor_features,
    monitor_model, save_baseline,
)
from .operators.psi import filter_psi, psi_by_org, psi_categorical, psi_drops, psi_org_summary, psi_two_samples
from .operators.report import (
    model_report, step_summary, training_report, write_evaluation, write_monitoring, write_step_report,
)
from .operators.sample import (
    abnormal_months, drop_months, filter_abnormal_months, month_gaps, org_month_stats, org_outliers, org_summary,
    sample_gates,
)
from .operators.encode import category_codes, with_codes
from .operators.scorecard import Scorecard, score_points, scorecard_metrics, train_scorecard
from .operators.selection import select_features, selection_summary
from .operators.split import forward_folds, split_frames, split_sizes, split_summary, stratified_folds, time_split
from .operators.trees import (
    TreeModel, cross_validate, cv_summary, filter_null_importance, null_importance, null_importance_drops,
    search_params, total_gain, train_tree,
)
from .operators.woe import WoeBins, fit_woe, woe_transform
from .plans.longform import features_of, numeric_features, present, text_features, varying_numeric_features
from .plans.storage import release
from .sources.load import clean_sample, dedupe_first, load_sample, null_sentinels, read_feature_list, read_table
from .sources.sinks import stamped, with_report_headers, write_csv, write_feature_list, write_json, write_parquet
