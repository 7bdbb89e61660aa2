"""Texts of reports.

Fixed values: the sample tags, alert types, reason formats and column headers
below are the published output texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

OOS_TAG = "贷外"
MODEL_TAG = "建模"

LOW_BADS = "坏样本数%s<%s"
LOW_ROWS = "总样本数%s<%s"
HIGH_MISSING = "整体缺失率%s>%s"
HIGH_MISSING_ORGS = "%s个机构缺失率>%s"
LOW_IV = "整体IV=%s<%s"
LOW_IV_ORGS = "%s个机构IV<%s"
UNSTABLE_ORGS = "PSI不稳定机构数%s/%s"
LOW_GAIN = "gain差异%s<%s"
LOW_GAIN_RATIO = "gain差异比%s<%s"
CORRELATED = "与%s相关系数=%s>%s，IV较低(%s<%s)"

PSI_ALERT = "PSI漂移"
MISSING_ALERT = "缺失率变化"
SCORE_ALERT = "评分分布漂移"
AUC_ALERT = "AUC退化"
BAD_RATE_ALERT = "坏样本率变化"

HEADERS = {
    "org": "机构",
    "month": "年月",
    "feature": "变量",
    "overall": "整体",
    "bads": "单月坏样本数",
    "rows": "单月总样本数",
    "bad_rate": "单月坏样率",
    "org_bads": "总坏样本数",
    "org_rows": "总样本数",
    "org_bad_rate": "总坏样率",
    "sample_type": "样本类型",
    "period": "月份",
    "psi": "PSI值",
    "iv": "IV值",
    "reason": "处理原因",
    "unstable_orgs": "不稳定机构",
    "band": "区间",
    "n_features": "变量个数",
    "share": "占比",
    "feature_1": "变量1",
    "feature_2": "变量2",
    "r": "相关系数",
    "gain": "原始gain",
    "null_gain": "置换gain_50分位",
    "gain_difference": "gain差异",
    "gain_ratio": "gain差异比",
}


def four(value: Column) -> Column:
    return F.format_string("%.4f", value)


def sample_tag(org: str, oos_orgs: Sequence[str]) -> Column:
    """Out-of-sample tag for the listed organisations, else the modelling tag."""
    inside = F.col(org).isin(*oos_orgs) if oos_orgs else F.lit(False)
    return F.when(inside, F.lit(OOS_TAG)).otherwise(F.lit(MODEL_TAG))
