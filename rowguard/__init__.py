"""Rule-driven data quality for large Spark tables."""

from rowguard.catalogs import YELLOW_TAXI
from rowguard.functions.months import Month, MonthColumn
from rowguard.operators.cleaning import clean
from rowguard.operators.counts import clean_summary, flag_distribution, rule_counts
from rowguard.operators.report import cleaning_policy, quality_report
from rowguard.rules import Catalog, ColumnRule, DuplicateRule, MonthRule, PolicyLine, TimeOrderRule
from rowguard.session import get_session

__all__ = [
    "YELLOW_TAXI",
    "Catalog",
    "ColumnRule",
    "DuplicateRule",
    "Month",
    "MonthColumn",
    "MonthRule",
    "PolicyLine",
    "TimeOrderRule",
    "clean",
    "clean_summary",
    "cleaning_policy",
    "flag_distribution",
    "get_session",
    "quality_report",
    "rule_counts",
]
