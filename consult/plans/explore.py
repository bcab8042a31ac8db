"""Explore plan (step (a) of the lifecycle): every profile and validation
report over one persisted, typed copy of the input.

The input is read and coerced once and kept with MEMORY_AND_DISK (a lost
executor recomputes its blocks from lineage); each report is then one or two
aggregations over that copy.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from consult import schema as S
from consult.operators import quality as Q
from consult.operators.cleaning import coerce_types

REPORTS = {
    "dataset_summary": Q.dataset_summary,
    "missing_profile": Q.missing_profile,
    "missing_pattern": Q.missing_pattern,
    "feature_profile": Q.feature_profile,
    "value_distribution": Q.value_distribution,
    "class_balance": Q.class_balance,
    "range_violations": Q.range_violations,
    "group_size_stats": Q.group_size_stats,
    "group_size_histogram": Q.group_size_histogram,
    "correlation_matrix": Q.correlation_matrix,
    "label_correlation": Q.label_correlation,
    "iqr_outliers": Q.iqr_outliers,
    "duplicate_profile": Q.duplicate_profile,
    "sample_size_check": Q.sample_size_check,
    "feature_quality": Q.feature_quality,
    "target_quality": Q.target_quality,
    "quality_verdict": Q.quality_verdict,
    "exploration_summary": Q.exploration_summary,
}


def profile_report(raw: DataFrame, reports: list[str] | None = None,
                   level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(persisted typed input, {report name: DataFrame}). Unpersist with
    ``release(typed)`` when done."""
    typed = coerce_types(raw).persist(level)
    # Shared intermediate results: several reports group by all columns
    # (duplicates) or by patient (rows per patient). Persisting those two
    # grouped tables lets the cache manager substitute them into every report
    # whose plan contains the same subtree: one shuffle each, not one per report.
    Q.duplicate_groups(typed).persist(level)
    if S.ID in typed.columns:
        Q.group_sizes(typed, S.ID).persist(level)
    names = reports or list(REPORTS)
    return typed, {n: REPORTS[n](typed) for n in names}


def release(typed: DataFrame) -> None:
    """Drop the persisted input and the shared grouped tables."""
    Q.duplicate_groups(typed).unpersist()
    if S.ID in typed.columns:
        Q.group_sizes(typed, S.ID).unpersist()
    typed.unpersist()


def write_reports(reports: dict[str, DataFrame], write, parallelism: int = 4) -> None:
    """Run ``write(name, df)`` for every report, ``parallelism`` jobs at a
    time. Each report is a few small aggregation jobs over the persisted
    input; submitting them concurrently lets the scheduler overlap them
    instead of leaving executors idle between short stages."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max(1, parallelism)) as ex:
        list(ex.map(lambda kv: write(*kv), reports.items()))
