"""strata: medallion-style Bronze / Silver / Gold operators on Apache Spark.

The common entry points, importable from the package root; the modules
below hold the rest (``strata.operators``, ``strata.sources``,
``strata.streaming``, ``strata.plans``).
"""
from strata.operators import (
    Check,
    SuiteResult,
    add_bronze_metadata,
    assert_unique,
    daily_summary,
    dedupe_latest,
    expect_between,
    expect_not_null,
    expect_values_in,
    flag_rates,
    flatten_columnar,
    rollup_mart,
    run_suite,
    scd2_initial,
    scd2_merge,
    window_counts,
)
from strata.session import build_session, checkpoint_root, scratch_path

__all__ = [
    "Check",
    "SuiteResult",
    "add_bronze_metadata",
    "assert_unique",
    "build_session",
    "checkpoint_root",
    "daily_summary",
    "dedupe_latest",
    "expect_between",
    "expect_not_null",
    "expect_values_in",
    "flag_rates",
    "flatten_columnar",
    "rollup_mart",
    "run_suite",
    "scd2_initial",
    "scd2_merge",
    "scratch_path",
    "window_counts",
]
