from strata.operators.dedupe import dedupe_latest
from strata.operators.flatten import flatten_columnar, flatten_map_payload
from strata.operators.gold import daily_summary, flag_rates, rollup_mart
from strata.operators.lineage import add_bronze_metadata, file_path_column, stamp_slice
from strata.operators.quality import (
    Check,
    SuiteResult,
    assert_unique,
    duplicate_groups,
    expect,
    expect_between,
    expect_not_null,
    expect_values_in,
    gate_pass_rate,
    out_of_range_counts,
    run_suite,
    suite_metrics,
    tag_failures,
)
from strata.operators.scd2 import scd2_initial, scd2_merge
from strata.operators.windows import window_counts

__all__ = [
    "Check",
    "SuiteResult",
    "add_bronze_metadata",
    "assert_unique",
    "daily_summary",
    "dedupe_latest",
    "duplicate_groups",
    "expect",
    "expect_between",
    "expect_not_null",
    "expect_values_in",
    "file_path_column",
    "flag_rates",
    "flatten_columnar",
    "flatten_map_payload",
    "gate_pass_rate",
    "out_of_range_counts",
    "rollup_mart",
    "run_suite",
    "scd2_initial",
    "scd2_merge",
    "stamp_slice",
    "suite_metrics",
    "tag_failures",
    "window_counts",
]
