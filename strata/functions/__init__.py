from strata.functions.columns import (
    all_present,
    any_null,
    differs_null_safe,
    event_date,
    lenient_cast,
    lenient_timestamp,
    normalise_key,
    null_outside,
    typed_null,
)

__all__ = [
    "all_present",
    "any_null",
    "differs_null_safe",
    "event_date",
    "lenient_cast",
    "lenient_timestamp",
    "normalise_key",
    "null_outside",
    "typed_null",
]
