from .constraints import Constraints, enforce, violations
from .history import as_of_join, open_end_ts, point_in_time_join, scd2_apply, scd2_from_extracts, scd2_pending_changes
from .keyed import (
    DuplicateKeyError,
    assert_unique,
    changed_count,
    classify_changes,
    duplicate_keys,
    latest_revision,
    merge_rows,
)
from .proximity import nearest_k
from .quality import (
    ConstraintError,
    EmptyBatchError,
    RequiredFieldError,
    key_violations,
    null_violations,
    range_violations,
    require_fields,
    require_non_empty,
    set_violations,
    with_defaults,
)
from .reshape import melt_wide, pivot_long

__all__ = [
    "Constraints",
    "enforce",
    "violations",
    "as_of_join",
    "ConstraintError",
    "DuplicateKeyError",
    "EmptyBatchError",
    "RequiredFieldError",
    "assert_unique",
    "changed_count",
    "classify_changes",
    "duplicate_keys",
    "key_violations",
    "latest_revision",
    "melt_wide",
    "merge_rows",
    "nearest_k",
    "null_violations",
    "open_end_ts",
    "pivot_long",
    "point_in_time_join",
    "range_violations",
    "require_fields",
    "require_non_empty",
    "scd2_apply",
    "scd2_from_extracts",
    "scd2_pending_changes",
    "set_violations",
    "with_defaults",
]
