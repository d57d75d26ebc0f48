"""DataFrame operators of the layers."""

from terrace.operators.changes import row_changes, row_digest, row_history, rows_as_of
from terrace.operators.cleanse import (
    cast_cols,
    drop_null_key,
    enforce_schema,
    extra_columns,
    hash_col,
    invalid_postal,
    lower_cols,
    missing_all,
    parse_coords,
    project,
    require_any,
    stamp,
)
from terrace.operators.dedupe import duplicate_keys, latest_per_key, upsert
from terrace.operators.drift import DriftRule, with_bounds
from terrace.operators.postal import breaks_pattern, invalid_postal_by_table, pattern_table, with_postal_pattern
from terrace.operators.profile import column_sketches, merged_sketches, profile_of
from terrace.operators.quality import (
    QualityGateError,
    check_gate,
    entity_rules,
    gate,
    quality_metrics,
    reconcile,
    reconcile_keys,
    reconcile_rule,
    require_known,
)
from terrace.operators.ranking import number_rows, percent_of_group, top_n, with_group_total
from terrace.operators.rollup import rollup_count, signed_changes, sum_by

__all__ = [
    "DriftRule",
    "QualityGateError",
    "breaks_pattern",
    "cast_cols",
    "check_gate",
    "column_sketches",
    "drop_null_key",
    "duplicate_keys",
    "enforce_schema",
    "entity_rules",
    "extra_columns",
    "gate",
    "hash_col",
    "invalid_postal",
    "invalid_postal_by_table",
    "latest_per_key",
    "lower_cols",
    "merged_sketches",
    "missing_all",
    "number_rows",
    "parse_coords",
    "pattern_table",
    "percent_of_group",
    "profile_of",
    "project",
    "quality_metrics",
    "reconcile",
    "reconcile_keys",
    "reconcile_rule",
    "require_any",
    "require_known",
    "rollup_count",
    "row_changes",
    "row_digest",
    "row_history",
    "rows_as_of",
    "signed_changes",
    "stamp",
    "sum_by",
    "top_n",
    "upsert",
    "with_bounds",
    "with_group_total",
    "with_postal_pattern",
]
