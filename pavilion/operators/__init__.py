"""Table operators: each takes DataFrames and column names and returns a DataFrame."""
from pavilion.operators.dedup import keep_one
from pavilion.operators.distribution import density, histogram, non_finite_counts
from pavilion.operators.filters import drop_empty_rows, require_keys, rows_where_zero
from pavilion.operators.groups import (
    distinct_values, group_count, group_mean, group_stats, group_sum, totals_by_column, value_counts,
)
from pavilion.operators.lookup import joined_mean, lookup_codes, lookup_left, mean_of_group_sums
from pavilion.operators.ranking import best_per_group, ranked
from pavilion.operators.running import running_total

__all__ = [
    "best_per_group", "density", "distinct_values", "drop_empty_rows", "group_count", "group_mean",
    "group_stats", "group_sum", "histogram", "joined_mean", "keep_one", "lookup_codes", "lookup_left",
    "mean_of_group_sums", "non_finite_counts", "ranked", "require_keys", "rows_where_zero", "running_total",
    "totals_by_column", "value_counts",
]
