"""Reusable DataFrame operators (column names and options in, frames out)."""

from churnlens.operators.bands import (
    complaint_group,
    fill_when,
    interaction_recency_group,
    late_payment_group,
    monthly_charge_band,
    range_band,
    satisfaction_group,
    service_call_group,
    tenure_group,
    threshold_band,
    usage_band,
)
from churnlens.operators.dedupe import latest_per_key, valid_target_rows
from churnlens.operators.quality import (
    cleaned_check,
    duplicate_keys,
    invalid_rows,
    key_uniqueness,
    missing_report,
    null_counts,
    preview,
    row_count,
    value_frequencies,
)
from churnlens.operators.quantiles import (
    attach_scalars,
    exact_quantiles,
    quantile_thresholds,
)
from churnlens.operators.rates import (
    map_emit,
    mapreduce_rate,
    reduce_rate,
)
from churnlens.operators.stats import describe_numeric
from churnlens.operators.typing import type_rows

__all__ = [
    "attach_scalars",
    "cleaned_check",
    "complaint_group",
    "describe_numeric",
    "duplicate_keys",
    "exact_quantiles",
    "fill_when",
    "interaction_recency_group",
    "invalid_rows",
    "key_uniqueness",
    "late_payment_group",
    "latest_per_key",
    "map_emit",
    "mapreduce_rate",
    "missing_report",
    "monthly_charge_band",
    "null_counts",
    "preview",
    "quantile_thresholds",
    "range_band",
    "reduce_rate",
    "row_count",
    "satisfaction_group",
    "service_call_group",
    "tenure_group",
    "threshold_band",
    "type_rows",
    "usage_band",
    "valid_target_rows",
    "value_frequencies",
]
