"""Typed rows -> cleaned rows: filter, latest per customer, thresholds, bands.

Plan: ``Filter -> WindowGroupLimit(partial) -> Exchange(customer_id) ->
WindowGroupLimit(final) -> Window -> Filter`` for the de-duplication, written
once; then a few global aggregates over that written table for the exact
thresholds; then one narrow projection that adds the eight groups with the
thresholds folded in as literals (no join, no second shuffle).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.operators import bands
from churnlens.operators.dedupe import latest_per_key, valid_target_rows
from churnlens.operators.quantiles import attach_scalars, exact_quantiles, quantile_thresholds
from churnlens.schema import CLEANED_COLUMNS, COLUMNS, ROW_ID

CHARGE = "charge_percentiles"
USAGE = "usage_percentiles"


def deduplicate(typed: DataFrame, key: str = "customer_id", target: str = "churn") -> DataFrame:
    """Valid rows only, newest ``signup_date`` per key (NULL dates last).

    Ties break on the row key when the input carries one, else on all columns.
    """
    valid = valid_target_rows(typed, key, target)
    tiebreak = [ROW_ID] if ROW_ID in typed.columns else None
    out = latest_per_key(valid, key, {"signup_date": F.col("signup_date").desc_nulls_last()}, tiebreak)
    return out.select(*COLUMNS)


def threshold_specs(df: DataFrame) -> dict[str, tuple[Column, list[float]]]:
    """Charge cut points over all rows; usage cut points over internet users only."""
    usage = F.when(F.col("has_internet_service") == 1, F.col("avg_monthly_gb"))
    return {
        CHARGE: (F.col("monthlycharges"), bands.CHARGE_PROBS),
        USAGE: (usage, bands.CHARGE_PROBS),
    }


def add_groups(
    dedup: DataFrame,
    charge_cuts: Column | list[float | None],
    usage_cuts: Column | list[float | None],
) -> DataFrame:
    """The 40 cleaned columns: usage filled for non-internet rows, eight groups."""
    filled = bands.fill_when("avg_monthly_gb", F.col("has_internet_service") == 0, 0.0)
    groups = {
        "tenure_group": bands.tenure_group(),
        "satisfaction_group": bands.satisfaction_group(),
        "complaint_group": bands.complaint_group(),
        "service_call_group": bands.service_call_group(),
        "late_payment_group": bands.late_payment_group(),
        "interaction_recency_group": bands.interaction_recency_group(),
        "monthly_charge_band": bands.monthly_charge_band(charge_cuts),
        # banded on the value before the fill; no_internet wins either way
        "usage_band": bands.usage_band(usage_cuts),
    }
    cols = [filled.alias(c) if c == "avg_monthly_gb" else F.col(c) for c in COLUMNS]
    return dedup.select(*cols, *[groups[g].alias(g) for g in CLEANED_COLUMNS[len(COLUMNS):]])


def clean(
    typed: DataFrame,
    method: str = "exact",
    accuracy: int | None = None,
    materialize: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Compose the cleaning steps.

    ``materialize(df, name)`` stores the de-duplicated rows once (they are
    read by every threshold pass and by the final projection); without it
    Spark would recompute the window shuffle for each read.
    """
    dedup = deduplicate(typed)
    if materialize is not None:
        dedup = materialize(dedup, "deduplicated")
    specs = threshold_specs(dedup)
    if method == "exact":
        cuts = exact_quantiles(dedup, specs)
        return add_groups(dedup, cuts[CHARGE], cuts[USAGE])
    th = quantile_thresholds(dedup, specs, method=method, accuracy=accuracy)
    joined = attach_scalars(dedup, th)
    return add_groups(joined, F.col(CHARGE), F.col(USAGE)).select(*CLEANED_COLUMNS)
