"""Range and threshold bucketers.

A bucketer is a CASE expression: NULL input -> ``missing`` first, then
inclusive ranges tried in order, then the last label.  Threshold bands compare
with ``<=`` against an array of cut points; when a cut point is NULL the
comparison is not true, so a non-NULL value falls through to the last band.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "missing"

# --- fixed values: band edges (inclusive) and names -------------------------
TENURE_BANDS = [((0, 12), "0-12_months"), ((13, 24), "13-24_months"), ((25, 48), "25-48_months")]
TENURE_REST = "49+_months"
SATISFACTION_BANDS = [((1, 2), "low"), ((3, 3), "moderate")]
SATISFACTION_REST = "high"
COMPLAINT_BANDS = [((0, 0), "none"), ((1, 1), "one"), ((2, 3), "two_to_three")]
COMPLAINT_REST = "more_than_three"
CALL_BANDS = [((0, 0), "none"), ((1, 2), "one_to_two"), ((3, 5), "three_to_five")]
CALL_REST = "more_than_five"
RECENCY_BANDS = [((0, 30), "0-30_days"), ((31, 60), "31-60_days"), ((61, 90), "61-90_days")]
RECENCY_REST = "91+_days"
THRESHOLD_LABELS = ["low", "medium", "high"]
NO_INTERNET = "no_internet"
CHARGE_PROBS = [0.3333, 0.6667]


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def range_band(col: str | Column, bands: Sequence[tuple[tuple[int, int], str]], rest: str) -> Column:
    """missing / first matching inclusive range / ``rest``."""
    c = _c(col)
    out = F.when(c.isNull(), F.lit(MISSING))
    for (lo, hi), label in bands:
        out = out.when(c.between(lo, hi), F.lit(label))
    return out.otherwise(F.lit(rest))


def _cut(thresholds: Column | Sequence[float | None], i: int) -> Column:
    if isinstance(thresholds, Column):
        return F.get(thresholds, i)  # NULL when absent instead of an ANSI error
    return F.lit(thresholds[i]).cast("double")


def threshold_band(
    col: str | Column,
    thresholds: Column | Sequence[float | None],
    labels: Sequence[str] = THRESHOLD_LABELS,
    first: Sequence[tuple[Column, str]] = (),
) -> Column:
    """``first`` overrides, then missing, then ``x <= cut[i]`` per label, then the last label.

    ``thresholds`` is an array column (from a one-row frame) or literal cut
    points; literals are folded into the projection, so no join is needed.
    """
    c = _c(col)
    out = None
    for cond, label in first:
        out = (F.when if out is None else out.when)(cond, F.lit(label))
    out = (F.when if out is None else out.when)(c.isNull(), F.lit(MISSING))
    for i, label in enumerate(labels[:-1]):
        out = out.when(c <= _cut(thresholds, i), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def fill_when(col: str | Column, cond: Column, value: object) -> Column:
    """``value`` where ``cond`` holds and the column is NULL, else the column."""
    c = _c(col)
    return F.when(cond & c.isNull(), F.lit(value)).otherwise(c)


def tenure_group(col: str | Column = "tenure") -> Column:
    return range_band(col, TENURE_BANDS, TENURE_REST)


def satisfaction_group(col: str | Column = "customer_satisfaction") -> Column:
    return range_band(col, SATISFACTION_BANDS, SATISFACTION_REST)


def complaint_group(col: str | Column = "num_complaints") -> Column:
    return range_band(col, COMPLAINT_BANDS, COMPLAINT_REST)


def service_call_group(col: str | Column = "num_service_calls") -> Column:
    return range_band(col, CALL_BANDS, CALL_REST)


def late_payment_group(col: str | Column = "late_payments") -> Column:
    return range_band(col, CALL_BANDS, CALL_REST)


def interaction_recency_group(col: str | Column = "days_since_last_interaction") -> Column:
    return range_band(col, RECENCY_BANDS, RECENCY_REST)


def monthly_charge_band(thresholds: Column | Sequence[float | None], col: str | Column = "monthlycharges") -> Column:
    return threshold_band(col, thresholds)


def usage_band(
    thresholds: Column | Sequence[float | None],
    col: str | Column = "avg_monthly_gb",
    internet: str | Column = "has_internet_service",
) -> Column:
    """``no_internet`` wins over ``missing``; unknown internet is still banded."""
    return threshold_band(col, thresholds, first=[(_c(internet) == 0, NO_INTERNET)])
