"""Code -> display label and code -> business sort rank.

A label map has no default: an unknown code gives a NULL label.  A rank map
puts unknown codes after all known ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: report labels, in business order -------------------------
TENURE_LABELS = [
    ("0-12_months", "0-12 months"),
    ("13-24_months", "13-24 months"),
    ("25-48_months", "25-48 months"),
    ("49+_months", "49+ months"),
]
SATISFACTION_LABELS = [
    ("low", "Low (1-2)"),
    ("moderate", "Moderate (3)"),
    ("high", "High (4-5)"),
]
COMPLAINT_LABELS = [
    ("none", "No complaints"),
    ("one", "1 complaint"),
    ("two_to_three", "2-3 complaints"),
    ("more_than_three", "More than 3"),
]
SERVICE_CALL_LABELS = [
    ("none", "No calls"),
    ("one_to_two", "1-2 calls"),
    ("three_to_five", "3-5 calls"),
    ("more_than_five", "More than 5"),
]
USAGE_LABELS = [
    ("no_internet", "No internet"),
    ("low", "Low usage"),
    ("medium", "Medium usage"),
    ("high", "High usage"),
]
TECH_SUPPORT_LABELS = [
    (1, "Has Tech Support"),
    (0, "No Tech Support"),
]
CHARGE_LABELS = [
    ("low", "Low charges"),
    ("medium", "Medium charges"),
    ("high", "High charges"),
]
STATUS_CHURNED = "Churned"
STATUS_RETAINED = "Retained"


def code_label(col: str | Column, pairs: Sequence[tuple[object, str]]) -> Column:
    """CASE code WHEN .. THEN label .. END, with no ELSE."""
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for code, label in pairs:
        out = (F.when if out is None else out.when)(c == F.lit(code), F.lit(label))
    return out


def code_rank(col: str | Column, pairs: Sequence[tuple[object, str]]) -> Column:
    """1-based position of the code in ``pairs``; unknown codes rank last."""
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for i, (code, _label) in enumerate(pairs, start=1):
        out = (F.when if out is None else out.when)(c == F.lit(code), F.lit(i))
    return out.otherwise(F.lit(len(pairs) + 1))
