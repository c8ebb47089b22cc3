"""Raw text rows -> typed rows (32 rules, two narrow projections, no shuffle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.functions.typing_rules import (
    blank_to_null,
    finite_nonneg,
    flag01,
    norm_text,
    strict_date,
    to_decimal,
    to_int,
    within,
)
from churnlens.schema import COLUMNS, FLAG_COLUMNS

# --- fixed values: the per-column typing contract ---------------------------
#: smallest and largest value of the integers
INT_RANGES: dict[str, tuple[int, int | None]] = {
    "age": (0, 120),
    "dependents": (0, None),
    "tenure": (0, None),
    "num_services": (0, None),
    "customer_satisfaction": (1, 5),
    "num_complaints": (0, None),
    "num_service_calls": (0, None),
    "late_payments": (0, None),
    "days_since_last_interaction": (0, None),
    "credit_score": (0, 1000),
}
#: finite, not below zero
AMOUNTS = ["annual_income", "monthlycharges", "totalcharges", "avg_monthly_gb"]
#: text to value
RULES: dict[str, Callable[[str], Column]] = {
    "customer_id": blank_to_null,
    "signup_date": strict_date,
    **{c: norm_text for c in ("gender", "education", "marital_status", "contract", "payment_method")},
    **{c: to_int for c in INT_RANGES},
    **{c: to_decimal for c in AMOUNTS},
    **{c: flag01 for c in FLAG_COLUMNS},
}


def _kept(c: str) -> Column:
    if c in INT_RANGES:
        return within(F.col(c), *INT_RANGES[c])
    return finite_nonneg(F.col(c)) if c in AMOUNTS else F.col(c)


def type_rows(raw: DataFrame, passthrough: list[str] | None = None) -> DataFrame:
    """Apply every column's typing rule; extra columns (e.g. a row key) pass through.

    Texts are parsed in one projection and ranges checked in the next, which
    Spark keeps apart because a range names its value more than once.
    """
    keep = [c for c in (passthrough or []) if c in raw.columns]
    values = raw.select(*[RULES[c](c).alias(c) for c in COLUMNS], *keep)
    return values.select(*[_kept(c).alias(c) for c in COLUMNS], *keep)
