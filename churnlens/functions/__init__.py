"""Column expressions shared by the operators (no Python UDFs)."""

from churnlens.functions.typing_rules import (
    blank_to_null,
    flag01,
    int_in,
    is_blank,
    nonneg_double,
    norm_text,
    strict_date,
    to_double,
    to_int,
)
from churnlens.functions.labels import code_label, code_rank

__all__ = [
    "blank_to_null",
    "code_label",
    "code_rank",
    "flag01",
    "int_in",
    "is_blank",
    "nonneg_double",
    "norm_text",
    "strict_date",
    "to_double",
    "to_int",
]
