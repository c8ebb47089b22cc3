"""Column-level conversion rules: raw text in, typed value or NULL out.

Every rule is a plain Spark expression (trim, lower, rlike, try_cast).  A value
that does not convert becomes NULL; nothing raises, even with ANSI mode on.
A number's rule has two steps, text to value (``to_int``, ``to_decimal``) and a
range over the value (``within``).  The range names its value several times, so
a wide table takes them in two projections: each text is then parsed once.

Semantics pinned here, identically for every engine the results are checked
against:

* "missing" text is NULL or empty after trimming spaces (tabs are kept);
* integers accept an optional sign, digits and an optional fraction, which is
  truncated toward zero (``'12.7'`` -> 12); overflow gives NULL;
* doubles accept plain or scientific decimal notation only, so ``NaN``,
  ``Infinity`` and ``12f`` give NULL, and an overflowing exponent gives NULL;
* dates must look like ``yyyy-MM-dd`` and be a real calendar day;
* flags take a small case-blind vocabulary, anything else is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: accepted spellings ---------------------------------------
TRUE_WORDS = ["1", "yes", "y", "true"]
FALSE_WORDS = ["0", "no", "n", "false"]
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
# numeric gates (own choice: one answer across Spark, DuckDB and Hive)
INT_PATTERN = r"^[+-]?[0-9]+([.][0-9]*)?$"
DOUBLE_PATTERN = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_blank(col: str | Column) -> Column:
    """NULL, or empty once spaces are trimmed."""
    c = _c(col)
    return c.isNull() | (F.trim(c) == "")


def blank_to_null(col: str | Column) -> Column:
    """Trimmed text, case kept; blank becomes NULL."""
    c = _c(col)
    return F.when(~is_blank(c), F.trim(c))


def norm_text(col: str | Column) -> Column:
    """Trimmed lower-case text; blank becomes NULL."""
    c = _c(col)
    return F.when(~is_blank(c), F.lower(F.trim(c)))


def to_int(col: str | Column) -> Column:
    """Text to INT, truncating a fraction; anything else NULL."""
    t = F.trim(_c(col))
    whole = F.substring_index(t, ".", 1)  # text before the first '.', no array built
    return F.when(t.rlike(INT_PATTERN), whole.try_cast("int"))


def within(v: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """A value kept only inside ``[lo, hi]`` (either side may be open)."""
    if lo is not None and hi is not None:
        return F.when(v.between(lo, hi), v)
    if lo is not None:
        return F.when(v >= lo, v)
    if hi is not None:
        return F.when(v <= hi, v)
    return v


def finite_nonneg(v: Column) -> Column:
    return F.when((v >= 0) & (v < F.lit(float("inf"))), v)


def int_in(col: str | Column, lo: int | None = None, hi: int | None = None) -> Column:
    """INT kept only inside ``[lo, hi]`` (either side may be open)."""
    return within(to_int(col), lo, hi)


def to_decimal(col: str | Column) -> Column:
    """Text in decimal notation to DOUBLE, infinite beyond its range; anything else NULL."""
    t = F.trim(_c(col))
    return F.when(t.rlike(DOUBLE_PATTERN), t.try_cast("double"))


def to_double(col: str | Column) -> Column:
    """Text in decimal notation to DOUBLE; anything else NULL."""
    v = to_decimal(col)
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def nonneg_double(col: str | Column) -> Column:
    return finite_nonneg(to_decimal(col))


def strict_date(col: str | Column) -> Column:
    """``yyyy-MM-dd`` text that names a real day, else NULL."""
    t = F.trim(_c(col))
    return F.when(t.rlike(DATE_PATTERN), t.try_cast("date"))


def flag01(col: str | Column) -> Column:
    """Flag vocabulary to 1 / 0 / NULL."""
    w = F.lower(F.trim(_c(col)))
    return F.when(w.isin(TRUE_WORDS), F.lit(1)).when(w.isin(FALSE_WORDS), F.lit(0))
