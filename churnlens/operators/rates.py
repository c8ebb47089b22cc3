"""Grouped attrition rates and shares of a total.

``groupBy(keys).agg(count, sum)`` is planned as partial aggregate -> hash
exchange on the keys -> final aggregate: the per-task partial is the
combiner, the exchange is the shuffle, the final aggregate is the reducer.
A key holding a third of all rows is one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rate_expr(num: Column, den: Column, dp: int | None) -> Column:
    """num * 100 / den as DOUBLE, rounded to ``dp`` places when given."""
    r = num.cast("double") * F.lit(100.0) / den.cast("double")
    return F.round(r, dp) if dp is not None else r


def map_emit(df: DataFrame, keys: Sequence[str], target: str = "churn") -> DataFrame:
    """Map step: valid records only, emitted as key -> (1, target)."""
    cond = F.col(target).isin(0, 1)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond).select(*keys, F.lit(1).alias("n"), _c(target).alias("c"))


def reduce_rate(
    emitted: DataFrame,
    keys: Sequence[str],
    count_name: str = "total_customers",
    sum_name: str = "total_churned",
    rate_name: str = "churn_rate",
) -> DataFrame:
    """Combine + shuffle + reduce: totals and an unrounded, zero-guarded rate."""
    agg = emitted.groupBy(*keys).agg(
        F.sum("n").cast("bigint").alias(count_name), F.sum("c").cast("bigint").alias(sum_name)
    )
    return agg.select(*keys, count_name, sum_name, guarded_rate(F.col(sum_name), F.col(count_name)).alias(rate_name))


def guarded_rate(num: Column, den: Column) -> Column:
    """num / den * 100, unrounded, 0 for an empty group."""
    return F.when(den > 0, num.cast("double") / den.cast("double") * F.lit(100.0)).otherwise(F.lit(0.0))


def mapreduce_rate(df: DataFrame, keys: Sequence[str] = ("contract", "payment_method"), target: str = "churn") -> DataFrame:
    return reduce_rate(map_emit(df, list(keys), target), list(keys))
