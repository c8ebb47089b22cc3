"""Descriptive statistics in one global aggregate.

Mean, min, max and population standard deviation are algebraic aggregates
(partial per task, merged once).  Medians are exact discrete medians by
default (all of them found together by ``exact_quantiles``: a few narrow
passes, bounded memory), so they are deterministic and do not depend on how
rows are partitioned; ``median="approx"`` uses ``percentile_approx`` at ``accuracy``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.operators.quantiles import DEFAULT_ACCURACY, exact_quantiles

# --- fixed values: statistic name prefixes ----------------------------------
STAT_NAMES = {
    "mean": "mean",
    "median": "median",
    "min": "minimum",
    "max": "maximum",
    "stddev": "stddev",
}


Spec = Sequence[tuple[str, str, Sequence[str]]]


def describe_aggs(columns: Spec, dp: int = 2, accuracy: int = DEFAULT_ACCURACY,
                  count_name: str | None = "record_count", approx_median: bool = False) -> tuple[list[Column], list[str]]:
    """Aggregate expressions and output names; exact medians are left out
    (they are computed separately) unless ``approx_median``."""
    aggs = [F.count(F.lit(1)).alias(count_name)] if count_name else []
    names = [count_name] if count_name else []
    for col, label, stats in columns:
        c = F.col(col)
        for s in stats:
            name = f"{STAT_NAMES[s]}_{label}"
            names.append(name)
            if s == "mean":
                aggs.append(F.round(F.avg(c), dp).alias(name))
            elif s == "median":
                if approx_median:
                    aggs.append(F.percentile_approx(c.cast("double"), 0.5, accuracy).alias(name))
            elif s == "min":
                aggs.append(F.min(c).alias(name))
            elif s == "max":
                aggs.append(F.max(c).alias(name))
            elif s == "stddev":
                aggs.append(F.round(F.stddev_pop(c), dp).alias(name))
            else:
                raise ValueError(f"unknown statistic {s!r}")
    return aggs, names


def exact_medians(df: DataFrame, columns: Spec) -> dict[str, float | None]:
    specs = {f"{STAT_NAMES['median']}_{label}": (F.col(col), [0.5]) for col, label, st in columns if "median" in st}
    if not specs:
        return {}
    return {k: v[0] for k, v in exact_quantiles(df, specs).items()}


def describe_finish(agg: DataFrame, names: list[str], medians: dict[str, float | None]) -> DataFrame:
    return agg.select(*[F.lit(medians[n]).cast("double").alias(n) if n in medians else F.col(n) for n in names])


def describe_numeric(
    df: DataFrame,
    columns: Spec,
    dp: int = 2,
    accuracy: int = DEFAULT_ACCURACY,
    count_name: str | None = "record_count",
    median: str = "exact",
) -> DataFrame:
    """``columns`` is a list of (column, label, stats) with stats from
    ``mean median min max stddev``; output columns are ``<stat>_<label>``."""
    if median not in ("exact", "approx"):
        raise ValueError(f"unknown median method {median!r}")
    medians = exact_medians(df, columns) if median == "exact" else {}
    aggs, names = describe_aggs(columns, dp, accuracy, count_name, approx_median=median == "approx")
    return describe_finish(df.agg(*aggs), names, medians)
