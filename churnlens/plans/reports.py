"""The report queries over the cleaned table.

Every grouped report is ``cells -> finish``: *cells* are the rows per key
combination with ``total_customers`` and ``churned_customers``; *finish*
keeps the wanted keys, adds labels and the rounded rate, and orders the rows.
The report filters are all on group keys, so they can run after grouping.

* Direct path (one statement, as a user runs it): cells are a ``groupBy``;
  Catalyst pushes the key filters below the aggregate into the scan.
* Combined path (the pipeline): an aggregation lattice.  ``report_cells`` is
  one scan with four groupings (each row is expanded four times, not nine,
  and combined map-side); each of the nine key sets is a slice of those few
  cells, rolled up where its root is finer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.functions.labels import (
    CHARGE_LABELS,
    COMPLAINT_LABELS,
    SATISFACTION_LABELS,
    SERVICE_CALL_LABELS,
    STATUS_CHURNED,
    STATUS_RETAINED,
    TECH_SUPPORT_LABELS,
    TENURE_LABELS,
    USAGE_LABELS,
    code_label,
    code_rank,
)
from churnlens.operators.bands import MISSING
from churnlens.operators.quality import (
    cleaned_check_aggs,
    cleaned_check_finish,
    distinct_count,
    null_count_aggs,
    null_counts,
)
from churnlens.operators.ordering import numbered
from churnlens.operators.quantiles import attach_scalars
from churnlens.operators.rates import guarded_rate, rate_expr
from churnlens.operators.stats import describe_aggs, describe_finish, describe_numeric, exact_medians

N, S = "total_customers", "churned_customers"
_OUT = [N, S, "churn_rate"]

# --- fixed values: the key sets of the grouped checks and reports -------------
CELL_SETS: dict[str, list[str]] = {
    "churn": ["churn"],
    "contract": ["contract"],
    "payment_method": ["payment_method"],
    "tenure_group": ["tenure_group"],
    "contract_payment": ["contract", "payment_method"],
    "tenure_satisfaction": ["tenure_group", "satisfaction_group"],
    "complaints_calls": ["complaint_group", "service_call_group"],
    "usage_support": ["usage_band", "has_tech_support"],
    "charge_contract": ["monthly_charge_band", "contract"],
}

#: The finest groupings that the nine sets are rolled up from.  They share no
#: column, and the bands bound all but the first, so a task's partial cells are
#: a few hundred; one grouping of all ten columns could have a million.
CELL_ROOTS: dict[str, list[str]] = {
    "offer": ["contract", "payment_method", "monthly_charge_band", "churn"],
    "stay": ["tenure_group", "satisfaction_group"],
    "contact": ["complaint_group", "service_call_group"],
    "usage": ["usage_band", "has_tech_support"],
}
_CELL_COLS = [c for keys in CELL_ROOTS.values() for c in keys]


# ---- cells ----------------------------------------------------------------
def rate_cells(df: DataFrame, keys: Sequence[str], target: str = "churn") -> DataFrame:
    """Rows and SUM(target) per key combination (partial aggregate, then shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(N), F.sum(target).cast("bigint").alias(S))


def _gid(keys: Sequence[str]) -> int:
    """``grouping_id()`` of a set: one bit per column that is not grouped."""
    width = len(_CELL_COLS)
    return sum(1 << (width - 1 - i) for i, c in enumerate(_CELL_COLS) if c not in keys)


def report_cells(cleaned: DataFrame, target: str = "churn") -> DataFrame:
    """The cells of the root groupings (their ``grouping_id`` as gid): one scan, one shuffle."""
    # the target is a key of a root, so it is summed as a column of its own
    rows = cleaned.select(*_CELL_COLS, F.col(target).alias("__target"))
    out = rows.groupingSets([[F.col(c) for c in keys] for keys in CELL_ROOTS.values()], *[F.col(c) for c in _CELL_COLS])
    return out.agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias(N), F.sum("__target").cast("bigint").alias(S))


def cells_of(all_cells: DataFrame, name: str) -> DataFrame:
    """The cells of one key set: those of its root, rolled up if the root is finer."""
    keys = CELL_SETS[name]
    root = next(columns for columns in CELL_ROOTS.values() if set(keys) <= set(columns))
    cells = all_cells.filter(F.col("gid") == _gid(root))
    if len(keys) < len(root):
        cells = cells.groupBy(*keys).agg(F.sum(N).alias(N), F.sum(S).alias(S))
    return cells.select(*keys, N, S)


# ---- finishes -----------------------------------------------------------
def _rate(dp: int | None) -> Column:
    return rate_expr(F.col(S), F.col(N), dp).alias("churn_rate")


def _ordered(rows: DataFrame, order: Sequence[Column], out: Sequence[Column | str], position: str | None) -> DataFrame:
    """``out`` columns of the grouped rows in ``order``; with ``position``
    also each row's place in that order, from 1."""
    if position is None:
        return rows.orderBy(*order).select(*out)
    return numbered(rows, order, position).select(position, *out).orderBy(position)


def finish_churn_summary(cells: DataFrame, dp: int = 4, position: str | None = None) -> DataFrame:
    label = F.when(F.col("churn") == 1, F.lit(STATUS_CHURNED)).otherwise(F.lit(STATUS_RETAINED))
    total = cells.agg(F.sum(N).alias("__total"))  # one row: a scalar subquery
    out = [label.alias("customer_status"), F.col(N).alias("customer_count"), rate_expr(F.col(N), F.col("__total"), dp).alias("percentage")]
    return _ordered(attach_scalars(cells, total), [F.asc_nulls_first("churn")], out, position)


def finish_counts(cells: DataFrame, key: str, position: str | None = None) -> DataFrame:
    return _ordered(cells, [F.desc(N), F.asc_nulls_first(key)], [key, F.col(N).alias("customer_count")], position)


def finish_rate_contract_payment(cells: DataFrame, dp: int = 4, position: str | None = None) -> DataFrame:
    """All contract x payment groups, NULL keys kept, highest rate first."""
    order = [F.desc("churn_rate"), F.asc_nulls_first("contract"), F.asc_nulls_first("payment_method")]
    return _ordered(cells.withColumn("churn_rate", _rate(dp)), order, ["contract", "payment_method", N, F.col(S).alias("total_churned"), "churn_rate"], position)


def _labelled(cells: DataFrame, keep: Column, order: Sequence[Column], keys: Sequence[Column], position: str | None) -> DataFrame:
    """A labelled report: wanted key combinations, business order, labels, counts and the 2-place rate."""
    return _ordered(cells.filter(keep).withColumn("churn_rate", _rate(2)), order, [*keys, *_OUT], position)


def finish_contract_payment_report(cells: DataFrame, position: str | None = None) -> DataFrame:
    keep = F.col("contract").isNotNull() & F.col("payment_method").isNotNull()
    order = [F.col("contract"), F.desc("churn_rate"), F.col("payment_method")]
    return _labelled(cells, keep, order, [F.col("contract").alias("contract_type"), F.col("payment_method")], position)


def finish_tenure_satisfaction(cells: DataFrame, position: str | None = None) -> DataFrame:
    keep = (F.col("tenure_group") != MISSING) & (F.col("satisfaction_group") != MISSING)
    order = [code_rank("tenure_group", TENURE_LABELS), code_rank("satisfaction_group", SATISFACTION_LABELS)]
    keys = [code_label("tenure_group", TENURE_LABELS).alias("tenure"), code_label("satisfaction_group", SATISFACTION_LABELS).alias("satisfaction")]
    return _labelled(cells, keep, order, keys, position)


def finish_complaints_calls(cells: DataFrame, position: str | None = None) -> DataFrame:
    keep = (F.col("complaint_group") != MISSING) & (F.col("service_call_group") != MISSING)
    order = [code_rank("complaint_group", COMPLAINT_LABELS), code_rank("service_call_group", SERVICE_CALL_LABELS)]
    keys = [code_label("complaint_group", COMPLAINT_LABELS).alias("complaints"), code_label("service_call_group", SERVICE_CALL_LABELS).alias("service_calls")]
    return _labelled(cells, keep, order, keys, position)


def finish_usage_support(cells: DataFrame, position: str | None = None) -> DataFrame:
    keep = (F.col("usage_band") != MISSING) & F.col("has_tech_support").isin(0, 1)
    order = [code_rank("usage_band", USAGE_LABELS), F.desc("has_tech_support")]
    keys = [code_label("usage_band", USAGE_LABELS).alias("internet_usage"), code_label("has_tech_support", TECH_SUPPORT_LABELS).alias("tech_support")]
    return _labelled(cells, keep, order, keys, position)


def finish_charge_contract(cells: DataFrame, position: str | None = None) -> DataFrame:
    keep = (F.col("monthly_charge_band") != MISSING) & F.col("contract").isNotNull()
    order = [code_rank("monthly_charge_band", CHARGE_LABELS), F.desc("churn_rate"), F.col("contract")]
    keys = [code_label("monthly_charge_band", CHARGE_LABELS).alias("charge_band"), F.col("contract").alias("contract_type")]
    return _labelled(cells, keep, order, keys, position)


def finish_mapreduce_rate(cells: DataFrame) -> DataFrame:
    """The unrounded, zero-guarded rate per contract x payment, NULL keys left out."""
    rows = cells.filter(F.col("contract").isNotNull() & F.col("payment_method").isNotNull())
    return rows.select("contract", "payment_method", N, F.col(S).alias("total_churned"), guarded_rate(F.col(S), F.col(N)).alias("churn_rate"))


# ---- direct statements ----------------------------------------------------
def churn_summary(cleaned: DataFrame, dp: int = 4, position: str | None = None) -> DataFrame:
    """Churned vs retained: count and percentage of all customers, by code."""
    return finish_churn_summary(rate_cells(cleaned, ["churn"]), dp, position)


def category_counts(cleaned: DataFrame, col: str, position: str | None = None) -> DataFrame:
    return finish_counts(rate_cells(cleaned, [col]), col, position)


def rate_contract_payment(cleaned: DataFrame, dp: int = 4, position: str | None = None) -> DataFrame:
    return finish_rate_contract_payment(rate_cells(cleaned, CELL_SETS["contract_payment"]), dp, position)


def rate_contract_payment_report(cleaned: DataFrame, position: str | None = None) -> DataFrame:
    return finish_contract_payment_report(rate_cells(cleaned, CELL_SETS["contract_payment"]), position)


def rate_tenure_satisfaction(cleaned: DataFrame, position: str | None = None) -> DataFrame:
    return finish_tenure_satisfaction(rate_cells(cleaned, CELL_SETS["tenure_satisfaction"]), position)


def rate_complaints_calls(cleaned: DataFrame, position: str | None = None) -> DataFrame:
    return finish_complaints_calls(rate_cells(cleaned, CELL_SETS["complaints_calls"]), position)


def rate_usage_support(cleaned: DataFrame, position: str | None = None) -> DataFrame:
    return finish_usage_support(rate_cells(cleaned, CELL_SETS["usage_support"]), position)


def rate_charge_contract(cleaned: DataFrame, position: str | None = None) -> DataFrame:
    return finish_charge_contract(rate_cells(cleaned, CELL_SETS["charge_contract"]), position)


# --- fixed values: the statistics and NULL checks of the cleaned table -------
STATS_SPEC = [
    ("tenure", "tenure", ["mean", "median", "min", "max", "stddev"]),
    ("monthlycharges", "monthlycharges", ["mean", "median", "min", "max", "stddev"]),
    ("totalcharges", "totalcharges", ["mean", "median", "min", "max"]),
    ("customer_satisfaction", "satisfaction", ["mean", "median"]),
]
CLEANED_NULLS = {
    "missing_tenure": "tenure",
    "missing_contract": "contract",
    "missing_payment_method": "payment_method",
    "missing_monthlycharges": "monthlycharges",
    "missing_totalcharges": "totalcharges",
    "missing_satisfaction": "customer_satisfaction",
    "missing_complaints": "num_complaints",
    "missing_usage": "avg_monthly_gb",
}


def descriptive_stats(cleaned: DataFrame) -> DataFrame:
    return describe_numeric(cleaned, STATS_SPEC)


def cleaned_nulls(cleaned: DataFrame) -> DataFrame:
    return null_counts(cleaned, CLEANED_NULLS)


def summary_tables(cleaned: DataFrame, store) -> dict[str, DataFrame]:
    """The cleaned check, NULL counts and statistics from one global aggregate.

    ``store(df, name)`` writes the one-row result once.  The distinct count is
    a query of its own over the one key column, attached as a scalar, so the
    aggregate's many buffers aren't shuffled per customer; the exact medians
    (a few small passes) are attached as literals.
    """
    stat_aggs, stat_names = describe_aggs(STATS_SPEC)
    sums = cleaned.agg(*cleaned_check_aggs(), *null_count_aggs(CLEANED_NULLS), *stat_aggs)
    row = store(attach_scalars(sums, distinct_count(cleaned, "customer_id", "distinct_customer_ids")), "cleaned_summary")
    return {
        "cleaned_check": cleaned_check_finish(row),
        "cleaned_nulls": row.select(*CLEANED_NULLS),
        "describe_numeric": describe_finish(row, stat_names, exact_medians(cleaned, STATS_SPEC)),
    }


# ---- combined path ------------------------------------------------------
def grouped_tables(all_cells: DataFrame) -> dict[str, DataFrame]:
    """Every grouped check and report as a slice of ``report_cells``."""
    c = lambda name: cells_of(all_cells, name)
    return {
        "churn_summary": finish_churn_summary(c("churn"), 4),
        "churn_distribution": finish_churn_summary(c("churn"), 2),
        "freq_contract": finish_counts(c("contract"), "contract"),
        "freq_payment": finish_counts(c("payment_method"), "payment_method"),
        "freq_tenure_group": finish_counts(c("tenure_group"), "tenure_group"),
        "rate_contract_payment": finish_rate_contract_payment(c("contract_payment"), 4),
        "contract_payment": finish_contract_payment_report(c("contract_payment")),
        "tenure_satisfaction": finish_tenure_satisfaction(c("tenure_satisfaction")),
        "complaints_calls": finish_complaints_calls(c("complaints_calls")),
        "usage_support": finish_usage_support(c("usage_support")),
        "charge_contract": finish_charge_contract(c("charge_contract")),
        "mapreduce_rate": finish_mapreduce_rate(c("contract_payment")),
    }
