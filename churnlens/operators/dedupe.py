"""Keep the latest record per key.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ...) = 1``.  Spark plans the
rank-1 filter as a ``WindowGroupLimit``: a partial limit runs in every map
task *before* the shuffle, so a key that holds a third of all rows still
ships at most one row per map task.  Rows whose key is NULL or whose target
is not 0/1 are filtered first, which also removes the NULL-key hot spot.

The ordering always ends in a total tie-break (a row key; else the columns that
aren't ordered by already), so the kept row does not depend on partitioning or
on task retries.  The columns are compared one after the other and only for
rows that tie on all before, which is cheaper than hashing every row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__row_rank"


def valid_target_rows(df: DataFrame, key: str, target: str, values: Sequence[int] = (0, 1)) -> DataFrame:
    """Rows with a key and a usable target (applied before ranking)."""
    return df.filter(F.col(key).isNotNull() & F.col(target).isin(list(values)))


def latest_per_key(
    df: DataFrame,
    key: str,
    order: Mapping[str, Column],
    tiebreak: Sequence[str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """First row per ``key`` under ``order`` (column name -> ordering) then ``tiebreak`` (descending).

    ``tiebreak=None`` orders by all columns that ``order`` and the key leave.
    """
    last = [F.col(c).desc_nulls_last() for c in (tiebreak or [c for c in df.columns if c != key and c not in order])]
    w = Window.partitionBy(key).orderBy(*order.values(), *last)
    out = df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1)
    return out.drop(_RANK, *drop)
