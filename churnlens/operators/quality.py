"""Profiling and data-quality checks.

All checks are aggregates with map-side partial aggregation: a hot key or a
hot category collapses to one partial row per task before any shuffle, so a
value holding a third of the rows costs no more than any other.  Multi-field
checks are computed in a single scan (conditional sums) and reshaped
afterwards, instead of one scan per field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.functions.typing_rules import is_blank
from churnlens.operators.quantiles import attach_scalars


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as BIGINT (0 on empty input is NULL, like SQL)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def preview(df: DataFrame, n: int = 10, order: Sequence[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows; with ``order`` the pick is deterministic (a top-k)."""
    if order:
        return df.orderBy(*order).limit(n)
    return df.limit(n)


def distinct_count(df: DataFrame, key: str | Column, name: str) -> DataFrame:
    """Number of distinct non-NULL keys: only the key column is shuffled."""
    k = df.select(_c(key).alias("__key")).filter(F.col("__key").isNotNull())
    return k.distinct().agg(F.count(F.lit(1)).alias(name))


def key_uniqueness_finish(one_row: DataFrame, total: str, distinct: str, dupes: str) -> DataFrame:
    return one_row.select(total, distinct, (F.col(total) - F.col(distinct)).alias(dupes))


def key_uniqueness(
    df: DataFrame,
    key: str | Column,
    total: str = "total_rows",
    distinct: str = "distinct_customer_ids",
    dupes: str = "duplicate_customer_id_rows",
) -> DataFrame:
    """Rows, distinct keys, and rows beyond the first per key."""
    both = attach_scalars(row_count(df, total), distinct_count(df, key, distinct))
    return key_uniqueness_finish(both, total, distinct, dupes)


#: Bits of the filter's hash: 2^22 counters are at most 48 MB of a task's partial rows, and 512 KB as a bitmap.
FILTER_BITS = 22


def repeated_only(df: DataFrame, key: Column, bits: int = FILTER_BITS) -> DataFrame:
    """``df`` without rows whose key can't be there twice, by one pass over hashed keys.

    Keys are hashed to 2^bits counters, which tasks add up by themselves before
    they exchange (counter, rows).  The counters of two or more rows become
    bitmaps (2^bits / 8 bytes altogether, whatever the input's size), which
    every task looks its rows up in.  No repeated key is ever left out; a
    single one stays when it shares its counter.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    slots = df.select(slot.alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    word, at = F.bitmap_bucket_number("slot"), F.bitmap_bit_position("slot")
    maps = slots.groupBy(word.alias("__map")).agg(F.bitmap_construct_agg(at).alias("__bits"))
    rows = df.withColumn("__slot", slot).withColumn("__word", F.bitmap_bucket_number("__slot"))
    at = F.bitmap_bit_position("__slot")
    byte = F.call_function("substring", F.col("__bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))
    repeated = F.call_function("getbit", F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1
    return rows.join(F.broadcast(maps), F.col("__word") == F.col("__map")).where(repeated).select(*df.columns)


def duplicate_keys(
    df: DataFrame,
    key: str,
    limit: int | None = 100,
    key_expr: Column | None = None,
    count_name: str = "occurrence_count",
    filter_bits: int | None = None,
) -> DataFrame:
    """Keys seen more than once, most frequent first (ties by key), top ``limit``.

    With ``filter_bits`` keys that can't be repeated are left out before the
    keys themselves are exchanged (``repeated_only``): right for wide keys that
    are mostly single.
    """
    k = key_expr if key_expr is not None else F.col(key)
    keys = df.filter(~is_blank(F.col(key))).select(k.alias(key))
    out = (
        (repeated_only(keys, F.col(key), filter_bits) if filter_bits else keys)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(count_name))
        .filter(F.col(count_name) > 1)
        .orderBy(F.desc(count_name), F.asc(key))
    )
    return out.limit(limit) if limit else out


def missing_aggs(fields: Sequence[str]) -> list[Column]:
    return [count_when(is_blank(F.col(f))).alias(f) for f in fields]


def missing_finish(sums: DataFrame, fields: Sequence[str], name_col: str = "field_name", count_col: str = "missing_count") -> DataFrame:
    pairs = ", ".join(f"'{f}', `{f}`" for f in fields)
    return sums.selectExpr(f"stack({len(fields)}, {pairs}) AS ({name_col}, {count_col})")


def missing_report(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per field: how many values are NULL or blank (single scan)."""
    return missing_finish(df.agg(*missing_aggs(fields)), fields)


def normalised(col: str) -> Column:
    return F.lower(F.trim(F.col(col)))


def by_frequency(counts: DataFrame, name: str, count_col: str = "record_count") -> DataFrame:
    """Counted values, largest first, ties by value."""
    return counts.orderBy(F.desc(count_col), F.asc_nulls_first(name))


def value_frequencies(
    df: DataFrame,
    col: str,
    normalise: bool = True,
    alias: str | None = None,
    count_col: str = "record_count",
) -> DataFrame:
    """Counts per value (optionally of LOWER(TRIM(value))), largest first."""
    name = alias or col
    v = normalised(col) if normalise else F.col(col)
    return by_frequency(df.groupBy(v.alias(name)).agg(F.count(F.lit(1)).alias(count_col)), name, count_col)


def null_count_aggs(cols: dict[str, str], total: str | None = None) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias(total)] if total else []
    return aggs + [count_when(F.col(c).isNull()).alias(out) for out, c in cols.items()]


def null_counts(
    df: DataFrame,
    cols: dict[str, str],
    total: str | None = None,
) -> DataFrame:
    """One row: optional total, then NULL count per column (``{output: column}``)."""
    return df.agg(*null_count_aggs(cols, total))


def null_counts_of_counts(df: DataFrame, cols: dict[str, str], total: str | None = None) -> DataFrame:
    """``null_counts`` from row and value counts alone, which a scan of columnar
    files can answer from their footers; NULL on empty input as there."""
    n = F.count(F.lit(1))
    out = [F.when(n > 0, n - F.count(c)).alias(name) for name, c in cols.items()]
    return df.agg(*([n.alias(total)] if total else []), *out)


def count_and_range(df: DataFrame, cols: Sequence[str], total: str = "row_count") -> DataFrame:
    """One row: rows, and least and largest value per column (footers answer it too)."""
    return df.agg(F.count(F.lit(1)).alias(total), *[f(c).alias(f"{name}_{c}") for c in cols for name, f in (("min", F.min), ("max", F.max))])


def invalid_rows(
    df: DataFrame,
    required: Sequence[str],
    limit: int | None = 100,
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Rows missing any required value, for review before they are excluded."""
    cond = None
    for c in required:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    out = df.filter(cond)
    if order:
        out = out.orderBy(*order)
    return out.limit(limit) if limit else out


def cleaned_check_aggs(target: str = "churn") -> list[Column]:
    return [F.count(F.lit(1)).alias("cleaned_rows"), count_when(F.col(target).isNull()).alias("missing_churn")]


def cleaned_check_finish(one_row: DataFrame) -> DataFrame:
    rows, ids = F.col("cleaned_rows"), F.col("distinct_customer_ids")
    return one_row.select(rows, ids, (rows - ids).alias("remaining_duplicate_rows"), "missing_churn")


def cleaned_check(df: DataFrame, key: str = "customer_id", target: str = "churn") -> DataFrame:
    """Rows, distinct keys, remaining duplicates, and rows missing the target."""
    return cleaned_check_finish(attach_scalars(df.agg(*cleaned_check_aggs(target)), distinct_count(df, key, "distinct_customer_ids")))
