"""Raw attrition records derived from the order tables.

The test data has no attrition table, so each order plays one raw record and
the order's customer is its id (ids repeat, which exercises de-duplication).
Deterministic arithmetic on the order key injects the dirt the typing rules
must handle: blank and padded ids, impossible dates, non-numbers, out-of-range
values, mixed-case categories and ten flag spellings.

Plan shape: line items are pre-aggregated per order (partial aggregate before
the shuffle), left-joined to orders on the order key, then joined to
customers.  Only the columns used are read, so the scans prune to them, and
Spark picks broadcast vs. sort-merge for the customer join from table size
(AQE splits a skewed customer key at run time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.schema import COLUMNS, ROW_ID

# --- fixed values: fixture flag spellings, indexed by ((key * P) % 101) % 10 --
FLAG_SPELLINGS = ["Yes", " no ", "1", "0", "TRUE", "False", "y", "N", "unknown", ""]
# --- fixed values: per-column flag multiplier P ------------------------------
FLAG_MULTIPLIERS = {
    "paperless_billing": 1,
    "senior_citizen": 3,
    "has_phone_service": 7,
    "has_internet_service": 9,
    "has_online_security": 11,
    "has_online_backup": 13,
    "has_device_protection": 17,
    "has_tech_support": 19,
    "has_streaming_tv": 21,
    "has_streaming_movies": 23,
}


def _s(c: Column) -> Column:
    return c.cast("string")


def _flag(k: Column, mult: int) -> Column:
    slot = ((k * F.lit(mult)) % 101) % 10
    out = None
    for i, word in enumerate(FLAG_SPELLINGS):
        out = (F.when if out is None else out.when)(slot == i, F.lit(word))
    return out


def base_relation(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """One row per order with its customer and line-item summary.

    ``partitions`` deals the orders round-robin first: for one small file on
    many cores; without it the scan's own splits are kept.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    if partitions:
        orders = orders.repartition(partitions)
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_acctbal", "c_mktsegment"
    )
    lines = (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("nl"),
            F.sum("l_quantity").alias("qty"),
            F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("nr"),
        )
    )
    return (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .join(customer, orders.o_custkey == customer.c_custkey, "inner")
        .select(
            F.col("o_orderkey").alias("k"),
            F.col("o_custkey").alias("ck"),
            F.col("o_orderdate").alias("od"),
            F.col("o_totalprice").alias("tp"),
            F.col("o_orderstatus").alias("st"),
            F.col("o_orderpriority").alias("pri"),
            F.col("c_acctbal").alias("bal"),
            F.col("c_mktsegment").alias("seg"),
            "nl",
            "qty",
            "nr",
        )
    )


def raw_records(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """32 text columns plus ``row_id`` (the order key, a tie-break only)."""
    b = base_relation(spark, sf_dir, partitions)
    k, ck = F.col("k"), F.col("ck")
    expr: dict[str, Column] = {
        "customer_id": F.when(k % 211 == 0, F.lit(""))
        .when(k % 223 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 0, F.concat(F.lit(" "), _s(ck), F.lit(" ")))
        .otherwise(_s(ck)),
        "signup_date": F.when(k % 101 == 0, F.lit("2024-02-30"))
        .when(k % 103 == 0, F.lit("03/04/2024"))
        .when(k % 107 == 0, F.lit(""))
        .otherwise(_s(F.col("od").cast("date"))),
        "age": F.when(k % 89 == 0, F.lit("abc"))
        .when(k % 83 == 0, F.lit("150"))
        .otherwise(_s(F.lit(18) + ck % 70)),
        "gender": F.when(k % 4 == 0, F.lit(" Male"))
        .when(k % 4 == 1, F.lit("FEMALE"))
        .when(k % 4 == 2, F.lit("female "))
        .otherwise(F.lit("")),
        "annual_income": _s(F.col("bal")),
        "education": F.col("pri"),
        "marital_status": F.when(k % 3 == 0, F.lit("Single")).when(k % 3 == 1, F.lit("Married")),
        "dependents": _s(k % 6 - 1),
        "tenure": F.when(k % 61 == 0, F.lit("12.7"))
        .when(k % 67 == 0, F.lit(None).cast("string"))
        .otherwise(_s(k % 72)),
        "contract": F.when(k % 59 == 0, F.lit(None).cast("string"))
        .when(k % 3 == 0, F.lit("Month-to-month"))
        .when(k % 3 == 1, F.lit(" One year"))
        .otherwise(F.lit("TWO YEAR")),
        "payment_method": F.when(k % 53 == 0, F.lit("  ")).otherwise(F.col("seg")),
        "monthlycharges": F.when(k % 47 == 0, F.lit("-5"))
        .when(k % 43 == 0, F.lit("$12"))
        .otherwise(_s(F.col("tp"))),
        "totalcharges": _s(F.col("tp")),
        "num_services": _s(F.col("nl")),
        "customer_satisfaction": _s(k % 7),
        "num_complaints": _s(F.col("nr")),
        "num_service_calls": _s(k % 9 - 1),
        "late_payments": _s(k % 8),
        "avg_monthly_gb": _s(F.col("qty")),
        "days_since_last_interaction": _s(k % 120),
        "credit_score": _s(k % 1100),
        "churn": F.when(k % 11 == 0, F.lit("maybe"))
        .when(F.col("st") == "F", F.lit("Yes"))
        .otherwise(F.lit("0")),
    }
    for name, mult in FLAG_MULTIPLIERS.items():
        expr[name] = _flag(k, mult)
    return b.select(*[expr[c].alias(c) for c in COLUMNS], k.alias(ROW_ID))
