"""Raw, typed and cleaned table contracts.

Fixed values: the column names, their order and their types below must equal
the reference's table definitions for exports and reports to line up.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw/typed column order (32 columns) ----------------------
COLUMNS: list[str] = [
    "customer_id",
    "signup_date",
    "age",
    "gender",
    "annual_income",
    "education",
    "marital_status",
    "dependents",
    "tenure",
    "contract",
    "payment_method",
    "paperless_billing",
    "senior_citizen",
    "monthlycharges",
    "totalcharges",
    "num_services",
    "has_phone_service",
    "has_internet_service",
    "has_online_security",
    "has_online_backup",
    "has_device_protection",
    "has_tech_support",
    "has_streaming_tv",
    "has_streaming_movies",
    "customer_satisfaction",
    "num_complaints",
    "num_service_calls",
    "late_payments",
    "avg_monthly_gb",
    "days_since_last_interaction",
    "credit_score",
    "churn",
]

# --- fixed values: the eight derived groups of the cleaned table ------------
GROUP_COLUMNS: list[str] = [
    "tenure_group",
    "satisfaction_group",
    "complaint_group",
    "service_call_group",
    "late_payment_group",
    "interaction_recency_group",
    "monthly_charge_band",
    "usage_band",
]

CLEANED_COLUMNS: list[str] = COLUMNS + GROUP_COLUMNS

# --- fixed values: typed column types ---------------------------------------
_STRING = ["customer_id", "gender", "education", "marital_status", "contract", "payment_method"]
_DOUBLE = ["annual_income", "monthlycharges", "totalcharges", "avg_monthly_gb"]
_DATE = ["signup_date"]
# every other typed column is INT (counts, ranges and 0/1 flags)

FLAG_COLUMNS: list[str] = [
    "paperless_billing",
    "senior_citizen",
    "has_phone_service",
    "has_internet_service",
    "has_online_security",
    "has_online_backup",
    "has_device_protection",
    "has_tech_support",
    "has_streaming_tv",
    "has_streaming_movies",
    "churn",
]

# Row key carried alongside the 32 source columns when the input provides it.
ROW_ID = "row_id"


def spark_type(name: str) -> T.DataType:
    if name in _STRING or name in GROUP_COLUMNS:
        return T.StringType()
    if name in _DOUBLE:
        return T.DoubleType()
    if name in _DATE:
        return T.DateType()
    return T.IntegerType()


RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in COLUMNS])
TYPED_SCHEMA = T.StructType([T.StructField(c, spark_type(c), True) for c in COLUMNS])
CLEANED_SCHEMA = T.StructType([T.StructField(c, spark_type(c), True) for c in CLEANED_COLUMNS])


def ddl(schema: T.StructType) -> str:
    """Column list for ``CREATE TABLE (...)``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
