"""Rule tables for every conversion helper (missing, numbers, dates, flags)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnlens.functions import typing_rules as R
from churnlens.operators.typing import type_rows
from churnlens.schema import COLUMNS, RAW_SCHEMA, TYPED_SCHEMA


def _apply(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn(F.col("x")).alias("y")).collect()]


def test_blank_and_text(spark):
    vals = [None, "", "   ", " Ab ", "\tab", "x y"]
    assert _apply(spark, R.is_blank, vals) == [True, True, True, False, False, False]
    assert _apply(spark, R.blank_to_null, vals) == [None, None, None, "Ab", "\tab", "x y"]
    # trim removes spaces only: a tab-padded word keeps its tab
    assert _apply(spark, R.norm_text, vals) == [None, None, None, "ab", "\tab", "x y"]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("12", 12),
        (" 12 ", 12),
        ("+5", 5),
        ("-3", -3),
        ("12.7", 12),  # fraction truncated toward zero
        ("12.", 12),
        ("-0.5", 0),
        ("007", 7),
        (".5", None),
        ("12f", None),
        ("abc", None),
        ("NaN", None),
        ("1e3", None),
        ("99999999999", None),  # overflow
        ("2147483647", 2147483647),
        ("", None),
        (None, None),
        ("\t12", None),  # tab is not trimmed, so not a number
    ],
)
def test_to_int(spark, text, expected):
    assert _apply(spark, R.to_int, [text]) == [expected]


def test_int_in_ranges(spark):
    vals = ["-1", "0", "120", "121", "150", "abc"]
    assert _apply(spark, lambda c: R.int_in(c, 0, 120), vals) == [None, 0, 120, None, None, None]
    assert _apply(spark, lambda c: R.int_in(c, 0), vals) == [None, 0, 120, 121, 150, None]
    assert _apply(spark, lambda c: R.int_in(c, 1, 5), ["0", "1", "5", "6"]) == [None, 1, 5, None]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("12.5", 12.5),
        (" 3 ", 3.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("1e3", 1000.0),
        ("-2.5E-1", -0.25),
        ("NaN", None),
        ("Infinity", None),
        ("12f", None),
        ("12d", None),
        ("$12", None),
        ("1e400", None),  # overflows to infinity
        ("", None),
        (None, None),
    ],
)
def test_to_double(spark, text, expected):
    assert _apply(spark, R.to_double, [text]) == [expected]


def test_nonneg_double(spark):
    assert _apply(spark, R.nonneg_double, ["-5", "0", "4.25", "-0.0001"]) == [None, 0.0, 4.25, None]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2024-02-29", dt.date(2024, 2, 29)),
        (" 2024-01-05 ", dt.date(2024, 1, 5)),
        ("2024-02-30", None),  # impossible day
        ("2023-02-29", None),
        ("03/04/2024", None),  # wrong format
        ("2024-1-5", None),
        ("2024-01-05T10:00", None),
        ("", None),
        (None, None),
    ],
)
def test_strict_date(spark, text, expected):
    assert _apply(spark, R.strict_date, [text]) == [expected]


def test_flag01(spark):
    vals = ["1", "yes", " Y ", "TRUE", "0", "no", "n", "False", "1.0", "unknown", "", None, "\tyes"]
    assert _apply(spark, R.flag01, vals) == [1, 1, 1, 1, 0, 0, 0, 0, None, None, None, None, None]


def test_type_rows_schema_and_row(spark):
    row = {c: "" for c in COLUMNS}
    row.update(
        customer_id=" C1 ",
        signup_date="2024-03-01",
        age="44",
        gender=" Female",
        annual_income="52000.5",
        contract="Month-To-Month ",
        tenure="12.7",
        churn="Yes",
        has_internet_service="n",
        avg_monthly_gb="abc",
        credit_score="1001",
        customer_satisfaction="0",
    )
    df = spark.createDataFrame([tuple(row[c] for c in COLUMNS)], RAW_SCHEMA)
    out = type_rows(df)
    assert out.schema == TYPED_SCHEMA
    r = out.first().asDict()
    assert r["customer_id"] == "C1"  # case kept
    assert r["gender"] == "female"
    assert r["contract"] == "month-to-month"
    assert r["tenure"] == 12
    assert r["churn"] == 1
    assert r["has_internet_service"] == 0
    assert r["avg_monthly_gb"] is None
    assert r["credit_score"] is None
    assert r["customer_satisfaction"] is None
    assert r["education"] is None  # blank
    assert r["signup_date"] == dt.date(2024, 3, 1)


def test_type_rows_is_one_projection(spark):
    df = spark.createDataFrame([tuple([""] * len(COLUMNS))], RAW_SCHEMA)
    plan = type_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan
