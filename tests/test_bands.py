"""Both edges of every bucket, NULL handling, and threshold corner cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from churnlens.operators import bands as B


def _band(spark, fn, values, dtype="int"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x")).alias("b")).collect()]


@pytest.mark.parametrize(
    "fn,cases",
    [
        (
            B.tenure_group,
            [(None, "missing"), (0, "0-12_months"), (12, "0-12_months"), (13, "13-24_months"), (24, "13-24_months"),
             (25, "25-48_months"), (48, "25-48_months"), (49, "49+_months"), (500, "49+_months")],
        ),
        (
            B.satisfaction_group,
            [(None, "missing"), (1, "low"), (2, "low"), (3, "moderate"), (4, "high"), (5, "high")],
        ),
        (
            B.complaint_group,
            [(None, "missing"), (0, "none"), (1, "one"), (2, "two_to_three"), (3, "two_to_three"), (4, "more_than_three")],
        ),
        (
            B.service_call_group,
            [(None, "missing"), (0, "none"), (1, "one_to_two"), (2, "one_to_two"), (3, "three_to_five"),
             (5, "three_to_five"), (6, "more_than_five")],
        ),
        (
            B.late_payment_group,
            [(None, "missing"), (0, "none"), (1, "one_to_two"), (2, "one_to_two"), (3, "three_to_five"),
             (5, "three_to_five"), (6, "more_than_five")],
        ),
        (
            B.interaction_recency_group,
            [(None, "missing"), (0, "0-30_days"), (30, "0-30_days"), (31, "31-60_days"), (60, "31-60_days"),
             (61, "61-90_days"), (90, "61-90_days"), (91, "91+_days")],
        ),
    ],
)
def test_range_band_edges(spark, fn, cases):
    vals = [v for v, _ in cases]
    assert _band(spark, fn, vals) == [b for _, b in cases]


def test_satisfaction_out_of_contract_values_fall_to_high(spark):
    # a value below the first range (0) is not 'low': it falls to the ELSE branch
    assert _band(spark, B.satisfaction_group, [0, -1]) == ["high", "high"]


def test_monthly_charge_band_inclusive_edges(spark):
    cuts = [10.0, 20.0]
    got = _band(spark, lambda c: B.monthly_charge_band(cuts, c), [None, 5.0, 10.0, 10.01, 20.0, 20.5], "double")
    assert got == ["missing", "low", "low", "medium", "medium", "high"]


def test_threshold_band_with_array_column(spark):
    df = spark.createDataFrame([(5.0,), (15.0,), (25.0,)], "x double").withColumn(
        "cuts", F.array(F.lit(10.0), F.lit(20.0))
    )
    got = [r[0] for r in df.select(B.threshold_band("x", F.col("cuts"))).collect()]
    assert got == ["low", "medium", "high"]


def test_null_thresholds_send_values_to_high(spark):
    got = _band(spark, lambda c: B.monthly_charge_band([None, None], c), [None, 0.0, 1e9], "double")
    assert got == ["missing", "high", "high"]
    # an empty (NULL) threshold array behaves the same way
    df = spark.createDataFrame([(1.0,)], "x double").withColumn("cuts", F.lit(None).cast("array<double>"))
    assert df.select(B.threshold_band("x", F.col("cuts"))).first()[0] == "high"


def test_usage_band_branch_order(spark):
    rows = [
        (0, None),  # no internet wins over missing
        (0, 50.0),
        (1, None),
        (None, None),  # unknown internet, missing usage
        (None, 5.0),  # unknown internet is still banded
        (1, 5.0),
        (1, 15.0),
        (1, 25.0),
    ]
    df = spark.createDataFrame(rows, "net int, gb double")
    got = [r[0] for r in df.select(B.usage_band([10.0, 20.0], "gb", "net")).collect()]
    assert got == ["no_internet", "no_internet", "missing", "missing", "low", "low", "medium", "high"]


def test_fill_when(spark):
    df = spark.createDataFrame([(0, None), (1, None), (None, None), (0, 3.0)], "net int, gb double")
    got = [r[0] for r in df.select(B.fill_when("gb", F.col("net") == 0, 0.0)).collect()]
    assert got == [0.0, None, None, 3.0]
