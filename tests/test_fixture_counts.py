"""Golden counts for the order-derived fixture at sf0.01 (FIXTURES.md §3)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from churnlens.plans import reports
from churnlens.plans.queries import pipeline

from conftest import SF_MID

BANDS = {
    "tenure_group": {"0-12_months": 303, "13-24_months": 230, "25-48_months": 486, "49+_months": 459, "missing": 21},
    "satisfaction_group": {"low": 443, "moderate": 201, "high": 443, "missing": 412},
    "complaint_group": {"none": 350, "one": 510, "two_to_three": 539, "more_than_three": 68, "missing": 32},
    "service_call_group": {"none": 165, "one_to_two": 326, "three_to_five": 493, "more_than_five": 334, "missing": 181},
    "late_payment_group": {"none": 186, "one_to_two": 372, "three_to_five": 585, "more_than_five": 356},
    "interaction_recency_group": {"0-30_days": 409, "31-60_days": 369, "61-90_days": 391, "91+_days": 330},
    "monthly_charge_band": {"low": 480, "medium": 480, "high": 479, "missing": 60},
    "usage_band": {"no_internet": 633, "low": 284, "medium": 292, "high": 271, "missing": 19},
}


@pytest.fixture(scope="module")
def p(spark):
    return pipeline(spark, SF_MID)


def test_raw_and_typed_counts(p):
    assert p.raw_stored.count() == 15000
    t = p.typed
    nulls = t.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in
                    ["customer_id", "signup_date", "churn", "age", "annual_income", "tenure", "avg_monthly_gb"]]).first()
    assert tuple(nulls) == (139, 431, 1364, 347, 1249, 220, 257)


def test_cleaned_rows_and_bands(p):
    c = p.cleaned
    assert c.count() == 1499
    for group, want in BANDS.items():
        got = {r[0]: r[1] for r in c.groupBy(group).count().collect()}
        assert got == want, group


def test_report_cell_counts(p):
    c = p.cleaned
    cells = [
        reports.rate_contract_payment(c, 4),
        reports.rate_contract_payment_report(c),
        reports.rate_tenure_satisfaction(c),
        reports.rate_complaints_calls(c),
        reports.rate_usage_support(c),
        reports.rate_charge_contract(c),
    ]
    assert [df.count() for df in cells] == [24, 15, 12, 16, 8, 9]


def test_mapreduce_totals_equal_report_totals(p):
    from churnlens.operators.rates import mapreduce_rate

    c = p.cleaned
    mr = {(r[0], r[1]): (r[2], r[3]) for r in mapreduce_rate(c).collect()}
    rep = {(r[0], r[1]): (r[2], r[3]) for r in reports.rate_contract_payment_report(c).collect()}
    assert mr == rep
