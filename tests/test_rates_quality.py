"""Rates, shares, the map/combine/reduce contract, and profile checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens.operators.quality import (
    cleaned_check,
    duplicate_keys,
    invalid_rows,
    key_uniqueness,
    missing_report,
    null_counts,
    value_frequencies,
)
from churnlens.operators.rates import map_emit, mapreduce_rate, reduce_rate
from churnlens.plans import reports
from churnlens.operators.stats import describe_numeric


def _rows(n_total, n_churn, contract="month-to-month", pay="electronic check"):
    return [(contract, pay, 1 if i < n_churn else 0) for i in range(n_total)]


def test_mapreduce_golden_vectors(spark):
    # partials (3,2), (5,1), (2,1) for one key -> (10, 4) and rate 40.0
    rows = _rows(3, 2) + _rows(5, 1) + _rows(2, 1)
    df = spark.createDataFrame(rows, "contract string, payment_method string, churn int").repartition(3)
    r = mapreduce_rate(df).first()
    assert (r["total_customers"], r["total_churned"], r["churn_rate"]) == (10, 4, 40.0)
    # the published example: 10000 customers, 2600 churned -> 26.0
    big = spark.createDataFrame(_rows(10000, 2600), "contract string, payment_method string, churn int")
    r = mapreduce_rate(big).first()
    assert (r["total_customers"], r["total_churned"], r["churn_rate"]) == (10000, 2600, 26.0)


def test_mapreduce_filters_and_zero_guard(spark):
    rows = [("a", "x", 1), (None, "x", 1), ("a", None, 0), ("a", "x", None), ("a", "x", 2)]
    df = spark.createDataFrame(rows, "contract string, payment_method string, churn int")
    assert map_emit(df, ["contract", "payment_method"]).count() == 1
    empty = spark.createDataFrame([("a", "x", 0, 0)], "contract string, payment_method string, n int, c int")
    assert reduce_rate(empty.filter("n > 0"), ["contract", "payment_method"]).count() == 0
    zero = reduce_rate(empty, ["contract", "payment_method"]).first()
    assert zero["churn_rate"] == 0.0


def test_mapreduce_plan_has_partial_aggregate(spark):
    df = spark.createDataFrame(_rows(10, 3), "contract string, payment_method string, churn int")
    plan = mapreduce_rate(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan  # map-side combine before the exchange


def test_rates_keep_or_drop_null_keys_and_round(spark):
    rows = [("a", "x", 1), ("a", "x", 0), ("a", "x", 0), (None, "x", 1), ("b", None, 0)]
    df = spark.createDataFrame(rows, "contract string, payment_method string, churn int")
    keep = {(r[0], r[1]): tuple(r[2:]) for r in reports.rate_contract_payment(df, 4).collect()}
    assert keep[("a", "x")] == (3, 1, 33.3333)
    assert keep[(None, "x")] == (1, 1, 100.0)
    assert keep[("b", None)] == (1, 0, 0.0)
    drop = reports.rate_contract_payment_report(df).collect()
    assert [(r[0], r[1], r[4]) for r in drop] == [("a", "x", 33.33)]


def test_mapreduce_totals_equal_report_totals(spark):
    rows = [("a", "x", 1), ("a", "x", 0), ("b", "y", 1), (None, "y", 1), ("b", None, 1)]
    df = spark.createDataFrame(rows, "contract string, payment_method string, churn int")
    mr = sorted(tuple(r) for r in mapreduce_rate(df).collect())
    assert [(r[0], r[1], r[2], r[3]) for r in mr] == sorted((r[0], r[1], r[2], r[3]) for r in reports.rate_contract_payment_report(df).collect())
    cells = reports.rate_cells(df, ["contract", "payment_method"])
    assert sorted(tuple(r) for r in reports.finish_mapreduce_rate(cells).collect()) == mr


def test_share_of_total(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(0,)] * 5, "churn int")
    out = reports.churn_summary(df, 4).collect()
    assert [(r[0], r[1], r[2]) for r in out] == [("Retained", 5, 62.5), ("Churned", 3, 37.5)]
    assert abs(sum(r[2] for r in out) - 100.0) < 1e-9
    plan = reports.churn_summary(df, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # no single-partition window over all groups


def test_profile_checks(spark):
    rows = [(" 1 ", "Yes", "x"), ("1", "no", None), ("2", " YES", ""), ("", None, "y"), (None, "0", "y"), ("3", "1", "  ")]
    df = spark.createDataFrame(rows, "customer_id string, churn string, contract string")
    u = key_uniqueness(df, F.trim("customer_id")).first()
    # distinct ignores NULL ('' counts as a value): {'1','2','','3'}
    assert (u[0], u[1], u[2]) == (6, 4, 2)
    d = duplicate_keys(df, "customer_id", 100, key_expr=F.trim(F.col("customer_id"))).collect()
    assert [(r[0], r[1]) for r in d] == [("1", 2)]
    m = {r[0]: r[1] for r in missing_report(df, ["customer_id", "churn", "contract"]).collect()}
    assert m == {"customer_id": 2, "churn": 1, "contract": 3}
    f = value_frequencies(df, "churn").collect()
    assert f[0][0] == "yes" and f[0][1] == 2
    n = null_counts(df, {"nul_churn": "churn"}, total="total").first()
    assert (n["total"], n["nul_churn"]) == (6, 1)


def test_missing_report_is_single_scan(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    plan = missing_report(df, ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Union" not in plan


def test_invalid_rows_and_cleaned_check(spark):
    rows = [("a", 1, 1), (None, 0, 2), ("b", None, 3), ("a", 0, 4)]
    df = spark.createDataFrame(rows, "customer_id string, churn int, row_id long")
    inv = invalid_rows(df, ["customer_id", "churn"], 100, order=["row_id"]).collect()
    assert [r["row_id"] for r in inv] == [2, 3]
    c = cleaned_check(df).first()
    assert (c["cleaned_rows"], c["distinct_customer_ids"], c["remaining_duplicate_rows"], c["missing_churn"]) == (4, 2, 2, 1)


def test_describe_numeric(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0), (4, 40.0)], "t int, m double")
    r = describe_numeric(df, [("t", "tenure", ["mean", "median", "min", "max", "stddev"]), ("m", "mc", ["mean", "median"])]).first()
    assert r["record_count"] == 4
    assert r["mean_tenure"] == 2.5
    assert r["median_tenure"] == 2.0  # an actual element: rank ceil(0.5 * 4)
    assert (r["minimum_tenure"], r["maximum_tenure"]) == (1, 4)
    assert r["stddev_tenure"] == 1.12
    assert (r["mean_mc"], r["median_mc"]) == (25.0, 20.0)


def test_cluster_conf_sizes_partitions():
    from churnlens.session import cluster_conf

    conf = cluster_conf(100 * (1 << 40), 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    small = cluster_conf(10 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
