"""Latest-per-key selection and exact quantiles (checked against brute force)."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.operators.dedupe import latest_per_key, valid_target_rows
from churnlens.operators.quantiles import attach_scalars, exact_quantiles, quantile_thresholds
from churnlens.plans.clean import deduplicate


def test_latest_per_key_order_and_ties(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 6, 1)
    rows = [
        ("a", d1, 1, 10),
        ("a", d2, 1, 11),  # newest date wins
        ("b", None, 0, 20),
        ("b", d1, 0, 21),  # NULL date sorts last
        ("c", d2, 1, 30),
        ("c", d2, 0, 31),  # same id and date: larger row key wins
        ("d", None, 1, 40),
        ("d", None, 1, 41),
    ]
    df = spark.createDataFrame(rows, "customer_id string, signup_date date, churn int, row_id long")
    out = latest_per_key(df, "customer_id", {"signup_date": F.col("signup_date").desc_nulls_last()}, ["row_id"])
    got = {r["customer_id"]: r["row_id"] for r in out.collect()}
    assert got == {"a": 11, "b": 21, "c": 31, "d": 41}


def test_latest_per_key_default_tiebreak_is_deterministic(spark):
    rows = [("k", 1, "x"), ("k", 1, "y"), ("k", 1, "a")]
    df = spark.createDataFrame(rows, "customer_id string, v int, w string")
    for n in (1, 3):
        out = latest_per_key(df.repartition(n), "customer_id", {"v": F.col("v").desc()})
        assert [r["w"] for r in out.collect()] == ["y"]


def test_valid_target_rows(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("a", None), ("b", 0), ("c", 1)], "customer_id string, churn int")
    assert sorted(r[0] for r in valid_target_rows(df, "customer_id", "churn").collect()) == ["b", "c"]


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    """A hot key (a third of all rows) is cut to one row per task map-side."""
    n = 3000
    rows = [(("hot" if i % 3 == 0 else f"k{i}"), dt.date(2024, 1, 1 + i % 28), 1, i) for i in range(n)]
    schema = "customer_id string, signup_date date, churn int, row_id long"
    df = spark.createDataFrame(rows, schema).repartition(6)
    out = latest_per_key(df, "customer_id", {"signup_date": F.col("signup_date").desc_nulls_last()}, ["row_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    res = {r["customer_id"]: r["row_id"] for r in out.collect()}
    assert len(res) == 1 + 2000
    hot = [i for i in range(0, n, 3)]
    best = max(hot, key=lambda i: (1 + i % 28, i))
    assert res["hot"] == best


def _brute(values, p):
    v = sorted(x for x in values if x is not None)
    if not v:
        return None
    k = min(len(v), max(1, math.ceil(p * len(v))))
    return v[k - 1]


@pytest.mark.parametrize("bins", [1024, 7, 2])
def test_exact_quantiles_match_brute_force(spark, bins):
    rnd = random.Random(7)
    vals = []
    for i in range(4000):
        r = rnd.random()
        if r < 0.33:
            vals.append(42.0)  # a third of all rows on one value
        elif r < 0.40:
            vals.append(None)
        else:
            vals.append(round(rnd.gauss(100, 30), 1))
    flags = [rnd.randint(0, 1) for _ in vals]
    df = spark.createDataFrame(list(zip(vals, flags)), "x double, f int").repartition(5)
    probs = [0.0, 0.01, 0.3333, 0.5, 0.6667, 0.99, 1.0]
    specs = {"all": (F.col("x"), probs), "cond": (F.when(F.col("f") == 1, F.col("x")), probs)}
    from churnlens.operators import quantiles as Q

    got = Q.exact_quantiles(df, specs, bins=bins)
    want_all = [_brute(vals, p) for p in probs]
    want_cond = [_brute([v for v, f in zip(vals, flags) if f == 1], p) for p in probs]
    assert got["all"] == want_all
    assert got["cond"] == want_cond


def test_exact_quantiles_empty_and_single(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, {"q": (F.col("x"), [0.5])}) == {"q": [None]}
    df1 = spark.createDataFrame([(3.5,)], "x double")
    assert exact_quantiles(df1, {"q": (F.col("x"), [0.0, 0.5, 1.0])}) == {"q": [3.5, 3.5, 3.5]}


def test_quantile_thresholds_one_row_frames(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    specs = {"cuts": (F.col("x"), [0.3333, 0.6667])}
    exact = quantile_thresholds(df, specs, method="exact").collect()
    approx = quantile_thresholds(df, specs, method="approx", accuracy=10_000).collect()
    assert len(exact) == 1 and exact[0]["cuts"] == [34.0, 67.0]
    assert approx[0]["cuts"] == [34.0, 67.0]
    joined = attach_scalars(df, quantile_thresholds(df, specs, method="approx"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "Join" not in plan
    assert joined.count() == 100


def test_deduplicate_drops_invalid_before_ranking(spark):
    from churnlens.schema import TYPED_SCHEMA, COLUMNS

    base = {c: None for c in COLUMNS}
    rows = []
    for cid, date, churn, rid in [("a", dt.date(2024, 1, 2), None, 1), ("a", dt.date(2024, 1, 1), 1, 2), (None, None, 1, 3)]:
        r = dict(base, customer_id=cid, signup_date=date, churn=churn)
        rows.append(tuple(r[c] for c in COLUMNS) + (rid,))
    schema = T.StructType(list(TYPED_SCHEMA.fields) + [T.StructField("row_id", T.LongType())])
    df = spark.createDataFrame(rows, schema)
    out = deduplicate(df).collect()
    # the newer 'a' row has no valid target, so the older valid one is kept
    assert [(r["customer_id"], r["signup_date"]) for r in out] == [("a", dt.date(2024, 1, 1))]


def test_exact_quantiles_match_duckdb_on_lineitem(spark):
    """60k real prices, so few bins that many narrowing rounds run."""
    import duckdb

    from conftest import SF_MID

    path = f"{SF_MID}/lineitem.parquet"
    probs = [0.01, 0.1, 0.25, 0.3333, 0.5, 0.6667, 0.75, 0.9, 0.99]
    df = spark.read.parquet(path)
    got = exact_quantiles(
        df,
        {"price": (F.col("l_extendedprice"), probs), "qty": (F.col("l_quantity"), probs)},
        bins=8,
    )
    con = duckdb.connect()
    for name, col in (("price", "l_extendedprice"), ("qty", "l_quantity")):
        sel = ", ".join(f"quantile_disc({col}, {p})" for p in probs)
        want = list(con.execute(f"SELECT {sel} FROM read_parquet('{path}')").fetchone())
        assert got[name] == want, name


def test_exact_quantiles_of_extreme_values(spark):
    inf = float("inf")
    vals = [-1.7e308, 1.7e308, 5e-324, -5e-324, 0.0, -0.0, 1.0, 1.0 + 2**-52, inf, -inf, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.1, 0.2, 0.3, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
    real = [v for v in vals if v is not None and v == v]
    got = exact_quantiles(df, {"q": (F.col("x"), probs)}, bins=3)["q"]
    assert got == [_brute(real, p) for p in probs]


@pytest.mark.parametrize("error, fan", [(0.0, 64), (0.5, 64), (-0.2, 1), (0.01, 64)])
def test_quantiles_are_exact_whatever_the_sketch_says(spark, monkeypatch, error, fan):
    """Brackets of no width, of everything, and beside the answer: the counts put them right."""
    from churnlens.operators import quantiles as Q

    merged = Q.sketch_brackets
    monkeypatch.setattr(Q, "sketch_brackets", lambda *a: merged(*a, fan=fan))
    rnd = random.Random(3)
    vals = [round(rnd.expovariate(0.01), 2) for _ in range(20_000)] + [7.0] * 10_000
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(9)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    assert exact_quantiles(df, {"q": (F.col("x"), probs)}, k=64, error=error)["q"] == [_brute(vals, p) for p in probs]


def test_two_scans_are_enough_for_a_hundred_thousand_values(spark, tmp_out):
    path = f"{tmp_out}/v"
    spark.range(100_000).select((F.xxhash64("id") % 1_000_000 / 100).alias("x")).write.parquet(path)
    df = spark.read.parquet(path)
    from churnlens.operators import quantiles as Q

    rounds = []
    bins = Q._bin
    Q._bin = lambda *a: rounds.append(1) or bins(*a)
    try:
        got = exact_quantiles(df, {"q": (F.col("x"), [0.3333, 0.6667])})["q"]
    finally:
        Q._bin = bins
    assert got == [_brute([r["x"] for r in df.collect()], p) for p in (0.3333, 0.6667)]
    assert len(rounds) == 2  # one histogram per cut, in one round after the sketch
