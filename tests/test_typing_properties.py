"""Property tests: Spark conversion rules vs a plain-Python model of the contract."""

from __future__ import annotations

import datetime as dt
import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from churnlens.functions import typing_rules as R

INT_MAX = 2**31 - 1


def model_int(s: str | None) -> int | None:
    if s is None:
        return None
    t = s.strip(" ")
    if not re.fullmatch(R.INT_PATTERN.strip("^$"), t):
        return None
    v = int(t.split(".")[0])
    return v if -(2**31) <= v <= INT_MAX else None


def model_double(s: str | None) -> float | None:
    if s is None:
        return None
    t = s.strip(" ")
    if not re.fullmatch(R.DOUBLE_PATTERN.strip("^$"), t):
        return None
    v = float(t)
    return None if math.isinf(v) else v


def model_date(s: str | None) -> dt.date | None:
    if s is None:
        return None
    t = s.strip(" ")
    if not re.fullmatch(R.DATE_PATTERN.strip("^$"), t):
        return None
    try:
        return dt.date(int(t[:4]), int(t[5:7]), int(t[8:10]))
    except ValueError:
        return None


def model_flag(s: str | None) -> int | None:
    if s is None:
        return None
    w = s.strip(" ").lower()
    return 1 if w in R.TRUE_WORDS else 0 if w in R.FALSE_WORDS else None


pad = st.sampled_from(["", " ", "  ", "\t"])
digits = st.text("0123456789", min_size=0, max_size=12)
numberish = st.builds(
    lambda a, sign, d1, dot, d2, e, b: f"{a}{sign}{d1}{dot}{d2}{e}{b}",
    pad,
    st.sampled_from(["", "+", "-"]),
    digits,
    st.sampled_from(["", ".", "..", ","]),
    digits,
    st.sampled_from(["", "e3", "E-2", "e400", "f", "d", "x"]),
    pad,
)
dateish = st.builds(
    lambda a, y, m, d, sep, b: f"{a}{y:04d}{sep}{m:02d}{sep}{d:02d}{b}",
    pad,
    st.integers(1000, 2999),
    st.integers(0, 13),
    st.integers(0, 32),
    st.sampled_from(["-", "/", ""]),
    pad,
)
flagish = st.builds(
    lambda a, w, b: f"{a}{w}{b}",
    pad,
    st.sampled_from(["1", "0", "yes", "YES", "y", "N", "no", "true", "False", "1.0", "maybe", ""]),
    pad,
)
values = st.lists(st.one_of(st.none(), numberish, dateish, flagish, st.text(max_size=6)), min_size=50, max_size=200)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(values)
def test_rules_match_model(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    rows = df.select(
        "x",
        R.to_int("x").alias("i"),
        R.to_double("x").alias("d"),
        R.strict_date("x").alias("dt"),
        R.flag01("x").alias("f"),
    ).collect()
    for r in rows:
        x = r["x"]
        assert r["i"] == model_int(x), x
        assert r["d"] == model_double(x), x
        assert r["dt"] == model_date(x), x
        assert r["f"] == model_flag(x), x
