"""The typing stage parses each text once, in code that the JVM compiles, and makes no copy that nobody reads."""

from __future__ import annotations

import os

import pytest

from churnlens import session
from churnlens.operators.typing import AMOUNTS, INT_RANGES, type_rows
from churnlens.plans.pipeline import AttritionPipeline
from churnlens.schema import COLUMNS, RAW_SCHEMA


def _raw(spark, texts: list[str | None]):
    return spark.createDataFrame([[x] * len(COLUMNS) for x in texts], RAW_SCHEMA)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("column", [*INT_RANGES, *AMOUNTS])
def test_a_number_is_parsed_once(spark, column):
    plan = _plan(type_rows(_raw(spark, ["1"])).select(column))
    assert plan.count("RLIKE") == 1
    assert plan.count("try_cast") == 1


def test_odd_numbers(spark):
    texts = [" 12.7 ", "-1", "-0.0", "150", "99999999999", "1e400", "NaN", "Infinity", "12f", ".5", "5\n", "", " ", None]
    rows = type_rows(_raw(spark, texts)).select("age", "dependents", "credit_score", "customer_satisfaction", "totalcharges").collect()
    got = {x: tuple(r) for x, r in zip(texts, rows)}
    assert got[" 12.7 "] == (12, 12, 12, None, 12.7)
    assert got["-1"] == (None,) * 5
    assert got["-0.0"] == (0, 0, 0, None, 0.0)
    assert got["150"] == (None, 150, 150, None, 150.0)
    assert got["99999999999"] == (None, None, None, None, 99999999999.0)
    assert got[".5"] == (None, None, None, None, 0.5)
    assert got["5\n"] == (5, 5, 5, 5, 5.0)
    assert all(got[x] == (None,) * 5 for x in ("1e400", "NaN", "Infinity", "12f", "", " ", None))


def test_typing_alone_makes_no_copy_of_the_raw_rows(spark, tmp_out):
    raw = _raw(spark, ["1", "0", None])
    p = AttritionPipeline(spark, raw, workdir=os.path.join(tmp_out, "alone"))
    assert p.typed.count() == 3
    assert not os.path.exists(p._path("raw_orc"))
    q = AttritionPipeline(spark, raw, workdir=os.path.join(tmp_out, "profiled"))
    assert q.raw_missing().count() > 0
    assert os.path.exists(q._path("raw_orc"))
    assert q.typed.exceptAll(p.typed).count() == p.typed.exceptAll(q.typed).count() == 0


def test_wide_stages_are_written_in_methods_that_are_compiled(spark, tmp_out, monkeypatch):
    key = "spark.sql.codegen.hugeMethodLimit"
    monkeypatch.setattr(session, "_JIT_FLAG", "-XX:NoSuchFlag")  # a session without the flag
    before, seen = spark.conf.get(key), []
    p = AttritionPipeline(spark, _raw(spark, ["1"]), workdir=os.path.join(tmp_out, "methods"))
    write = type(spark.range(1).write).orc
    monkeypatch.setattr(type(spark.range(1).write), "orc", lambda self, *a, **k: (seen.append(int(spark.conf.get(key))), write(self, *a, **k))[1])
    p.typed
    assert seen == [session.JIT_LIMIT]
    assert spark.conf.get(key) == before


def test_the_limit_is_put_back_after_a_failure_and_left_where_the_flag_is_set(spark, monkeypatch):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    monkeypatch.setattr(session, "_JIT_FLAG", "-XX:NoSuchFlag")
    with pytest.raises(ValueError), session.compiled_methods(spark):
        raise ValueError
    assert spark.conf.get(key) == before
    monkeypatch.setattr(session, "_JIT_FLAG", "")
    with session.compiled_methods(spark):
        assert spark.conf.get(key) == before
