"""Every registered query against its DuckDB oracle on the smallest data set."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from churnlens.plans.queries import ORDERED

from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


#: The queries of the attrition engine; those of the corpus operators have tests of their own.
NAMES = sorted(set(E.queries()) - set(E._CORPUS))


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _sort_key(row):
    return tuple((x is None, type(x).__name__ if x is not None else "", x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(E.oracle_sql()) - set(E._CORPUS)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    perm = [dcols.index(c) for c in sdf.columns]
    drows = [tuple(_norm(r[i]) for i in perm) for r in res.fetchall()]
    assert sorted(srows, key=_sort_key) == sorted(drows, key=_sort_key)



@pytest.mark.parametrize("name", sorted(ORDERED))
def test_report_row_order(spark, duck, name):
    """A report's rows come in the order of the positions that the SQL gives them."""
    plain = E.queries()[ORDERED[name][0]](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    rows = sorted(res.fetchall(), key=lambda r: r[names.index("position")])
    assert [tuple(_norm(x) for x in r) for r in plain.collect()] == [tuple(_norm(r[names.index(c)]) for c in plain.columns) for r in rows]
