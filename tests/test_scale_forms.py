"""Forms for scale: footer statistics, clustered tables, key filter, lattice, positions, running totals."""

from __future__ import annotations

import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from churnlens.operators.incremental import RunningCells
from churnlens.operators.ordering import numbered
from churnlens.operators.quality import cleaned_check, count_and_range, duplicate_keys, null_counts, null_counts_of_counts, repeated_only
from churnlens.plans import queries, reports
from churnlens.plans.pipeline import AttritionPipeline
from churnlens.sources.fixture import raw_records
from churnlens.sources.tables import scan_footers

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final(df) -> str:
    """The plan as it was run."""
    df.collect()
    return _plan(df)


# ------------------------------------------------------------- footers
def test_counts_and_ranges_come_from_orc_footers(spark, tmp_out):
    rows = spark.range(5000).select((F.col("id") % 7).cast("int").alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") / 4).alias("b"), F.lit(None).cast("string").alias("c"))
    rows.write.orc(os.path.join(tmp_out, "t"))
    scan = scan_footers(spark, os.path.join(tmp_out, "t"))
    nulls = null_counts_of_counts(scan, {"no_a": "a", "no_b": "b", "no_c": "c"}, total="n")
    assert re.search(r"PushedAggregation: \[.*COUNT\(\*\)", _plan(nulls)) and "PushedAggregation: []" not in _plan(nulls)
    assert nulls.collect() == null_counts(rows, {"no_a": "a", "no_b": "b", "no_c": "c"}, total="n").collect()
    ranges = count_and_range(scan, ["a", "b"])
    assert re.search(r"PushedAggregation: \[.*MIN\(a\)", _plan(ranges))
    assert tuple(ranges.first()) == (5000, 0, 6, 0.25, 1249.75)
    assert "orc" in spark.conf.get("spark.sql.sources.useV1SourceList")  # other scans are as before


def test_footer_counts_of_an_empty_table(spark, tmp_out):
    rows = spark.range(0).select(F.col("id").alias("a"))
    rows.write.orc(os.path.join(tmp_out, "t"))
    got = null_counts_of_counts(scan_footers(spark, os.path.join(tmp_out, "t")), {"no_a": "a"}, total="n").first()
    assert tuple(got) == (0, None) == tuple(null_counts(rows, {"no_a": "a"}, total="n").first())


def test_validation_reads_footers_only(spark, tmp_out):
    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "p"))
    plan = _plan(p.typed_required_nulls())
    assert "PushedAggregation: [COUNT(*)" in plan and "Exchange" in plan


# ------------------------------------------------------------- clustered
def test_a_clustered_table_counts_its_keys_without_an_exchange_of_them(spark):
    p = queries.clustered_pipeline(spark, SF_SMALL)
    plan = _final(cleaned_check(p.cleaned))
    assert "hashpartitioning(customer_id" not in plan and "Bucketed: true" in plan
    # and the cleaned table was written from the buckets of the deduplicated one
    again = p.deduplicated.groupBy("customer_id").count()
    assert "Exchange" not in _final(again)
    # the table that isn't clustered exchanges its keys
    assert "hashpartitioning(customer_id" in _final(cleaned_check(queries.pipeline(spark, SF_SMALL).cleaned)) or "hashpartitioning(__key" in _final(
        cleaned_check(queries.pipeline(spark, SF_SMALL).cleaned)
    )


# ------------------------------------------------------------- key filter
@pytest.mark.parametrize("bits", [4, 16, 22])
def test_the_key_filter_keeps_every_repeated_key(spark, bits):
    rng = random.Random(bits)
    keys = [f"id-{i}" for i in range(3000)] + [f"id-{rng.randrange(3000)}" for _ in range(60)] + ["hot"] * 1500 + [None]
    df = spark.createDataFrame([(k, i, "x") for i, k in enumerate(keys)], "k string, slot int, bits string")
    kept = repeated_only(df, F.col("k"), bits)
    assert kept.columns == df.columns
    got = Counter(r["k"] for r in kept.collect())
    want = {k: n for k, n in Counter(keys).items() if n > 1}
    assert {k: got[k] for k in want} == want
    if bits == 22:
        assert len(got) <= len(want) + 10  # singles that share a counter
    assert duplicate_keys(df, "k", None, filter_bits=bits).collect() == duplicate_keys(df, "k", None).collect()


def test_the_key_filter_is_below_the_exchange_of_the_keys(spark, tmp_out):
    spark.range(200_000).select(F.concat(F.lit("customer-with-a-long-key-"), F.col("id") % 199_990).alias("k")).write.parquet(os.path.join(tmp_out, "k"))
    df = spark.read.parquet(os.path.join(tmp_out, "k"))
    out = duplicate_keys(df, "k", 100, filter_bits=22)
    assert out.count() == 10
    plan = _plan(out)
    # leaf to root: the look-up in the bitmaps, then the exchange of what it left
    assert plan.index("hashpartitioning(k#") < plan.index("BroadcastHashJoin") and "CartesianProduct" not in plan
    kept = repeated_only(df, F.col("k"), 22).count()
    assert kept < 200_000 * 0.07  # of 200,000 keys 20 are repeated; singles share a counter with about 5 in 100


def test_an_empty_table_has_no_duplicates(spark):
    df = spark.createDataFrame([], "k string")
    assert duplicate_keys(df, "k", filter_bits=22).count() == 0


# ------------------------------------------------------------- lattice
def test_report_cells_roll_up_from_four_groupings_of_one_scan(spark):
    c = queries.pipeline(spark, SF_SMALL).cleaned
    roots = reports.report_cells(c)
    logical = roots._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Relation [") == 1 and logical.count("Expand") == 1
    expand = next(line for line in logical.splitlines() if "Expand" in line)
    assert expand.split("]], [")[0].count("], [") == len(reports.CELL_ROOTS) - 1 == 3  # four projections a row, not nine
    assert {r["gid"] for r in roots.collect()} == {reports._gid(keys) for keys in reports.CELL_ROOTS.values()}
    for name, keys in reports.CELL_SETS.items():
        want = sorted(map(tuple, reports.rate_cells(c, keys).collect()), key=str)
        assert sorted(map(tuple, reports.cells_of(roots, name).collect()), key=str) == want, name


# ------------------------------------------------------------- positions
@pytest.mark.parametrize("n", [0, 1, 5000])
def test_positions_are_those_of_a_sort(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice("abcdefgh") * rng.randint(0, 3) or None, rng.randint(0, 9), i) for i in range(n)]
    df = spark.createDataFrame(rows, "s string, r int, i int").repartition(7)
    order = [F.desc("r"), F.asc_nulls_first("s"), F.asc("i")]
    got = numbered(df, order, "place")
    assert got.columns == ["place", "s", "r", "i"]
    want = sorted(rows, key=lambda t: (-t[1], t[0] is not None, t[0] or "", t[2]))
    assert [tuple(r)[1:] for r in sorted(got.collect(), key=lambda r: r["place"])] == want
    assert sorted(r["place"] for r in got.collect()) == list(range(1, n + 1))


def test_positions_need_no_task_that_sorts_everything(spark):
    c = queries.pipeline(spark, SF_SMALL).cleaned
    plan = _final(numbered(reports.rate_cells(c, ["contract", "payment_method"]), [F.col("contract"), F.col("payment_method")]))
    assert "Window [row_number()" in plan
    for m in re.finditer(r"Window \[row_number\(\)[^\n]*", plan):
        assert "[__stretch#" in m.group()  # partitioned by stretch


# ------------------------------------------------------------- running totals
def _latest(rows):
    """Plain twin: the newest usable record per id, ties to the larger row key."""
    best = {}
    for r in rows:
        i, date, g, t, k = r
        if i is None or t not in (0, 1):
            continue
        if i not in best or ((best[i][1] or ""), best[i][4]) < ((date or ""), k):
            best[i] = r
    out = Counter(), Counter()
    for _, _, g, t, _ in best.values():
        out[0][g] += 1
        out[1][g] += t
    return {g: (n, out[1][g]) for g, n in out[0].items()}


@pytest.mark.parametrize("seed", range(3))
def test_running_totals_equal_a_full_run_after_every_batch(spark, tmp_out, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice([None, *[f"c{i}" for i in range(40)]]), rng.choice([None, "2024-01-01", "2024-02-02", "2024-03-03"]), rng.choice([None, "x", "y", "z"]), rng.choice([0, 1, 1, None, 5]), k)
        for k in range(400)
    ]
    batches = [rows[:150], rows[150:151], [], rows[151:390], rows[390:]]
    path = os.path.join(tmp_out, "running")
    make = lambda: RunningCells(spark, path, ["g"], "id", "t", {"d": F.col("d").desc_nulls_last()}, ["k"])
    seen = []
    for n, batch in enumerate(batches):
        df = spark.createDataFrame(batch, "id string, d string, g string, t int, k int").withColumn("more", F.lit(1))
        make().add(df, n)
        if n == 3:
            make().add(df, n)  # run again after a lost driver: replaces what it left
        seen += batch
        got = {r["g"]: (r["total_customers"], r["churned_customers"]) for r in make().totals(n + 1).collect()}
        assert got == _latest(seen), n


def test_a_batch_that_is_seen_twice_changes_nothing(spark, tmp_out):
    rows = spark.createDataFrame([("a", "2024-01-01", "x", 1, 1), ("b", "2024-01-01", "x", 0, 2)], "id string, d string, g string, t int, k int")
    run = RunningCells(spark, os.path.join(tmp_out, "r"), ["g"], "id", "t", {"d": F.col("d").desc_nulls_last()}, ["k"])
    run.add(rows, 0)
    run.add(rows, 1)
    assert [tuple(r) for r in run.totals(2).collect()] == [("x", 2, 1)]
