"""Plan-shape checks: pruning, pushdown, no needless shuffles, both threshold paths."""

from __future__ import annotations

import os
import re

from churnlens.plans.clean import clean
from churnlens.plans.pipeline import AttritionPipeline
from churnlens.schema import CLEANED_COLUMNS
from churnlens.sources.fixture import raw_records

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_approx_thresholds_via_scalar_subquery_equal_exact(spark, tmp_out):
    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "p"))
    exact = p.cleaned
    approx = clean(p.typed, method="approx", materialize=lambda df, name: p.deduplicated)
    assert approx.columns == CLEANED_COLUMNS
    plan = _plan(approx)
    assert "Subquery" in plan and "Join" not in plan  # one-row thresholds as a scalar subquery
    assert approx.exceptAll(exact).count() == 0 and exact.exceptAll(approx).count() == 0
    # the exact path inlines the cut points: no join at all
    assert "Join" not in _plan(clean(p.typed, materialize=lambda df, name: p.deduplicated))


def _scan_columns(df) -> list[str]:
    leaf = df._jdf.queryExecution().sparkPlan().collectLeaves().head()
    return list(leaf.requiredSchema().fieldNames())


def test_profile_queries_read_only_their_columns(spark, tmp_out):
    from churnlens.plans.pipeline import MISSING_FIELDS

    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "q"))
    assert _scan_columns(p.raw_frequencies("contract")) == ["contract"]
    assert sorted(_scan_columns(p.raw_missing())) == sorted(MISSING_FIELDS)
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", _plan(p.raw_key_uniqueness())))
    assert schemas == {"struct<>", "struct<customer_id:string>"}


def test_report_filters_reach_the_scan(spark, tmp_out):
    from churnlens.plans import reports

    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "r"))
    df = reports.rate_charge_contract(p.cleaned)
    plan = _plan(df)
    assert "Not(EqualTo(monthly_charge_band,missing))" in plan and "IsNotNull(contract)" in plan
    assert sorted(_scan_columns(df)) == ["churn", "contract", "monthly_charge_band"]
    assert "partial_count" in plan or "partial_sum" in plan


def test_typing_adds_no_shuffle(spark, tmp_out):
    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "s"))
    from churnlens.operators.typing import type_rows

    assert "Exchange" not in _plan(type_rows(p.raw_stored))


def test_partitions_are_dealt_only_when_asked(spark, tmp_out):
    from churnlens.sources.csv_raw import read_raw_csv, write_raw_csv
    from churnlens.schema import COLUMNS

    path = os.path.join(tmp_out, "csv")
    write_raw_csv(raw_records(spark, SF_SMALL).select(*COLUMNS), path)
    assert "Exchange" not in _plan(read_raw_csv(spark, path))
    assert "RoundRobinPartitioning(5)" in _plan(read_raw_csv(spark, path, partitions=5))


def test_distinct_counts_shuffle_the_key_alone(spark, tmp_out):
    from churnlens.operators.quality import cleaned_check, key_uniqueness

    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "d"))
    seen = []
    store = lambda df, name: seen.append(df) or df
    from churnlens.plans import reports

    reports.summary_tables(p.cleaned, store)
    for df in (cleaned_check(p.cleaned), key_uniqueness(p.raw_stored, "customer_id"), seen[0]):
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        keyed = [x for x in text.splitlines() if "HashAggregate(keys=[__key" in x]
        assert keyed and all("functions=[]" in x for x in keyed), text


def test_preview_and_inspection_take_a_limit_without_a_sort(spark, tmp_out):
    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "v"))
    plan = _plan(p.raw_preview())
    assert "CollectLimit" in plan and "Sort" not in plan.replace("SortMergeJoin", "").replace("SortAggregate", "")
    assert not os.path.exists(os.path.join(tmp_out, "v"))  # nothing was written for it
    assert "TakeOrdered" not in _plan(p.typed_invalid()) and "TakeOrdered" in _plan(p.raw_preview(10, order=["row_id"]))


def test_thresholds_are_a_plan_over_the_table(spark, tmp_out):
    from churnlens.operators.quantiles import exact_quantiles, quantile_thresholds
    from churnlens.plans.clean import threshold_specs

    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "t"))
    d = p.deduplicated
    th = quantile_thresholds(d, threshold_specs(d))
    assert "Scan orc" in _plan(th)
    assert {k: list(th.first()[k]) for k in th.columns} == exact_quantiles(d, threshold_specs(d))


def test_dedupe_filter_is_pushed_below_the_window(spark):
    raw = raw_records(spark, SF_SMALL)
    from churnlens.operators.typing import type_rows
    from churnlens.plans.clean import deduplicate

    plan = _plan(deduplicate(type_rows(raw, ["row_id"])))
    # the validity filter (target IN (0,1)) runs before the exchange that feeds
    # the window: deeper in the printed tree means earlier in execution
    lines = plan.splitlines()
    filt = next(i for i, ln in enumerate(lines) if "Filter" in ln and "IN (0,1)" in ln)
    exch = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning(customer_id" in ln)
    assert filt > exch


def test_raw_staging_is_a_plain_option(spark, tmp_out):
    raw = raw_records(spark, SF_SMALL)
    assert AttritionPipeline(spark, raw, workdir=os.path.join(tmp_out, "w"), stage_raw=False).raw_stored is raw
    assert "Scan orc" in _plan(AttritionPipeline(spark, raw, workdir=os.path.join(tmp_out, "x")).raw_stored)
