"""Sources and sinks: CSV dialect, ORC and TSV round trips, the catalog-backed script."""

from __future__ import annotations

import glob
import gzip
import os

import pytest

from pyspark.sql import functions as F

from churnlens.operators.rates import mapreduce_rate
from churnlens.plans.pipeline import AttritionPipeline, run_script
from churnlens.schema import CLEANED_COLUMNS, CLEANED_SCHEMA, COLUMNS, RAW_SCHEMA, TYPED_SCHEMA
from churnlens.sinks.writers import export_tsv, read_tsv
from churnlens.sources.csv_raw import read_raw_csv, write_raw_csv
from churnlens.sources.fixture import raw_records

from conftest import SF_SMALL


def _csv_line(values):
    return ",".join(values)


def test_raw_csv_dialect(spark, tmp_out):
    header = _csv_line(COLUMNS)
    rest = [""] * (len(COLUMNS) - 3)
    lines = [
        header,
        _csv_line(['"C\\"1"', '""', ""] + rest),  # backslash-escaped quote, quoted empty, empty
        _csv_line(['"a,b"', "2024-01-01", "30"] + rest),  # separator inside quotes
        _csv_line([" padded ", "x", "y"] + rest),
    ]
    path = os.path.join(tmp_out, "raw")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.csv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    df = read_raw_csv(spark, path)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in RAW_SCHEMA]
    rows = {r["signup_date"]: r for r in df.collect()}
    assert len(rows) == 3  # header skipped
    assert rows[""]["customer_id"] == 'C"1'
    assert rows[""]["age"] == ""  # empty reads as text, not NULL
    assert rows["2024-01-01"]["customer_id"] == "a,b"
    assert rows["x"]["customer_id"] == " padded "  # padding is data
    nulls = {r["customer_id"]: r for r in read_raw_csv(spark, path, empty_as_text=False).collect()}
    assert nulls['C"1']["age"] is None


def test_raw_csv_roundtrip_keeps_padding(spark, tmp_out):
    raw = raw_records(spark, SF_SMALL).select(*COLUMNS)
    path = os.path.join(tmp_out, "rt")
    write_raw_csv(raw, path)
    back = read_raw_csv(spark, path)
    want = raw.na.fill("")
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_tsv_export_roundtrip_with_nulls(spark, tmp_out):
    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "w"))
    cleaned = p.cleaned
    assert cleaned.schema == CLEANED_SCHEMA
    out = os.path.join(tmp_out, "tsv")
    export_tsv(cleaned, out)
    parts = glob.glob(os.path.join(out, "part-*"))
    assert parts and all(x.endswith(".gz") for x in parts)
    with gzip.open(parts[0], "rt") as fh:
        line = fh.readline().rstrip("\n")
    fields = line.split("\t")
    assert len(fields) == len(CLEANED_COLUMNS) and fields[0] != "customer_id"  # no header
    back = read_tsv(spark, out, CLEANED_SCHEMA)
    assert back.exceptAll(cleaned).count() == 0 and cleaned.exceptAll(back).count() == 0
    text = spark.read.text(out)
    assert text.filter(F.col("value").contains("\\N")).count() > 0  # NULL written as \N


def test_pipeline_stages_are_written_orc(spark, tmp_out):
    work = os.path.join(tmp_out, "stages")
    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=work)
    assert p.typed.count() == 1500
    assert [f for f in p.typed.schema.fields if f.name != "row_id"] == list(TYPED_SCHEMA.fields)
    c = p.cleaned
    check = p.checks["cleaned_check"].first()
    assert check["remaining_duplicate_rows"] == 0 and check["missing_churn"] == 0
    assert check["cleaned_rows"] == c.count()
    for stage in ("typed_orc", "deduplicated", "cleaned_orc"):
        assert glob.glob(os.path.join(work, stage, "*.orc"))
    # bands cover every row exactly once
    for g in CLEANED_COLUMNS[len(COLUMNS):]:
        assert sum(r[1] for r in c.groupBy(g).count().collect()) == c.count()


def test_share_sums_to_100(spark):
    from churnlens.plans.queries import QUERIES

    rows = QUERIES["share_of_total_2dp"](spark, SF_SMALL).collect()
    assert abs(sum(r["percentage"] for r in rows) - 100.0) <= 0.01 * len(rows)


def test_run_script_with_catalog_tables(spark, tmp_out):
    raw_dir = os.path.join(tmp_out, "raw_csv")
    write_raw_csv(raw_records(spark, SF_SMALL).select(*COLUMNS), raw_dir)
    base = os.path.join(tmp_out, "base")
    out = run_script(spark, raw_dir, base, database="churn_test_db")
    assert out["raw_record_count"].first()[0] == 1500
    names = [r["col_name"] for r in out["describe_raw"].collect()]
    assert "customer_id" in names and "Location" in names
    assert spark.table("churn_test_db.customer_churn_typed").count() == 1500
    cleaned = spark.table("churn_test_db.customer_churn_cleaned")
    chk = out["cleaned_check"].first()
    assert chk["cleaned_rows"] == cleaned.count() and chk["remaining_duplicate_rows"] == 0
    for name in ("contract_payment", "tenure_satisfaction", "complaints_calls", "usage_support", "charge_contract", "mapreduce_rate"):
        assert out[name].count() > 0
    assert glob.glob(os.path.join(base, "export_tsv", "part-*"))
    # dropping an external table leaves its files
    spark.sql("DROP TABLE churn_test_db.customer_churn_cleaned")
    assert glob.glob(os.path.join(base, "cleaned_orc", "*.orc"))


def test_combined_profile_equals_single_statements(spark, tmp_out):
    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "prof"))
    combined = p.profile
    single = {
        "raw_record_count": p.raw_count(),
        "raw_key_uniqueness": p.raw_key_uniqueness(),
        "raw_missing": p.raw_missing(),
        "raw_churn_values": p.raw_frequencies("churn", "raw_churn_value"),
        "raw_contract_values": p.raw_frequencies("contract"),
        "raw_payment_values": p.raw_frequencies("payment_method"),
        "raw_duplicate_keys": p.raw_duplicate_keys(),
    }
    for name, want in single.items():
        got = combined[name]
        assert got.columns == want.columns, name
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()], name


def test_grouped_reports_from_one_aggregate_equal_direct_statements(spark, tmp_out):
    from churnlens.plans import reports

    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "cells"))
    c = p.cleaned
    plan = p.report_cells._jdf.queryExecution().executedPlan().toString()
    g = reports.grouped_tables(reports.report_cells(c))
    assert "Expand" in _plan_text(reports.report_cells(c))
    direct = {
        "churn_summary": reports.churn_summary(c, 4),
        "churn_distribution": reports.churn_summary(c, 2),
        "freq_contract": reports.category_counts(c, "contract"),
        "freq_payment": reports.category_counts(c, "payment_method"),
        "freq_tenure_group": reports.category_counts(c, "tenure_group"),
        "rate_contract_payment": reports.rate_contract_payment(c, 4),
        "contract_payment": reports.rate_contract_payment_report(c),
        "tenure_satisfaction": reports.rate_tenure_satisfaction(c),
        "complaints_calls": reports.rate_complaints_calls(c),
        "usage_support": reports.rate_usage_support(c),
        "charge_contract": reports.rate_charge_contract(c),
    }
    assert set(direct) | {"mapreduce_rate"} == set(g)
    for name, want in direct.items():
        got = g[name]
        assert got.columns == want.columns, name
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()], name
    assert sorted(tuple(r) for r in g["mapreduce_rate"].collect()) == sorted(tuple(r) for r in mapreduce_rate(c).collect())
    assert plan  # the stored cells table is a plain scan


def _plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaned_summary_from_one_aggregate_equals_direct_statements(spark, tmp_out):
    from churnlens.operators.quality import cleaned_check
    from churnlens.plans import reports

    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "sum"))
    c = p.cleaned
    one = reports.summary_tables(c, p._store)
    direct = {
        "cleaned_check": cleaned_check(c),
        "cleaned_nulls": reports.cleaned_nulls(c),
        "describe_numeric": reports.descriptive_stats(c),
    }
    for name, want in direct.items():
        assert one[name].columns == want.columns, name
        assert [tuple(r) for r in one[name].collect()] == [tuple(r) for r in want.collect()], name


def test_validation_from_one_aggregate_equals_direct_statements(spark, tmp_out):
    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "val"))
    one = p.validation
    direct = {
        "typed_required_nulls": p.typed_required_nulls(),
        "typed_analytic_nulls": p.typed_analytic_nulls(),
    }
    for name, want in direct.items():
        assert one[name].columns == want.columns, name
        assert [tuple(r) for r in one[name].collect()] == [tuple(r) for r in want.collect()], name
    excluded = {r["row_id"] for r in p.typed.filter("customer_id IS NULL OR churn IS NULL").collect()}
    shown = {r["row_id"] for r in one["typed_invalid_rows"].collect()}
    assert shown <= excluded and len(shown) == min(100, len(excluded))


def test_reports_are_written_whole(spark, tmp_out, capsys):
    from churnlens.__main__ import write_reports

    wide = spark.range(250).selectExpr("concat('group ', id) AS name", "id AS customer_count")
    write_reports({"wide": wide, "export_path": "somewhere"}, tmp_out)
    assert spark.read.parquet(os.path.join(tmp_out, "reports", "wide")).count() == 250
    said = capsys.readouterr().out
    assert f"wide: {tmp_out}/reports/wide" in said and "export_path: somewhere" in said


def test_stages_may_be_asked_for_twice(spark, tmp_out):
    p = AttritionPipeline(spark, raw_records(spark, SF_SMALL), workdir=os.path.join(tmp_out, "twice"))
    first = p.validation["typed_required_nulls"]
    assert p.validation["typed_required_nulls"] is first
    assert p.checks["cleaned_check"] is p.checks["cleaned_check"]
    assert first.count() == 1


def test_no_shared_folder_is_an_error():
    from churnlens import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session(), "x")


def test_jvm_flags_are_added_to_those_of_the_cluster(monkeypatch):
    from churnlens import session

    class Conf:
        def get(self, key, default=None):
            return "-Dmine=1" if "executor" in key else default

    monkeypatch.setattr(session, "SparkConf", Conf)
    got = session._with_jvm_flag("-XX:+Flag")
    assert got == {"spark.driver.extraJavaOptions": "-XX:+Flag", "spark.executor.extraJavaOptions": "-Dmine=1 -XX:+Flag"}


def test_locations_are_quoted(spark, tmp_out):
    from churnlens.schema import TYPED_SCHEMA
    from churnlens.sources import create_database, declare_orc_table, drop_table

    create_database(spark, "churn_quote_db")
    place = os.path.join(tmp_out, "it's here")
    declare_orc_table(spark, "churn_quote_db.t", TYPED_SCHEMA, place)
    assert spark.table("churn_quote_db.t").columns == TYPED_SCHEMA.names
    drop_table(spark, "churn_quote_db.t")
