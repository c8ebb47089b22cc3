"""Quoted CSV against Python's csv module; overwrites that fail."""

from __future__ import annotations

import csv
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.plans.pipeline import catalog_pipeline
from churnlens.schema import COLUMNS, RAW_SCHEMA
from churnlens.sinks.overwrite import remove_old_versions, swap_overwrite
from churnlens.sources import csv_quoted
from churnlens.sources.csv_raw import read_raw_csv
from churnlens.sources.fixture import raw_records
from churnlens.sources.tables import create_database, declare_orc_table, drop_table, table_location

from conftest import SF_SMALL

FOUR = T.StructType([T.StructField(c, T.StringType()) for c in "abcd"])


def _spell(value: str, rng: random.Random) -> str:
    """A field in one of the spellings that the dialect allows."""
    if rng.random() < 0.3 and not set(value) & set(',"\\') and value.strip() == value:
        return value
    out = ""
    for c in value:
        if c == '"':
            out += rng.choice(['\\"', '""'])
        elif c == "\\":
            out += "\\\\"
        else:
            out += "\\" * (c.isalpha() and rng.random() < 0.1) + c
    return f'"{out}"'


@pytest.mark.parametrize("seed", range(3))
def test_quoted_fields_read_as_pythons_csv_does(spark, tmp_out, seed):
    rng = random.Random(seed)
    rows = [["".join(rng.choice("ab,\"\\ é'") for _ in range(rng.randint(0, 9))) for _ in range(4)] for _ in range(1500)]
    lines = [",".join(_spell(v, rng) for v in r) for r in rows]
    want = list(csv.reader(lines, escapechar="\\", doublequote=True))
    assert want == rows
    for i in range(3):
        with open(os.path.join(tmp_out, f"part{i}.csv"), "w", encoding="utf-8") as f:
            f.write("\n".join(["a,b,c,d", *lines[i::3]]) + "\n")
    # splits of a few kilobytes: the header goes once a file, no line is lost or cut
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = csv_quoted.read_quoted_csv(spark, tmp_out, FOUR)
        assert df.rdd.getNumPartitions() > 3
        got = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted(map(tuple, rows))


def test_quoted_scan_runs_without_python_and_equals_the_plain_scan(spark, tmp_out):
    rows = raw_records(spark, SF_SMALL).select(*COLUMNS)
    csv_quoted.write_quoted_csv(rows, os.path.join(tmp_out, "raw"))
    plain, quoted = read_raw_csv(spark, os.path.join(tmp_out, "raw")), csv_quoted.read_quoted_csv(spark, os.path.join(tmp_out, "raw"))
    assert plain.schema == quoted.schema == RAW_SCHEMA or [f.name for f in quoted.schema] == COLUMNS
    assert plain.exceptAll(quoted).count() == 0 and plain.count() == quoted.count()
    plan = quoted._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Exchange"))


def test_lines_of_other_widths_are_told(spark, tmp_out):
    with open(os.path.join(tmp_out, "w.csv"), "w", encoding="utf-8") as f:
        f.write('a,b,c,d\na,b,c\na,b,c,d,e\n"a",b,c,\n,,,\n\na\n"a,",b"",c,"d"\n')
    r = csv_quoted.line_width_report(spark, tmp_out, FOUR).first()
    assert (r["total_lines"], r["wrong_width_lines"]) == (6, 3)
    rows = csv_quoted.read_quoted_csv(spark, tmp_out, FOUR).collect()
    assert [tuple(r) for r in rows] == [("a", "b", "c", ""), ("a", "b", "c", "d"), ("a", "b", "c", ""), ("", "", "", ""), ("a", "", "", ""), ("a,", 'b""', "c", "d")]


DB = "churnlens_swap_db"


def _table(spark, tmp_out, name="t"):
    create_database(spark, DB)
    t = f"{DB}.{name}"
    drop_table(spark, t)
    declare_orc_table(spark, t, T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())]), os.path.join(tmp_out, name))
    return t


def test_a_killed_overwrite_leaves_the_old_rows(spark, tmp_out):
    t = _table(spark, tmp_out)
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    first = swap_overwrite(rows, t)
    # fails in the last of eight tasks, after the others have written their files
    bad = spark.range(0, 1000, 1, 8).select(F.col("id").alias("k"), F.when(F.col("id") < 990, "new").otherwise(F.raise_error(F.lit("killed"))).alias("v"))
    with pytest.raises(PySparkException, match="killed"):
        swap_overwrite(bad, t)
    assert table_location(spark, t).endswith(first.rsplit("/", 1)[-1])
    assert spark.table(t).where("v = 'old'").count() == 1000 == spark.table(t).count()


def test_an_overwrite_of_a_table_by_its_own_rows(spark, tmp_out):
    t = _table(spark, tmp_out)
    swap_overwrite(spark.range(10).select(F.lit("a").alias("v"), F.col("id").cast("int").alias("k")), t)  # by name, cast
    swap_overwrite(spark.table(t).where("k >= 5"), t)
    assert sorted(r["k"] for r in spark.table(t).collect()) == [5, 6, 7, 8, 9]
    assert remove_old_versions(spark, t) == 1 and remove_old_versions(spark, t) == 0
    assert spark.table(t).count() == 5


def test_declaring_again_keeps_the_rows_of_the_last_run(spark, tmp_out):
    csv_quoted.write_quoted_csv(raw_records(spark, SF_SMALL).select(*COLUMNS), os.path.join(tmp_out, "raw"))
    p = catalog_pipeline(spark, os.path.join(tmp_out, "raw"), tmp_out, database=DB)
    n = p.typed.count()
    again = catalog_pipeline(spark, os.path.join(tmp_out, "raw"), tmp_out, database=DB)
    assert spark.table(again.tables["typed_orc"]).count() == n > 0 and spark.table(again.tables["cleaned_orc"]).count() == 0
