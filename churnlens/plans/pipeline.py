"""The staged attrition job: raw -> typed ORC -> cleaned ORC -> reports -> TSV.

Stages are written, not cached: a written ORC table survives executor loss,
is shared by every later query, and cuts the lineage.  Locations default to
the shared checkpoint folder; pass ``workdir`` for real table prefixes.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators.quality import (
    by_frequency,
    distinct_count,
    duplicate_keys,
    invalid_rows,
    key_uniqueness,
    key_uniqueness_finish,
    missing_aggs,
    missing_finish,
    missing_report,
    normalised,
    null_counts_of_counts,
    preview,
    row_count,
    value_frequencies,
)
from churnlens.operators.quantiles import attach_scalars
from churnlens.operators.typing import type_rows
from churnlens.plans import reports
from churnlens.plans.clean import clean, deduplicate
from churnlens.schema import CLEANED_SCHEMA, COLUMNS, RAW_SCHEMA, ROW_ID, TYPED_SCHEMA
from churnlens.session import compiled_methods, scratch_dir
from churnlens.sinks.overwrite import first_location, swap_overwrite
from churnlens.sinks.writers import export_tsv, read_tsv
from churnlens.sources.csv_quoted import read_quoted_csv
from churnlens.sources.tables import (
    create_database,
    declare_csv_table,
    declare_orc_table,
    describe_table,
    drop_table,
    scan_footers,
    store_clustered,
    table_location,
    use_database,
)

# --- fixed values: profiled fields and the check output names ---------------
MISSING_FIELDS = [
    "customer_id",
    "signup_date",
    "tenure",
    "contract",
    "payment_method",
    "monthlycharges",
    "totalcharges",
    "customer_satisfaction",
    "num_complaints",
    "avg_monthly_gb",
    "churn",
]
FREQUENCY_FIELDS = ["churn", "contract", "payment_method"]
REQUIRED_NULLS = {
    "missing_customer_id": "customer_id",
    "invalid_or_missing_signup_date": "signup_date",
    "invalid_or_missing_churn": "churn",
}
ANALYTIC_NULLS = {
    "invalid_or_missing_age": "age",
    "invalid_or_missing_income": "annual_income",
    "invalid_or_missing_tenure": "tenure",
    "invalid_or_missing_monthlycharges": "monthlycharges",
    "invalid_or_missing_totalcharges": "totalcharges",
    "invalid_or_missing_satisfaction": "customer_satisfaction",
    "invalid_or_missing_usage": "avg_monthly_gb",
}


class AttritionPipeline:
    """One run over one raw frame; each stage is written once, on first use."""

    def __init__(
        self,
        spark: SparkSession,
        raw: DataFrame,
        workdir: str | None = None,
        quantile_method: str = "exact",
        accuracy: int | None = None,
        stage_raw: bool = True,
        tables: dict[str, str] | None = None,
        clusters: int | None = None,
    ) -> None:
        self.spark = spark
        self.raw = raw
        self.workdir = workdir or scratch_dir(spark, "pipeline")
        self.quantile_method = quantile_method
        self.accuracy = accuracy
        self.stage_raw = stage_raw
        self.tables = tables or {}
        self.clusters = clusters  # buckets of the deduplicated and cleaned tables, by customer

    def _path(self, name: str) -> str:
        return f"{self.workdir}/{name}"

    def _store(self, df: DataFrame, name: str) -> DataFrame:
        """Write a stage once: overwrite its catalog table when one is bound to
        the stage (old rows stay until the new ones are whole), else ORC under
        ``workdir``; return its scan."""
        table = self.tables.get(name)
        if table:
            with compiled_methods(self.spark):
                swap_overwrite(df, table)
            return self.spark.table(table)
        path = self._path(name)
        with compiled_methods(self.spark):
            df.write.mode("overwrite").orc(path)
        return self.spark.read.orc(path)

    def _store_by_key(self, df: DataFrame, name: str, key: str = "customer_id") -> DataFrame:
        """``_store``, clustered by the key's hash if the run has ``clusters``."""
        if self.clusters is None or name in self.tables:
            return self._store(df, name)
        with compiled_methods(self.spark):
            return store_clustered(df, f"churnlens_{name}_{uuid.uuid4().hex[:12]}", self._path(name), key, self.clusters)

    def footers(self, name: str) -> DataFrame:
        """The files of a written stage, for counts and ranges that their footers answer."""
        table = self.tables.get(name)
        return scan_footers(self.spark, table_location(self.spark, table) if table else self._path(name))

    # ---- stages ---------------------------------------------------------
    @cached_property
    def raw_stored(self) -> DataFrame:
        """The raw text parsed once into columnar ORC.

        Every profile query and the typing stage read the raw input; from ORC
        each reads only the columns it uses, instead of re-parsing (or, for a
        derived input, recomputing) all 32 columns per query.  With
        ``stage_raw=False`` the input is used as it is: right for one that
        already is a columnar scan.  The preview and the row count always
        read the input itself, and so does the typing stage unless the copy
        is there already: a run that asks for no profile needs no copy.
        """
        return self._store(self.raw, "raw_orc") if self.stage_raw else self.raw

    @cached_property
    def typed(self) -> DataFrame:
        """Typed rows (32 columns, plus the row key when the raw input has one)."""
        raw = self.__dict__.get("raw_stored", self.raw)  # the copy, if this run has made it
        return self._store(type_rows(raw, passthrough=[ROW_ID]), "typed_orc")

    @cached_property
    def deduplicated(self) -> DataFrame:
        return self._store_by_key(deduplicate(self.typed), "deduplicated")

    @cached_property
    def cleaned(self) -> DataFrame:
        out = clean(
            self.typed,
            method=self.quantile_method,
            accuracy=self.accuracy,
            materialize=lambda df, name: self.deduplicated,
        )
        return self._store_by_key(out, "cleaned_orc")

    def export(self, path: str | None = None, compression: str | None = "gzip") -> str:
        path = path or self._path("export_tsv")
        export_tsv(self.cleaned, path, compression=compression)
        return path

    def read_export(self, path: str) -> DataFrame:
        return read_tsv(self.spark, path, CLEANED_SCHEMA)

    # ---- profile of the raw input ---------------------------------------
    def raw_count(self) -> DataFrame:
        return row_count(self.raw, "raw_record_count")

    def raw_preview(self, n: int = 10, order: list[str] | None = None) -> DataFrame:
        """Any ``n`` raw rows (reads as few splits as it needs); a fixed choice with ``order``."""
        return preview(self.raw, n, order=order)

    def raw_key_uniqueness(self) -> DataFrame:
        return key_uniqueness(self.raw_stored, F.trim(F.col("customer_id")))

    def raw_duplicate_keys(self, limit: int = 100) -> DataFrame:
        return duplicate_keys(self.raw_stored, "customer_id", limit, key_expr=F.trim(F.col("customer_id")))

    def raw_missing(self) -> DataFrame:
        return missing_report(self.raw_stored, MISSING_FIELDS)

    def raw_frequencies(self, col: str, alias: str | None = None) -> DataFrame:
        return value_frequencies(self.raw_stored, col, normalise=True, alias=alias)

    @cached_property
    def profile(self) -> dict[str, DataFrame]:
        """The raw profile in four scans instead of seven.

        Row count and missing values are one global aggregate; the distinct
        keys are counted over the key column alone; the three category
        frequencies are one ``groupBy`` over (field, value) pairs, combined
        map-side.  The small results are written once and every report frame
        is a slice of them.  The duplicate-key top 100 needs its own shuffle
        by key.
        """
        raw = self.raw_stored
        sums = raw.agg(F.count(F.lit(1)).alias("total_rows"), *missing_aggs(MISSING_FIELDS))
        ids = distinct_count(raw, F.trim(F.col("customer_id")), "distinct_customer_ids")
        summary = self._store(attach_scalars(sums, ids), "raw_profile_summary")
        pairs = F.array(*[F.struct(F.lit(c).alias("field"), normalised(c).alias("value")) for c in FREQUENCY_FIELDS])
        freq = raw.select(F.explode(pairs).alias("p")).groupBy("p.field", "p.value").agg(
            F.count(F.lit(1)).alias("record_count")
        )
        freq = self._store(freq, "raw_profile_frequencies")

        def frequencies(field: str, alias: str) -> DataFrame:
            return by_frequency(freq.filter(F.col("field") == field).select(F.col("value").alias(alias), "record_count"), alias)

        return {
            "raw_record_count": summary.select(F.col("total_rows").alias("raw_record_count")),
            "raw_key_uniqueness": key_uniqueness_finish(summary, "total_rows", "distinct_customer_ids", "duplicate_customer_id_rows"),
            "raw_missing": missing_finish(summary, MISSING_FIELDS),
            "raw_churn_values": frequencies("churn", "raw_churn_value"),
            "raw_contract_values": frequencies("contract", "contract"),
            "raw_payment_values": frequencies("payment_method", "payment_method"),
            "raw_duplicate_keys": self.raw_duplicate_keys(),
        }

    # ---- validation of the typed table ----------------------------------
    @cached_property
    def typed_footers(self) -> DataFrame:
        self.typed  # written first
        return self.footers("typed_orc")

    @cached_property
    def cleaned_footers(self) -> DataFrame:
        self.cleaned  # written first
        return self.footers("cleaned_orc")

    def typed_required_nulls(self) -> DataFrame:
        return null_counts_of_counts(self.typed_footers, REQUIRED_NULLS, total="total_rows")

    def typed_analytic_nulls(self) -> DataFrame:
        return null_counts_of_counts(self.typed_footers, ANALYTIC_NULLS)

    @cached_property
    def validation(self) -> dict[str, DataFrame]:
        """Both NULL reports of the typed table from the counts in its files'
        footers (written once), plus a bounded look at the rows to be excluded."""
        row = self._store(null_counts_of_counts(self.typed_footers, REQUIRED_NULLS | ANALYTIC_NULLS, total="total_rows"), "typed_validation")
        return {
            "typed_required_nulls": row.select("total_rows", *REQUIRED_NULLS),
            "typed_analytic_nulls": row.select(*ANALYTIC_NULLS),
            "typed_invalid_rows": self.typed_invalid(),
        }

    def typed_invalid(self, limit: int = 100, order: list[str] | None = None) -> DataFrame:
        """Any ``limit`` rows that will be excluded; a fixed choice with ``order``."""
        return invalid_rows(self.typed, ["customer_id", "churn"], limit, order=order)

    # ---- checks and reports on the cleaned table --------------------------
    @cached_property
    def report_cells(self) -> DataFrame:
        """Cells of every grouped check and report: one scan, one shuffle, written once."""
        return self._store(reports.report_cells(self.cleaned), "report_cells")

    @cached_property
    def grouped(self) -> dict[str, DataFrame]:
        return reports.grouped_tables(self.report_cells)

    @cached_property
    def checks(self) -> dict[str, DataFrame]:
        g = self.grouped
        one = reports.summary_tables(self.cleaned, self._store)
        return {
            "cleaned_check": one["cleaned_check"],
            "churn_summary": g["churn_summary"],
            "describe_numeric": one["describe_numeric"],
            "freq_contract": g["freq_contract"],
            "freq_payment": g["freq_payment"],
            "freq_tenure_group": g["freq_tenure_group"],
            "cleaned_nulls": one["cleaned_nulls"],
            "rate_contract_payment": g["rate_contract_payment"],
        }

    @cached_property
    def report_tables(self) -> dict[str, DataFrame]:
        names = ["churn_distribution", "contract_payment", "tenure_satisfaction", "complaints_calls", "usage_support", "charge_contract", "mapreduce_rate"]
        return {n: self.grouped[n] for n in names}


# --- fixed values: catalog names used by the batch script ---------------------
DATABASE = "customer_churn_db"
TABLE_PREFIX = "customer_churn_"


def declare_tables(spark: SparkSession, raw_location: str, base: str, database: str = DATABASE) -> tuple[str, str, str]:
    """CREATE and USE the database, then (re)declare the raw CSV, typed ORC and
    cleaned ORC external tables; returns their qualified names.  A typed or
    cleaned table that has been overwritten below ``base`` keeps its rows until
    it is overwritten again.  The session's current database is as before
    afterwards."""
    names = [f"{TABLE_PREFIX}{n}" for n in ("raw", "typed", "cleaned")]
    before = spark.catalog.currentDatabase()
    create_database(spark, database)
    use_database(spark, database)
    try:
        places = dict(zip(names, (raw_location, f"{base}/typed_orc", f"{base}/cleaned_orc")))
        for t in names:
            if t != names[0] and spark.catalog.tableExists(t):
                now = table_location(spark, t)
                if first_location(now).rstrip("/").endswith(places[t].rstrip("/")):
                    places[t] = now
            drop_table(spark, t)
        declare_csv_table(spark, names[0], RAW_SCHEMA, places[names[0]])
        declare_orc_table(spark, names[1], TYPED_SCHEMA, places[names[1]])
        declare_orc_table(spark, names[2], CLEANED_SCHEMA, places[names[2]])
    finally:
        use_database(spark, before)
    raw_t, typed_t, cleaned_t = (f"{database}.{t}" for t in names)
    return raw_t, typed_t, cleaned_t


def catalog_pipeline(spark: SparkSession, raw_location: str, base: str, database: str = DATABASE) -> AttritionPipeline:
    """A pipeline whose raw input is the files of the declared CSV table (read
    with quotes in quoted fields written either way) and whose typed and
    cleaned stages overwrite the declared ORC tables."""
    raw_t, typed_t, cleaned_t = declare_tables(spark, raw_location, base, database)
    raw = read_quoted_csv(spark, table_location(spark, raw_t))
    return AttritionPipeline(spark, raw, workdir=base, tables={"typed_orc": typed_t, "cleaned_orc": cleaned_t})


def run_script(
    spark: SparkSession,
    raw_location: str,
    base: str,
    database: str = DATABASE,
) -> dict[str, DataFrame | str]:
    """The whole batch script against a raw CSV prefix, with catalog tables.

    Declares the database and the three external tables (raw CSV, typed ORC,
    cleaned ORC) under ``base``, overwrites typed and cleaned, exports TSV,
    and returns every check and report frame.
    """
    p = catalog_pipeline(spark, raw_location, base, database)
    raw_t = f"{database}.{TABLE_PREFIX}raw"
    out: dict[str, DataFrame | str] = {
        "describe_raw": describe_table(spark, raw_t),
        "raw_preview": p.raw_preview(),
        **p.profile,
        **p.validation,
    }
    out.update(p.checks)
    out.update(p.report_tables)
    out["export_path"] = p.export(f"{base}/export_tsv")
    return out
