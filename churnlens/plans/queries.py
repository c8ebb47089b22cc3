"""Named queries over the order-derived fixture: one per operator.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame.  All of them
read the whole fixture (every order is one raw record).  The typed, de-duplicated
and cleaned stages are written once per session and data folder and shared.
``combined_*`` queries take their rows from the combined aggregates that the batch
script runs; ``ordered_*`` queries number the rows of a report in its order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators import bands
from churnlens.operators.incremental import RunningCells
from churnlens.operators.quality import FILTER_BITS, cleaned_check, count_and_range, duplicate_keys, null_counts_of_counts, row_count
from churnlens.operators.quantiles import attach_scalars, quantile_thresholds
from churnlens.operators.rates import mapreduce_rate
from churnlens.plans import reports
from churnlens.plans.clean import CHARGE, USAGE, threshold_specs
from churnlens.plans.pipeline import TABLE_PREFIX, AttritionPipeline, catalog_pipeline
from churnlens.schema import CLEANED_COLUMNS, CLEANED_SCHEMA, COLUMNS, ROW_ID, TYPED_SCHEMA
from churnlens.session import scratch_dir
from churnlens.sinks.overwrite import swap_overwrite
from churnlens.sinks.writers import export_tsv, read_tsv
from churnlens.sources.csv_quoted import line_width_report, read_quoted_csv, write_quoted_csv
from churnlens.sources.csv_raw import read_raw_csv, write_raw_csv
from churnlens.sources.fixture import raw_records
from churnlens.sources.tables import declare_orc_table, describe_columns, describe_table, drop_table
from churnlens.streaming.ingest import latest_snapshot, start_running_rates, start_typed_ingest

Query = Callable[[SparkSession, str], DataFrame]

_PIPELINES: dict[tuple[str, str], AttritionPipeline] = {}


def pipeline(spark: SparkSession, sf_dir: str) -> AttritionPipeline:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PIPELINES:
        _PIPELINES[key] = AttritionPipeline(spark, raw_records(spark, sf_dir))
    return _PIPELINES[key]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir).raw


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir).cleaned


def _band(col: str | list[str], group: str) -> Query:
    cols = [col] if isinstance(col, str) else col
    return lambda s, d: _cleaned(s, d).select("customer_id", *cols, group)


def _thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    dedup = pipeline(spark, sf_dir).deduplicated
    names = {CHARGE: "charge", USAGE: "usage"}
    cuts = quantile_thresholds(dedup, threshold_specs(dedup))
    return cuts.select(*[F.get(k, F.lit(i)).alias(f"{names[k]}_p{i + 1}") for k in (CHARGE, USAGE) for i in range(2)])


def _banded_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two threshold bands with the cut points as an array column of a one-row frame."""
    dedup = pipeline(spark, sf_dir).deduplicated
    d = attach_scalars(dedup, quantile_thresholds(dedup, threshold_specs(dedup)))
    return d.select(
        "customer_id", bands.monthly_charge_band(F.col(CHARGE)).alias("monthly_charge_band"), bands.usage_band(F.col(USAGE)).alias("usage_band")
    )


def _filled_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    dedup = pipeline(spark, sf_dir).deduplicated
    filled = bands.fill_when("avg_monthly_gb", F.col("has_internet_service") == 0, 0.0)
    return dedup.select("customer_id", "has_internet_service", filled.alias("avg_monthly_gb"))


def _tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "export_tsv")
    export_tsv(_cleaned(spark, sf_dir), path)
    return read_tsv(spark, path, CLEANED_SCHEMA)


_RAW_CSV: dict[tuple[str, str], str] = {}


def _raw_csv_dir(spark: SparkSession, sf_dir: str) -> str:
    """The raw records written once as CSV files (the text input of a real run)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RAW_CSV:
        path = scratch_dir(spark, "raw_csv")
        write_raw_csv(_raw(spark, sf_dir).select(*COLUMNS), path)
        _RAW_CSV[key] = path
    return _RAW_CSV[key]


def _stream_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw records as CSV files, typed by the streaming ingest."""
    raw_dir = _raw_csv_dir(spark, sf_dir)
    out, ckpt = scratch_dir(spark, "stream_typed"), scratch_dir(spark, "stream_ckpt")
    start_typed_ingest(spark, raw_dir, out, ckpt).awaitTermination()
    return spark.read.schema(TYPED_SCHEMA).orc(out)


def _stream_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running contract x payment totals over the streamed raw files."""
    raw_dir = _raw_csv_dir(spark, sf_dir)
    out, ckpt = scratch_dir(spark, "stream_rates"), scratch_dir(spark, "stream_ckpt")
    start_running_rates(spark, raw_dir, out, ckpt).awaitTermination()
    return latest_snapshot(spark, out)


_CATALOG: dict[tuple[str, str], AttritionPipeline] = {}
CHECK_DB = "churnlens_check_db"


def _catalog(spark: SparkSession, sf_dir: str) -> AttritionPipeline:
    """Raw records as CSV behind a declared external table; typed and cleaned
    rows go through INSERT OVERWRITE into the declared ORC tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CATALOG:
        _CATALOG.clear()  # the tables are declared anew for another data folder
        _CATALOG[key] = catalog_pipeline(spark, _raw_csv_dir(spark, sf_dir), scratch_dir(spark, "catalog"), database=CHECK_DB)
    return _CATALOG[key]


def _catalog_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DESCRIBE of the filled cleaned table, with the table's row count."""
    p = _catalog(spark, sf_dir)
    rows = p.cleaned.agg(F.count(F.lit(1)).alias("table_rows"))
    return attach_scalars(describe_columns(spark, p.tables["cleaned_orc"]), rows)


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw_csv(spark, _raw_csv_dir(spark, sf_dir))


def quoted_records(raw: DataFrame) -> DataFrame:
    """The raw records with quotes and commas inside two text fields."""
    said = F.concat(F.lit('says "'), "education", F.lit('", or so, ""'))
    return raw.withColumns({"education": said, "gender": F.concat(F.lit('"'), F.coalesce("gender", F.lit("")), F.lit('",'))})


def _csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with quoted quotes: one half of the files doubles them, the other escapes them."""
    rows = quoted_records(_raw(spark, sf_dir))
    doubled, escaped = scratch_dir(spark, "raw_csv_doubled"), scratch_dir(spark, "raw_csv_escaped")
    write_quoted_csv(rows.where(F.col(ROW_ID) % 2 == 0).select(*COLUMNS), doubled)
    write_raw_csv(rows.where(F.col(ROW_ID) % 2 == 1).select(*COLUMNS), escaped)
    return read_quoted_csv(spark, [doubled, escaped])


def _csv_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some lack their last field and some have one more."""
    path = scratch_dir(spark, "raw_lines")
    whole, short = (F.to_csv(F.struct(*cols), {"nullValue": ""}) for cols in (COLUMNS, COLUMNS[:-1]))
    line = F.when(F.col(ROW_ID) % 97 == 0, short).when(F.col(ROW_ID) % 89 == 0, F.concat(whole, F.lit(",more"))).otherwise(whole)
    _raw(spark, sf_dir).select(line.alias("value")).write.text(path)
    return line_width_report(spark, path, header=False)


def _overwrite_survives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed table after an overwrite that failed on some rows: still the rows of before."""
    p = _catalog(spark, sf_dir)
    typed, table = p.typed, p.tables["typed_orc"]
    wrong = F.when(F.col("age") > 60, F.raise_error(F.lit("bad row")).cast("int")).otherwise(F.col("age"))
    try:
        swap_overwrite(typed.withColumn("age", wrong), table)
    except PySparkException as e:
        if "bad row" not in str(e):
            raise
    else:
        raise AssertionError("the overwrite should have failed")
    return spark.table(table)


def _preview_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unordered preview: how many rows it has, and how many of them are raw rows."""
    raw = pipeline(spark, sf_dir).raw_stored
    shown = spark.createDataFrame(pipeline(spark, sf_dir).raw_preview(10).collect(), raw.schema)  # ten rows, fixed
    found = raw.join(F.broadcast(shown.select(F.col(ROW_ID).alias("__shown"))), F.col(ROW_ID) == F.col("__shown"), "left_semi").intersect(shown)
    return attach_scalars(shown.agg(F.count(F.lit(1)).alias("preview_rows")), found.agg(F.count(F.lit(1)).alias("raw_rows")))


def _dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that are read from the files of an external table after it was dropped."""
    p = _catalog(spark, sf_dir)
    name, place = f"{CHECK_DB}.dropped_rows", scratch_dir(spark, "dropped")
    declare_orc_table(spark, name, TYPED_SCHEMA, place)
    swap_overwrite(p.typed, name)
    drop_table(spark, name)
    if spark.catalog.tableExists(name):
        raise AssertionError("the table should be gone")
    return spark.read.schema(TYPED_SCHEMA).orc(place)


def _describe_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extended description of the declared tables, as far as it doesn't hold places and times."""
    kinds = {"raw": CHECK_DB, "typed": CHECK_DB, "cleaned": CHECK_DB}
    _catalog(spark, sf_dir)
    out = None
    for n, db in kinds.items():
        rows = describe_table(spark, f"{db}.{TABLE_PREFIX}{n}").where(F.col("col_name").isin("Database", "Table", "Type", "Provider"))
        rows = rows.select(F.lit(n).alias("described"), F.lower("col_name").alias("property"), F.lower("data_type").alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


_CLUSTERED: dict[tuple[str, str], AttritionPipeline] = {}
CLUSTERS = 8


def clustered_pipeline(spark: SparkSession, sf_dir: str) -> AttritionPipeline:
    """The run of ``pipeline`` with its deduplicated and cleaned tables clustered by customer."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CLUSTERED:
        p = pipeline(spark, sf_dir)
        _CLUSTERED[key] = AttritionPipeline(spark, p.__dict__.get("raw_stored", p.raw), stage_raw=False, clusters=CLUSTERS)
    return _CLUSTERED[key]


def _footer_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_and_range(pipeline(spark, sf_dir).cleaned_footers, ["tenure", "monthlycharges", "totalcharges"], "cleaned_rows")


def _footer_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipeline(spark, sf_dir).typed
    return row_count(pipeline(spark, sf_dir).footers("typed_orc"), "raw_record_count")


BATCHES = 3


def _running_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates per contract and payment method after the records came in three batches, newer and older ones mixed."""
    typed, keys = pipeline(spark, sf_dir).typed, ["contract", "payment_method"]
    newest = {"signup_date": F.col("signup_date").desc_nulls_last()}
    cells = RunningCells(spark, scratch_dir(spark, "running"), keys, "customer_id", "churn", newest, [ROW_ID])
    for n in range(BATCHES):
        cells.add(typed.where(F.col(ROW_ID) % BATCHES == n), n)
    return reports.finish_mapreduce_rate(cells.totals(BATCHES))


QUERIES: dict[str, Query] = {
    "preview_contained": _preview_contained,
    "dropped_table_rows": _dropped,
    "catalog_describe_extended": _describe_extended,
    "duplicate_keys_filtered": lambda s, d: duplicate_keys(
        pipeline(s, d).raw_stored, "customer_id", 100, key_expr=F.trim(F.col("customer_id")), filter_bits=FILTER_BITS
    ),
    "footer_row_count": _footer_count,
    "footer_ranges": _footer_ranges,
    "footer_cleaned_nulls": lambda s, d: null_counts_of_counts(pipeline(s, d).cleaned_footers, reports.CLEANED_NULLS),
    "clustered_latest_per_key": lambda s, d: clustered_pipeline(s, d).deduplicated,
    "clustered_cleaned_rows": lambda s, d: clustered_pipeline(s, d).cleaned.select(*CLEANED_COLUMNS),
    "clustered_cleaned_check": lambda s, d: cleaned_check(clustered_pipeline(s, d).cleaned),
    "running_rates": _running_rates,
    "raw_csv_quoted": _csv_quoted,
    "raw_csv_widths": _csv_widths,
    "overwrite_survives_failure": _overwrite_survives,
    "row_count": lambda s, d: pipeline(s, d).raw_count(),
    "preview": lambda s, d: pipeline(s, d).raw_preview(10, order=[ROW_ID]),
    "raw_csv_roundtrip": _csv_roundtrip,
    "key_uniqueness": lambda s, d: pipeline(s, d).raw_key_uniqueness(),
    "duplicate_keys": lambda s, d: pipeline(s, d).raw_duplicate_keys(100),
    "missing_report": lambda s, d: pipeline(s, d).raw_missing(),
    "freq_raw_churn": lambda s, d: pipeline(s, d).raw_frequencies("churn", "raw_churn_value"),
    "freq_raw_contract": lambda s, d: pipeline(s, d).raw_frequencies("contract"),
    "freq_raw_payment": lambda s, d: pipeline(s, d).raw_frequencies("payment_method"),
    "typed_rows": lambda s, d: pipeline(s, d).typed,
    "typed_nulls_required": lambda s, d: pipeline(s, d).typed_required_nulls(),
    "typed_nulls_analytic": lambda s, d: pipeline(s, d).typed_analytic_nulls(),
    "invalid_rows": lambda s, d: pipeline(s, d).typed_invalid(100, order=[ROW_ID]),
    "latest_per_key": lambda s, d: pipeline(s, d).deduplicated,
    "quantile_thresholds": _thresholds,
    "filled_usage": _filled_usage,
    "tenure_group": _band("tenure", "tenure_group"),
    "satisfaction_group": _band("customer_satisfaction", "satisfaction_group"),
    "complaint_group": _band("num_complaints", "complaint_group"),
    "service_call_group": _band("num_service_calls", "service_call_group"),
    "late_payment_group": _band("late_payments", "late_payment_group"),
    "interaction_recency_group": _band("days_since_last_interaction", "interaction_recency_group"),
    "monthly_charge_band": _band("monthlycharges", "monthly_charge_band"),
    "usage_band": _band(["has_internet_service", "avg_monthly_gb"], "usage_band"),
    "cleaned_rows": lambda s, d: _cleaned(s, d).select(*CLEANED_COLUMNS),
    "cleaned_check": lambda s, d: cleaned_check(_cleaned(s, d)),
    "share_of_total_4dp": lambda s, d: reports.churn_summary(_cleaned(s, d), 4),
    "share_of_total_2dp": lambda s, d: reports.churn_summary(_cleaned(s, d), 2),
    "describe_numeric": lambda s, d: reports.descriptive_stats(_cleaned(s, d)),
    "freq_contract": lambda s, d: reports.category_counts(_cleaned(s, d), "contract"),
    "freq_payment": lambda s, d: reports.category_counts(_cleaned(s, d), "payment_method"),
    "freq_tenure_group": lambda s, d: reports.category_counts(_cleaned(s, d), "tenure_group"),
    "cleaned_nulls": lambda s, d: reports.cleaned_nulls(_cleaned(s, d)),
    "rate_contract_payment_4dp": lambda s, d: reports.rate_contract_payment(_cleaned(s, d), 4),
    "tsv_roundtrip": _tsv_roundtrip,
    "rate_contract_payment_2dp": lambda s, d: reports.rate_contract_payment_report(_cleaned(s, d)),
    "rate_tenure_satisfaction": lambda s, d: reports.rate_tenure_satisfaction(_cleaned(s, d)),
    "rate_complaints_calls": lambda s, d: reports.rate_complaints_calls(_cleaned(s, d)),
    "rate_usage_support": lambda s, d: reports.rate_usage_support(_cleaned(s, d)),
    "rate_charge_contract": lambda s, d: reports.rate_charge_contract(_cleaned(s, d)),
    "mapreduce_rate": lambda s, d: mapreduce_rate(_cleaned(s, d)),
    "threshold_bands_by_column": _banded_by_column,
    "catalog_typed_rows": lambda s, d: _catalog(s, d).typed,
    "catalog_cleaned_rows": lambda s, d: _catalog(s, d).cleaned.select(*CLEANED_COLUMNS),
    "catalog_describe": _catalog_describe,
    "stream_typed_rows": _stream_typed,
    "stream_running_rates": _stream_rates,
}


# ---- the combined path: what the batch script runs ------------------------
#: combined frame -> the one-statement query with the same result
COMBINED = {
    "profile": {
        "raw_record_count": "row_count",
        "raw_key_uniqueness": "key_uniqueness",
        "raw_missing": "missing_report",
        "raw_churn_values": "freq_raw_churn",
        "raw_contract_values": "freq_raw_contract",
        "raw_payment_values": "freq_raw_payment",
        "raw_duplicate_keys": "duplicate_keys",
    },
    "validation": {"typed_required_nulls": "typed_nulls_required", "typed_analytic_nulls": "typed_nulls_analytic"},
    "checks": {
        "cleaned_check": "cleaned_check",
        "churn_summary": "share_of_total_4dp",
        "describe_numeric": "describe_numeric",
        "freq_contract": "freq_contract",
        "freq_payment": "freq_payment",
        "freq_tenure_group": "freq_tenure_group",
        "cleaned_nulls": "cleaned_nulls",
        "rate_contract_payment": "rate_contract_payment_4dp",
    },
    "report_tables": {
        "churn_distribution": "share_of_total_2dp",
        "contract_payment": "rate_contract_payment_2dp",
        "tenure_satisfaction": "rate_tenure_satisfaction",
        "complaints_calls": "rate_complaints_calls",
        "usage_support": "rate_usage_support",
        "charge_contract": "rate_charge_contract",
        "mapreduce_rate": "mapreduce_rate",
    },
}


def _combined(part: str, name: str) -> Query:
    return lambda s, d: getattr(pipeline(s, d), part)[name]


#: combined query -> its one-statement twin
TWINS = {f"combined_{name}": twin for part in COMBINED.values() for name, twin in part.items()}
QUERIES.update({f"combined_{name}": _combined(part, name) for part, names in COMBINED.items() for name in names})

# ---- report order: each row with its place in the business order -----------
#: ordered query -> the query whose rows it numbers
ORDERED: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "ordered_share_of_total": ("share_of_total_4dp", lambda c: reports.churn_summary(c, 4, "position")),
    "ordered_freq_contract": ("freq_contract", lambda c: reports.category_counts(c, "contract", "position")),
    "ordered_freq_payment": ("freq_payment", lambda c: reports.category_counts(c, "payment_method", "position")),
    "ordered_freq_tenure_group": ("freq_tenure_group", lambda c: reports.category_counts(c, "tenure_group", "position")),
    "ordered_rate_contract_payment": ("rate_contract_payment_4dp", lambda c: reports.rate_contract_payment(c, 4, "position")),
    "ordered_contract_payment_report": ("rate_contract_payment_2dp", lambda c: reports.rate_contract_payment_report(c, "position")),
    "ordered_tenure_satisfaction": ("rate_tenure_satisfaction", lambda c: reports.rate_tenure_satisfaction(c, "position")),
    "ordered_complaints_calls": ("rate_complaints_calls", lambda c: reports.rate_complaints_calls(c, "position")),
    "ordered_usage_support": ("rate_usage_support", lambda c: reports.rate_usage_support(c, "position")),
    "ordered_charge_contract": ("rate_charge_contract", lambda c: reports.rate_charge_contract(c, "position")),
}


def _ordered(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, d: make(_cleaned(s, d))


QUERIES.update({name: _ordered(make) for name, (_, make) in ORDERED.items()})
