"""

``entry(spark)`` runs the flagship query (attrition rate by contract x payment
method over the cleaned table) on sf0.001.  ``queries()`` has one entry per
operator of the inventory, plus the combined aggregates that the batch script
runs, the reports with their row order, the catalog-table and streaming paths,
and, where their package is present, the corpus operators and the pipeline.
Every query reads its whole tables.  ``oracle_sql()`` gives the same results as
DuckDB SQL over the same parquet tables; it shares only value tables (labels,
band edges, word lists, output names) with the Spark code.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from churnlens.functions import labels  # noqa: E402
from churnlens.functions.typing_rules import DATE_PATTERN, FALSE_WORDS, TRUE_WORDS  # noqa: E402
from churnlens.operators import bands  # noqa: E402
from churnlens.operators.stats import STAT_NAMES  # noqa: E402
from churnlens.plans import reports  # noqa: E402
from churnlens.plans.pipeline import ANALYTIC_NULLS, MISSING_FIELDS, REQUIRED_NULLS  # noqa: E402
from churnlens.plans.queries import ORDERED, QUERIES, TWINS  # noqa: E402
from churnlens.schema import CLEANED_COLUMNS, CLEANED_SCHEMA, COLUMNS  # noqa: E402
from churnlens.sources.fixture import FLAG_MULTIPLIERS, FLAG_SPELLINGS  # noqa: E402

FLAGSHIP = "rate_contract_payment_4dp"

# The corpus operators are an optional subpackage: without its folder (or the
# pipeline module beside this file) the other queries still work.  Only the
# absence of these modules is tolerated; an error inside them is raised.
_CORPUS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_CORPUS_SQL: dict[str, str] = {}
try:
    from churnlens.llm.queries import ORACLES as _OP_SQL, QUERIES as _OPS
except ModuleNotFoundError as e:
    if e.name not in ("churnlens.llm", "churnlens.llm.queries"):
        raise
else:
    _CORPUS.update(_OPS)
    _CORPUS_SQL.update(_OP_SQL)
    try:
        import corpus_pipeline
    except ModuleNotFoundError as e:
        if e.name != "corpus_pipeline":
            raise
    else:
        _CORPUS["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            _CORPUS_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    return QUERIES[FLAGSHIP](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, **_CORPUS}


# ----------------------------------------------------------------------------
# Oracle SQL (DuckDB dialect)
# ----------------------------------------------------------------------------


def _flag_sql(mult: int) -> str:
    whens = " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(FLAG_SPELLINGS))
    return f"CASE ((k*{mult}) % 101) % 10 {whens} END"


_RAW_EXPR = {
    "customer_id": "CASE WHEN k%211=0 THEN '' WHEN k%223=0 THEN NULL WHEN k%7=0 THEN ' '||CAST(ck AS VARCHAR)||' ' ELSE CAST(ck AS VARCHAR) END",
    "signup_date": "CASE WHEN k%101=0 THEN '2024-02-30' WHEN k%103=0 THEN '03/04/2024' WHEN k%107=0 THEN '' ELSE CAST(CAST(od AS DATE) AS VARCHAR) END",
    "age": "CASE WHEN k%89=0 THEN 'abc' WHEN k%83=0 THEN '150' ELSE CAST(18+ck%70 AS VARCHAR) END",
    "gender": "CASE k%4 WHEN 0 THEN ' Male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'female ' ELSE '' END",
    "annual_income": "CAST(bal AS VARCHAR)",
    "education": "pri",
    "marital_status": "CASE k%3 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' END",
    "dependents": "CAST(k%6-1 AS VARCHAR)",
    "tenure": "CASE WHEN k%61=0 THEN '12.7' WHEN k%67=0 THEN NULL ELSE CAST(k%72 AS VARCHAR) END",
    "contract": "CASE WHEN k%59=0 THEN NULL WHEN k%3=0 THEN 'Month-to-month' WHEN k%3=1 THEN ' One year' ELSE 'TWO YEAR' END",
    "payment_method": "CASE WHEN k%53=0 THEN '  ' ELSE seg END",
    "monthlycharges": "CASE WHEN k%47=0 THEN '-5' WHEN k%43=0 THEN '$12' ELSE CAST(tp AS VARCHAR) END",
    "totalcharges": "CAST(tp AS VARCHAR)",
    "num_services": "CAST(nl AS VARCHAR)",
    "customer_satisfaction": "CAST(k%7 AS VARCHAR)",
    "num_complaints": "CAST(nr AS VARCHAR)",
    "num_service_calls": "CAST(k%9-1 AS VARCHAR)",
    "late_payments": "CAST(k%8 AS VARCHAR)",
    "avg_monthly_gb": "CAST(qty AS VARCHAR)",
    "days_since_last_interaction": "CAST(k%120 AS VARCHAR)",
    "credit_score": "CAST(k%1100 AS VARCHAR)",
    "churn": "CASE WHEN k%11=0 THEN 'maybe' WHEN st='F' THEN 'Yes' ELSE '0' END",
    **{c: _flag_sql(m) for c, m in FLAG_MULTIPLIERS.items()},
}

_BASE = """SELECT o_orderkey k, o_custkey ck, o_orderdate od, o_totalprice tp, o_orderstatus st,
       o_orderpriority pri, c_acctbal bal, c_mktsegment seg, nl, qty, nr
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT l_orderkey, COUNT(*) nl, SUM(l_quantity) qty,
                  SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) nr
           FROM lineitem GROUP BY l_orderkey) x ON l_orderkey = o_orderkey"""


def _words(ws: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in ws)


# The number shapes are spelled here again, in this dialect's terms, so that a
# wrong pattern in the engine shows as a difference.
_WHOLE = r"^[+-]?[0-9]+([.][0-9]*)?$"
_DECIMAL = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _int_sql(c: str, lo: int, hi: int | None = None) -> str:
    v = f"(CASE WHEN regexp_matches(TRIM({c}), '{_WHOLE}') THEN TRY_CAST(split_part(TRIM({c}), '.', 1) AS INTEGER) END)"
    top = f" AND {v} <= {hi}" if hi is not None else ""
    return f"CASE WHEN {v} >= {lo}{top} THEN {v} END"


def _double_sql(c: str) -> str:
    v = f"TRY_CAST(TRIM({c}) AS DOUBLE)"
    return f"CASE WHEN regexp_matches(TRIM({c}), '{_DECIMAL}') AND isfinite({v}) AND {v} >= 0 THEN {v} END"


def _text_sql(c: str, lower: bool = True) -> str:
    t = f"LOWER(TRIM({c}))" if lower else f"TRIM({c})"
    return f"CASE WHEN {c} IS NULL OR TRIM({c}) = '' THEN NULL ELSE {t} END"


def _flag01_sql(c: str) -> str:
    w = f"LOWER(TRIM({c}))"
    return f"CASE WHEN {w} IN ({_words(TRUE_WORDS)}) THEN 1 WHEN {w} IN ({_words(FALSE_WORDS)}) THEN 0 END"


def _typed_expr(c: str) -> str:
    if c == "customer_id":
        return _text_sql(c, lower=False)
    if c == "signup_date":
        return f"CASE WHEN regexp_matches(TRIM({c}), '{DATE_PATTERN}') THEN TRY_CAST(TRIM({c}) AS DATE) END"
    if c in ("gender", "education", "marital_status", "contract", "payment_method"):
        return _text_sql(c)
    if c in ("annual_income", "monthlycharges", "totalcharges", "avg_monthly_gb"):
        return _double_sql(c)
    if c in FLAG_MULTIPLIERS or c == "churn":
        return _flag01_sql(c)
    ranges = {"age": (0, 120), "customer_satisfaction": (1, 5), "credit_score": (0, 1000)}
    lo, hi = ranges.get(c, (0, None))
    return _int_sql(c, lo, hi)


def _quoted(v: object) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _case(c: str, pairs: list[tuple[object, object]], rest: str = "") -> str:
    """CASE c WHEN key THEN value ... [ELSE rest] END from a value table."""
    whens = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in pairs)
    return f"CASE {c} {whens}{rest} END"


def _range_band(c: str, edges: list[tuple[tuple[int, int], str]], rest: str) -> str:
    whens = " ".join(f"WHEN d.{c} >= {lo} AND d.{c} <= {hi} THEN '{name}'" for (lo, hi), name in edges)
    return f"CASE WHEN d.{c} IS NULL THEN '{bands.MISSING}' {whens} ELSE '{rest}' END"


def _cut_band(c: str, cuts: list[str], before: str = "") -> str:
    low = [f"WHEN d.{c} <= (SELECT {k} FROM th) THEN '{name}'" for k, name in zip(cuts, bands.THRESHOLD_LABELS)]
    return f"CASE {before}WHEN d.{c} IS NULL THEN '{bands.MISSING}' {' '.join(low)} ELSE '{bands.THRESHOLD_LABELS[-1]}' END"


_GROUPS = {
    "tenure_group": _range_band("tenure", bands.TENURE_BANDS, bands.TENURE_REST),
    "satisfaction_group": _range_band("customer_satisfaction", bands.SATISFACTION_BANDS, bands.SATISFACTION_REST),
    "complaint_group": _range_band("num_complaints", bands.COMPLAINT_BANDS, bands.COMPLAINT_REST),
    "service_call_group": _range_band("num_service_calls", bands.CALL_BANDS, bands.CALL_REST),
    "late_payment_group": _range_band("late_payments", bands.CALL_BANDS, bands.CALL_REST),
    "interaction_recency_group": _range_band("days_since_last_interaction", bands.RECENCY_BANDS, bands.RECENCY_REST),
    "monthly_charge_band": _cut_band("monthlycharges", ["c1", "c2"]),
    "usage_band": _cut_band("avg_monthly_gb", ["u1", "u2"], f"WHEN d.has_internet_service = 0 THEN '{bands.NO_INTERNET}' "),
}


def _cleaned_select() -> str:
    out = []
    for c in COLUMNS:
        if c == "avg_monthly_gb":
            out.append(
                "CASE WHEN d.has_internet_service = 0 AND d.avg_monthly_gb IS NULL THEN CAST(0.0 AS DOUBLE) "
                "ELSE d.avg_monthly_gb END AS avg_monthly_gb"
            )
        else:
            out.append(f"d.{c}")
    out += [f"{_GROUPS[g]} AS {g}" for g in CLEANED_COLUMNS[len(COLUMNS):]]
    return ",\n  ".join(out)


RAW_CTE = "raw AS (SELECT " + ", ".join(f"{_RAW_EXPR[c]} AS {c}" for c in COLUMNS) + f", k AS row_id FROM ({_BASE}) b)"
TYPED_CTE = "typed AS (SELECT " + ", ".join(f"{_typed_expr(c)} AS {c}" for c in COLUMNS) + ", row_id FROM raw)"


def _dedup(tie: str) -> str:
    """The newest usable record per customer; equal dates go by ``tie``."""
    return (
        f"dedup AS (SELECT {', '.join(COLUMNS)} FROM typed WHERE customer_id IS NOT NULL AND churn IN (0, 1) "
        f"QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY signup_date DESC NULLS LAST, {tie}) = 1)"
    )


DEDUP_CTE = _dedup("row_id DESC")
# the catalog's tables have no row key: ties go by the columns in turn
KEYLESS_DEDUP_CTE = _dedup(", ".join(f"{c} DESC NULLS LAST" for c in COLUMNS if c not in ("customer_id", "signup_date")))
TH_CTE = (
    "th AS (SELECT quantile_disc(monthlycharges, 0.3333) AS c1, quantile_disc(monthlycharges, 0.6667) AS c2, "
    "quantile_disc(CASE WHEN has_internet_service = 1 THEN avg_monthly_gb END, 0.3333) AS u1, "
    "quantile_disc(CASE WHEN has_internet_service = 1 THEN avg_monthly_gb END, 0.6667) AS u2 FROM dedup)"
)
CLEANED_CTE = f"cleaned AS (SELECT {_cleaned_select()}\nFROM dedup d)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_R = _with(RAW_CTE)
_T = _with(RAW_CTE, TYPED_CTE)
_D = _with(RAW_CTE, TYPED_CTE, DEDUP_CTE)
_C = _with(RAW_CTE, TYPED_CTE, DEDUP_CTE, TH_CTE, CLEANED_CTE)


def _rate(dp: int) -> str:
    return f"CAST(ROUND(100.0 * CAST(SUM(churn) AS DOUBLE) / COUNT(*), {dp}) AS DOUBLE) AS churn_rate"


def _counts(table: str, conditions: dict[str, str], lead: str = "") -> str:
    """One row: for each name, how many rows meet its condition."""
    return f"SELECT {lead}" + ", ".join(f"count_if({cond}) AS {name}" for name, cond in conditions.items()) + f" FROM {table}"


def _nulls(table: str, columns: dict[str, str], lead: str = "") -> str:
    return _counts(table, {name: f"{c} IS NULL" for name, c in columns.items()}, lead)


def _grouped(source: str, keys: dict[str, str], values: str, where: str = "") -> str:
    """``values`` per key combination; keys as output name -> expression."""
    named = ", ".join(f"{e} AS {n}" for n, e in keys.items())
    return f"SELECT {named}, {values} FROM {source}{f' WHERE {where}' if where else ''} GROUP BY " + ", ".join(keys.values())


def _tally(source: str, name: str, expr: str, count: str) -> str:
    return _grouped(source, {name: expr}, f"COUNT(*) AS {count}")


def _uniqueness(source: str, key: str, names: tuple[str, str, str], more: str = "") -> str:
    total, ids, extra = names
    return (
        f"SELECT n AS {total}, ids AS {ids}, n - ids AS {extra}{more and ', ' + more} FROM "
        f"(SELECT COUNT(*) AS n, COUNT(DISTINCT {key}) AS ids, count_if(churn IS NULL) AS gone FROM {source}) u"
    )


def _statistics() -> str:
    make = {
        "mean": lambda c: f"ROUND(AVG({c}), 2)",
        "median": lambda c: f"CAST(quantile_disc(CAST({c} AS DOUBLE), 0.5) AS DOUBLE)",
        "min": lambda c: f"MIN({c})",
        "max": lambda c: f"MAX({c})",
        "stddev": lambda c: f"ROUND(stddev_pop({c}), 2)",
    }
    cols = [f"{make[s](c)} AS {STAT_NAMES[s]}_{label}" for c, label, stats in reports.STATS_SPEC for s in stats]
    return "SELECT COUNT(*) AS record_count, " + ", ".join(cols) + " FROM cleaned"


def _share(dp: int) -> str:
    status = _case("churn", [(1, labels.STATUS_CHURNED)], f" ELSE '{labels.STATUS_RETAINED}'")
    return (
        f"SELECT {status} AS customer_status, n AS customer_count, "
        f"CAST(ROUND(100.0 * CAST(n AS DOUBLE) / (SELECT COUNT(*) FROM cleaned), {dp}) AS DOUBLE) AS percentage "
        "FROM (SELECT churn, COUNT(*) AS n FROM cleaned GROUP BY churn) g"
    )


# fixed values: the fixture's quoted fields
_QUOTED = {"education": """'says "' || education || '", or so, ""'""", "gender": """'"' || COALESCE(gender, '') || '",'"""}

_TOTALS = "COUNT(*) AS total_customers, CAST(SUM(churn) AS BIGINT) AS {}, "
_REPORT = _TOTALS.format("churned_customers") + _rate(2)


def _wanted(*conditions: str) -> str:
    return " AND ".join(conditions)


def _known(c: str) -> str:
    return f"{c} <> '{bands.MISSING}'"


def _labelled(first: tuple[str, str, list], second: tuple[str, str, list], where: str) -> str:
    keys = {name: _case(c, table) if table else c for name, c, table in (first, second)}
    by = f"{first[1]}, {second[1]}"
    named = ", ".join(f"{e} AS {n}" for n, e in keys.items())
    return f"SELECT {named}, {_REPORT} FROM cleaned WHERE {where} GROUP BY {by}"


def _band_query(cols: list[str], group: str) -> str:
    return _C + f"SELECT customer_id, {', '.join(cols)}, {group} FROM cleaned"


def _place(sql: str, order: str) -> str:
    """The rows of a statement over the cleaned rows, each with its place in ``order``."""
    assert sql.startswith(_C)
    return _C + f"SELECT ROW_NUMBER() OVER (ORDER BY {order}) AS position, q.* FROM ({sql[len(_C):]}) q"


def _rank(c: str, table: list[tuple[object, str]]) -> str:
    """Place of a label in its value table."""
    return _case(c, [(label, i) for i, (_, label) in enumerate(table)], f" ELSE {len(table)}")


def _table_sql() -> dict[str, str]:
    trimmed = {c: f"LOWER(TRIM({c}))" for c in ("churn", "contract", "payment_method")}
    usable = "contract IS NOT NULL AND payment_method IS NOT NULL"
    mapped = _grouped(
        "{}",
        {"contract": "contract", "payment_method": "payment_method"},
        _TOTALS.format("total_churned") + "CAST(SUM(churn) AS DOUBLE) / COUNT(*) * 100 AS churn_rate",
        f"{usable} AND churn IN (0, 1)",
    )
    filled = "CASE WHEN has_internet_service = 0 AND avg_monthly_gb IS NULL THEN CAST(0.0 AS DOUBLE) ELSE avg_monthly_gb END"
    typed_columns = ", ".join(COLUMNS)
    sql = {
        "row_count": _R + "SELECT COUNT(*) AS raw_record_count FROM raw",
        "preview": _R + "FROM raw ORDER BY row_id LIMIT 10",
        "raw_csv_roundtrip": _R + "SELECT " + ", ".join(f"COALESCE({c}, '') AS {c}" for c in COLUMNS) + " FROM raw",
        "raw_csv_quoted": _R
        + "SELECT "
        + ", ".join(f"COALESCE({_QUOTED.get(c, c)}, '') AS {c}" for c in COLUMNS)
        + " FROM raw",
        "raw_csv_widths": _R + "SELECT COUNT(*) AS total_lines, count_if(row_id % 97 = 0 OR row_id % 89 = 0) AS wrong_width_lines FROM raw",
        "overwrite_survives_failure": _T + f"SELECT {typed_columns} FROM typed",
        "dropped_table_rows": _T + f"SELECT {typed_columns} FROM typed",
        "preview_contained": _R + "SELECT least(10, COUNT(*)) AS preview_rows, least(10, COUNT(*)) AS raw_rows FROM raw",
        "catalog_describe_extended": "SELECT described, property, value FROM (VALUES ('raw', 'csv'), ('typed', 'orc'), ('cleaned', 'orc')) t(described, source), "
        "LATERAL (VALUES ('database', 'churnlens_check_db'), ('table', 'customer_churn_' || described), ('type', 'external'), ('provider', source)) p(property, value)",
        "footer_ranges": _C
        + "SELECT COUNT(*) AS cleaned_rows, "
        + ", ".join(f"{f}({c}) AS {f}_{c}" for c in ("tenure", "monthlycharges", "totalcharges") for f in ("min", "max"))
        + " FROM cleaned",
        "running_rates": _C + mapped.format("cleaned"),
        "key_uniqueness": _R + _uniqueness("raw", "TRIM(customer_id)", ("total_rows", "distinct_customer_ids", "duplicate_customer_id_rows")),
        "duplicate_keys": _R
        + "SELECT * FROM (" + _tally("raw", "customer_id", "TRIM(customer_id)", "occurrence_count")
        + ") t WHERE occurrence_count > 1 AND customer_id <> '' ORDER BY occurrence_count DESC, customer_id LIMIT 100",
        "missing_report": _R
        + "SELECT field_name, missing_count FROM ("
        + _counts("raw", {f: f"COALESCE(TRIM({f}), '') = ''" for f in MISSING_FIELDS})
        + f") w UNPIVOT (missing_count FOR field_name IN ({', '.join(MISSING_FIELDS)}))",
        "freq_raw_churn": _R + _tally("raw", "raw_churn_value", trimmed["churn"], "record_count"),
        "freq_raw_contract": _R + _tally("raw", "contract", trimmed["contract"], "record_count"),
        "freq_raw_payment": _R + _tally("raw", "payment_method", trimmed["payment_method"], "record_count"),
        "typed_rows": _T + "FROM typed",
        "typed_nulls_required": _T + _nulls("typed", REQUIRED_NULLS, "COUNT(*) AS total_rows, "),
        "typed_nulls_analytic": _T + _nulls("typed", ANALYTIC_NULLS),
        "invalid_rows": _T + "FROM typed WHERE COALESCE(customer_id, '') = '' OR churn IS NULL ORDER BY row_id LIMIT 100",
        "latest_per_key": _D + "FROM dedup",
        "quantile_thresholds": _with(RAW_CTE, TYPED_CTE, DEDUP_CTE, TH_CTE)
        + "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {n}" for c, n in (("c1", "charge_p1"), ("c2", "charge_p2"), ("u1", "usage_p1"), ("u2", "usage_p2"))) + " FROM th",
        "filled_usage": _D + f"SELECT customer_id, has_internet_service, {filled} AS avg_monthly_gb FROM dedup",
        "tenure_group": _band_query(["tenure"], "tenure_group"),
        "satisfaction_group": _band_query(["customer_satisfaction"], "satisfaction_group"),
        "complaint_group": _band_query(["num_complaints"], "complaint_group"),
        "service_call_group": _band_query(["num_service_calls"], "service_call_group"),
        "late_payment_group": _band_query(["late_payments"], "late_payment_group"),
        "interaction_recency_group": _band_query(["days_since_last_interaction"], "interaction_recency_group"),
        "monthly_charge_band": _band_query(["monthlycharges"], "monthly_charge_band"),
        "usage_band": _band_query(["has_internet_service", "avg_monthly_gb"], "usage_band"),
        "threshold_bands_by_column": _band_query(["monthly_charge_band"], "usage_band"),
        "cleaned_rows": _C + "FROM cleaned",
        "cleaned_check": _C
        + _uniqueness("cleaned", "customer_id", ("cleaned_rows", "distinct_customer_ids", "remaining_duplicate_rows"), "gone AS missing_churn"),
        "share_of_total_4dp": _C + _share(4),
        "share_of_total_2dp": _C + _share(2),
        "describe_numeric": _C + _statistics(),
        "freq_contract": _C + _tally("cleaned", "contract", "contract", "customer_count"),
        "freq_payment": _C + _tally("cleaned", "payment_method", "payment_method", "customer_count"),
        "freq_tenure_group": _C + _tally("cleaned", "tenure_group", "tenure_group", "customer_count"),
        "cleaned_nulls": _C + _nulls("cleaned", reports.CLEANED_NULLS),
        "rate_contract_payment_4dp": _C
        + _grouped("cleaned", {"contract": "contract", "payment_method": "payment_method"}, _TOTALS.format("total_churned") + _rate(4)),
        "tsv_roundtrip": _C + "FROM cleaned",
        "rate_contract_payment_2dp": _C + _labelled(("contract_type", "contract", []), ("payment_method", "payment_method", []), usable),
        "rate_tenure_satisfaction": _C
        + _labelled(
            ("tenure", "tenure_group", labels.TENURE_LABELS),
            ("satisfaction", "satisfaction_group", labels.SATISFACTION_LABELS),
            _wanted(_known("tenure_group"), _known("satisfaction_group")),
        ),
        "rate_complaints_calls": _C
        + _labelled(
            ("complaints", "complaint_group", labels.COMPLAINT_LABELS),
            ("service_calls", "service_call_group", labels.SERVICE_CALL_LABELS),
            _wanted(_known("complaint_group"), _known("service_call_group")),
        ),
        "rate_usage_support": _C
        + _labelled(
            ("internet_usage", "usage_band", labels.USAGE_LABELS),
            ("tech_support", "has_tech_support", labels.TECH_SUPPORT_LABELS),
            _wanted(_known("usage_band"), "has_tech_support IN (0, 1)"),
        ),
        "rate_charge_contract": _C
        + _labelled(
            ("charge_band", "monthly_charge_band", labels.CHARGE_LABELS),
            ("contract_type", "contract", []),
            _wanted(_known("monthly_charge_band"), "contract IS NOT NULL"),
        ),
        "mapreduce_rate": _C + mapped.format("cleaned"),
        "catalog_typed_rows": _T + f"SELECT {typed_columns} FROM typed",
        "catalog_cleaned_rows": _with(RAW_CTE, TYPED_CTE, KEYLESS_DEDUP_CTE, TH_CTE, CLEANED_CTE) + "FROM cleaned",
        "catalog_describe": _C
        + "SELECT v.position, v.col_name, v.data_type, (SELECT COUNT(*) FROM cleaned) AS table_rows FROM (VALUES "
        + ", ".join(f"({i + 1}, '{f.name}', '{f.dataType.simpleString()}')" for i, f in enumerate(CLEANED_SCHEMA.fields))
        + ") v(position, col_name, data_type)",
        "stream_typed_rows": _T + f"SELECT {typed_columns} FROM typed",
        "stream_running_rates": _T + mapped.format("typed"),
    }
    again = {
        "duplicate_keys_filtered": "duplicate_keys",
        "footer_row_count": "row_count",
        "footer_cleaned_nulls": "cleaned_nulls",
        "clustered_latest_per_key": "latest_per_key",
        "clustered_cleaned_rows": "cleaned_rows",
        "clustered_cleaned_check": "cleaned_check",
    }
    sql.update({name: sql[twin] for name, twin in {**TWINS, **again}.items()})
    order = {
        "ordered_share_of_total": "customer_status DESC",
        "ordered_freq_contract": "customer_count DESC, contract NULLS FIRST",
        "ordered_freq_payment": "customer_count DESC, payment_method NULLS FIRST",
        "ordered_freq_tenure_group": "customer_count DESC, tenure_group",
        "ordered_rate_contract_payment": "churn_rate DESC, contract NULLS FIRST, payment_method NULLS FIRST",
        "ordered_contract_payment_report": "contract_type, churn_rate DESC, payment_method",
        "ordered_tenure_satisfaction": f"{_rank('tenure', labels.TENURE_LABELS)}, {_rank('satisfaction', labels.SATISFACTION_LABELS)}",
        "ordered_complaints_calls": f"{_rank('complaints', labels.COMPLAINT_LABELS)}, {_rank('service_calls', labels.SERVICE_CALL_LABELS)}",
        "ordered_usage_support": f"{_rank('internet_usage', labels.USAGE_LABELS)}, {_rank('tech_support', labels.TECH_SUPPORT_LABELS)}",
        "ordered_charge_contract": f"{_rank('charge_band', labels.CHARGE_LABELS)}, churn_rate DESC, contract_type",
    }
    sql.update({name: _place(sql[ORDERED[name][0]], by) for name, by in order.items()})
    return sql


def oracle_sql() -> dict[str, str]:
    return {**_table_sql(), **_CORPUS_SQL}
