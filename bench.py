"""Benchmark: the attrition job's stages on the order-derived fixture.

Environment:
    BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    timed runs after one warm-up (default 3); the median is reported

Prints one JSON line: {"metric", "value", "unit", "queries", "tenfold", "sf", ...}.
Each timed stage ends in an action (a write or a collect), so the number is
end-to-end work, not plan construction.  ``value`` is the sum of the stages;
``query_*`` are registered queries over the stored stages; ``tenfold`` is one
run of the stages over ten copies of the fixture with ids of their own, and
``tenfold_growth`` its time as a multiple of the plain run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, functions as F  # noqa: E402

from churnlens.plans.pipeline import AttritionPipeline  # noqa: E402
from churnlens.plans.queries import QUERIES  # noqa: E402
from churnlens.session import build_session, scratch_dir  # noqa: E402
from churnlens.sinks.writers import export_tsv  # noqa: E402
from churnlens.sources.fixture import raw_records  # noqa: E402


#: Registered queries that take their rows from what the stages have stored.
NAMED = [
    "row_count", "preview", "key_uniqueness", "duplicate_keys", "missing_report", "freq_raw_churn", "typed_nulls_required",
    "invalid_rows", "quantile_thresholds", "usage_band", "cleaned_check", "share_of_total_4dp", "describe_numeric", "freq_contract",
    "cleaned_nulls", "rate_contract_payment_4dp", "rate_tenure_satisfaction", "rate_usage_support", "rate_charge_contract", "mapreduce_rate",
]


def _collect_all(frames) -> int:
    return sum(len(f.collect()) for f in frames)


def tenfold(raw: DataFrame) -> DataFrame:
    """Ten copies of the fixture with ids and row keys of their own."""
    n = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("copy")
    rows = raw.select("*", n)
    key = F.when(F.trim("customer_id") != "", F.concat("customer_id", F.lit("-"), F.col("copy").cast("string"))).otherwise(F.col("customer_id"))
    return rows.withColumn("customer_id", key).withColumn("row_id", F.col("row_id") * 10 + F.col("copy")).drop("copy")


def run_once(spark, raw: DataFrame) -> dict[str, float]:
    t: dict[str, float] = {}
    p = AttritionPipeline(spark, raw)

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        t[name] = time.perf_counter() - t0

    timed("stage_raw_orc", lambda: p.raw_stored)
    timed("profile_raw", lambda: _collect_all(list(p.profile.values())))
    timed("typed_orc", lambda: p.typed)
    timed("validate_typed", lambda: _collect_all(list(p.validation.values())))
    timed("dedupe", lambda: p.deduplicated)
    timed("clean_orc", lambda: p.cleaned)
    timed("report_cells", lambda: p.report_cells)
    timed("checks", lambda: _collect_all(list(p.checks.values())))
    timed("reports", lambda: _collect_all([v for k, v in p.report_tables.items() if k != "mapreduce_rate"]))
    timed("mapreduce_rate", lambda: p.report_tables["mapreduce_rate"].collect())
    timed("export_tsv", lambda: export_tsv(p.cleaned, scratch_dir(spark, "bench_export")))
    return t


def named_once(spark, sf_dir: str) -> dict[str, float]:
    t = {}
    for name in NAMED:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).collect()
        t[f"query_{name}"] = time.perf_counter() - t0
    return t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", app_name="churnlens-bench", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    raw = raw_records(spark, sf_dir, partitions=cpus)
    run_once(spark, raw)  # warm-up: JIT, class loading, file listing caches
    samples = [run_once(spark, raw) for _ in range(runs)]
    stages = {k: round(statistics.median(s[k] for s in samples), 3) for k in samples[0]}
    named_once(spark, sf_dir)
    singles = [named_once(spark, sf_dir) for _ in range(runs)]
    queries = stages | {k: round(statistics.median(s[k] for s in singles), 3) for k in singles[0]}
    ten = {k: round(v, 3) for k, v in run_once(spark, tenfold(raw)).items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "attrition_pipeline_total",
        "value": round(sum(stages.values()), 3),
        "unit": "sec",
        "queries": queries,
        "tenfold": ten,
        "tenfold_growth": {k: round(ten[k] / stages[k], 2) for k in stages if stages[k]},
        "sf": float(m.group(1)) if m else sf_dir,
        "raw_rows": raw.count(),
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
