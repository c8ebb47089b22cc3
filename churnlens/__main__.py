"""Run the whole attrition script against a raw CSV prefix.

    python -m churnlens --raw s3://bucket/raw/ --base s3://bucket/churn \
        [--database customer_churn_db] [--input-bytes N --cores C]
    (or spark-submit churnlens/__main__.py with the same arguments)

Declares the database and external tables, writes typed and cleaned ORC and
the TSV export under ``--base``, writes every check and report whole as a
Parquet table below ``--base``/reports and prints where it is.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from churnlens.plans.pipeline import DATABASE, run_script
from churnlens.session import build_session, cluster_conf


def write_reports(out: dict[str, DataFrame | str], base: str) -> None:
    """Every frame whole below ``base``/reports; prints each name with its place."""
    for name, df in out.items():
        if isinstance(df, str):
            print(f"{name}: {df}")
        else:
            path = f"{base}/reports/{name}"
            df.write.mode("overwrite").parquet(path)
            print(f"{name}: {path}")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="churnlens")
    ap.add_argument("--raw", required=True, help="raw CSV file or prefix")
    ap.add_argument("--base", required=True, help="prefix for typed/cleaned ORC and the TSV export")
    ap.add_argument("--database", default=DATABASE)
    ap.add_argument("--input-bytes", type=int, default=0, help="raw size, to size partitions")
    ap.add_argument("--cores", type=int, default=0, help="total executor cores, to size partitions")
    args = ap.parse_args(argv)

    extra = cluster_conf(args.input_bytes, args.cores) if args.input_bytes and args.cores else None
    spark = build_session(app_name="churnlens", extra=extra)
    write_reports(run_script(spark, args.raw, args.base, args.database), args.base)
    spark.stop()


if __name__ == "__main__":
    main()
