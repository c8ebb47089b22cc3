"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from churnlens.session import scratch_dir

#: ASCII white space that separates words: space and 0x09-0x0D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor rereads files, it doesn't replay
    the shuffles before them, and row ids given before the write stay fixed.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; an empty array for null or blank text."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(trimmed, F.lit("")) == "", none).otherwise(F.split(trimmed, BLANK_RUN))


def bounded_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """At most ``n`` rows: those with the smallest hashes of ``key`` (ties by key).

    Rows whose hash is beyond the share of 4 n in all rows are left out where
    they are read, so what the tasks send for the final choice is about 4 n
    rows altogether and doesn't grow with their number.
    """
    h = F.xxhash64(key, F.lit(seed))
    least, span = -(1 << 63), (1 << 64) - 1
    top = least + min(span, span * 4 * n // max(1, df.count()))
    return df.where(h <= F.lit(top)).orderBy(h, key).limit(n)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` rows for this session, so that batches of long texts fit a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what is run inside; the setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
