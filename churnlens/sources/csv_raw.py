"""Raw CSV scan: comma separated, ``"`` quoted, ``\\`` escaped, one header line.

All 32 columns are read as text with a fixed schema (no inference pass over
the data).  ``multiLine`` stays off so every file remains splittable and a
100 TB input spreads over all executors by byte range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from churnlens.schema import RAW_SCHEMA

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": "\\",
    "multiLine": "false",
    "mode": "PERMISSIVE",
}


def read_raw_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW_SCHEMA,
    empty_as_text: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Scan raw CSV as all-text columns.

    With ``empty_as_text`` an empty field reads as ``''`` (a text-serde
    reader never produces NULL for a present field); Spark's own default is
    NULL.  Either way the typing rules treat both as missing.
    ``partitions`` deals the rows round-robin over so many partitions before
    the per-row work: for a few files that can't be split, gzip say.
    """
    df = spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
    if partitions:
        df = df.repartition(partitions)
    if empty_as_text:
        df = df.na.fill("")
    return df


def write_raw_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write all-text rows in the same dialect (used to stage raw inputs).

    Spark's CSV writer trims surrounding spaces by default; padded raw values
    are data here, so trimming is switched off.
    """
    (
        df.write.mode(mode)
        .option("header", "true")
        .option("quote", '"')
        .option("escape", "\\")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
