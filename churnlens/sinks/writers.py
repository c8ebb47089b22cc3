"""TSV writer and reader.

The export is a distributed ``DataFrame.write``: each task writes its own
part file, nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.schema import CLEANED_COLUMNS

TSV_NULL = "\\N"


def export_tsv(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = CLEANED_COLUMNS,
    compression: str | None = "gzip",
    mode: str = "overwrite",
) -> None:
    """Tab-separated, no header, ``\\N`` for NULL, dates as ``yyyy-MM-dd`` text.

    A field that contains a tab or a quote is quoted, so no row can spill
    into extra columns.
    """
    cols = [F.col(c).cast("string").alias(c) if isinstance(df.schema[c].dataType, T.DateType) else F.col(c) for c in columns]
    w = (
        df.select(*cols)
        .write.mode(mode)
        .option("sep", "\t")
        .option("header", "false")
        .option("nullValue", TSV_NULL)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
    )
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", "false")
        .option("nullValue", TSV_NULL)
        .option("mode", "FAILFAST")
        .csv(path)
    )
