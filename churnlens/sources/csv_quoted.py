"""Raw CSV whose quoted fields hold quotes both ways: ``\\"`` and ``""``.

A text serde takes a quote inside a quoted field as ``\\"`` or as ``""``; one
scan of Spark's takes only one of the two, and cuts the other at the next
comma.  Here the scan yields whole lines (with the first line of each file left
out, by the same reader that a split scan uses, so files stay splittable), one
expression turns the escapes inside quoted fields into doubled quotes, and
``from_csv`` parses the lines with doubled quotes.  Lines without a backslash
are not touched.

In a quoted field a backslash makes the next character plain, so ``\\\\`` is one
backslash; in an unquoted field it is text.  A record is one line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.schema import RAW_SCHEMA, ddl

#: Whole lines: a separator that no text holds (a noncharacter), and no quotes.
LINE_OPTIONS = {"sep": "￿", "quote": "", "escape": "", "mode": "PERMISSIVE", "multiLine": "false", "maxCharsPerColumn": "-1"}
FIELD_OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
BAD = "_bad_line"

# A quoted field from its opening quote, or on from the last match inside it;
# runs are possessive, so a line takes one pass.
_INSIDE = r'(\G(?!^)|(?:^|,)")'
_ESCAPED_QUOTE = _INSIDE + r'((?:[^"\\]++|""|\\[^"])*+)\\"'
_ESCAPED_OTHER = _INSIDE + r'((?:[^"\\]++|"")*+)\\([^"])'


def doubled_quotes(line: Column) -> Column:
    """The line with ``\\"`` in quoted fields as ``""`` and any other escaped character bare."""
    quotes = F.regexp_replace(line, _ESCAPED_QUOTE, r'$1$2""')
    return F.when(line.contains("\\"), F.regexp_replace(quotes, _ESCAPED_OTHER, "$1$2$3")).otherwise(line)


def read_lines(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """The lines (column ``line``) of text files, blank ones left out; with ``header`` without each file's first."""
    return spark.read.schema("line string").options(header=str(header).lower(), **LINE_OPTIONS).csv(path)


def parse_lines(lines: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """All-text columns of quoted lines, and ``_bad_line``: the line where its number of fields isn't the schema's.

    A short line's missing fields are NULL, a long line's further fields are left out.
    """
    wide = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    options = {**FIELD_OPTIONS, "columnNameOfCorruptRecord": BAD}
    return lines.select(F.from_csv(doubled_quotes(F.col("line")), ddl(wide), options).alias("r")).select("r.*")


def read_quoted_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_SCHEMA, empty_as_text: bool = True, header: bool = True
) -> DataFrame:
    """Scan raw CSV as all-text columns, quotes inside quoted fields written either way; an empty field reads as ``''``."""
    rows = parse_lines(read_lines(spark, path, header), schema).drop(BAD)
    return rows.na.fill("") if empty_as_text else rows


def line_width_report(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_SCHEMA, header: bool = True) -> DataFrame:
    """One row: lines, and those with too few or too many fields for the schema."""
    rows = parse_lines(read_lines(spark, path, header), schema)
    return rows.agg(F.count(F.lit(1)).alias("total_lines"), F.count(BAD).alias("wrong_width_lines"))


def write_quoted_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write all-text rows with quotes inside fields doubled, padded values kept."""
    options = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode(mode).options(**options).csv(path)
