"""Catalog objects: database, external CSV / ORC tables, scans and metadata.

Tables are external: dropping one leaves its files, exactly as with separate
raw / typed / cleaned / export prefixes.  Spark's built-in ``USING csv`` and
``USING orc`` sources stand in for a text serde and the ORC storage handler.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from churnlens.schema import ddl
from churnlens.sources.csv_raw import CSV_OPTIONS


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(name)}")


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"USE {_q(name)}")


def drop_table(spark: SparkSession, name: str) -> None:
    """DROP TABLE IF EXISTS; files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_q(name)}")


def declare_csv_table(spark: SparkSession, name: str, schema: T.StructType, location: str) -> None:
    opts = ", ".join(f"{_text(k)} {_text(v)}" for k, v in CSV_OPTIONS.items())
    spark.sql(f"CREATE TABLE {_q(name)} ({ddl(schema)}) USING csv OPTIONS ({opts}) LOCATION {_text(location)}")


def declare_orc_table(spark: SparkSession, name: str, schema: T.StructType, location: str) -> None:
    spark.sql(f"CREATE TABLE {_q(name)} ({ddl(schema)}) USING orc LOCATION {_text(location)}")


def scan_footers(spark: SparkSession, path: str) -> DataFrame:
    """A scan of ORC files by the V2 source, which answers COUNT, MIN and MAX
    without grouping or filter from the files' footers.

    The V2 source is chosen for this frame only.  The push-down setting is read
    when a query runs, so it stays on; it changes where such a result is read
    from and nothing else.
    """
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    spark.conf.set(key, ",".join(x for x in before.split(",") if x.strip() != "orc"))
    spark.conf.set("spark.sql.orc.aggregatePushdown", "true")
    try:
        return spark.read.orc(path)
    finally:
        spark.conf.set(key, before)


def store_clustered(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as an external ORC table clustered by the hash of ``key`` and return its scan.

    Aggregates, windows and joins on the key then run without an exchange.
    Rows that already lie by that hash (a window over the key) are written
    from where they are.
    """
    df.write.format("orc").option("path", path).bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def table_location(spark: SparkSession, name: str) -> str:
    """Where the files of a table are."""
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)}").collect():  # a row per column or property
        if r["col_name"] == "Location":
            return r["data_type"]
    raise ValueError(f"{name} has no location")


def set_location(spark: SparkSession, name: str, location: str) -> None:
    """Point an external table to other files."""
    spark.sql(f"ALTER TABLE {_q(name)} SET LOCATION {_text(location)}")
    spark.catalog.refreshTable(_q(name))


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Column and storage metadata rows (col_name, data_type, comment)."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)}")


def describe_columns(spark: SparkSession, name: str) -> DataFrame:
    """The columns of a table as DESCRIBE lists them: position, col_name, data_type."""
    rows = spark.sql(f"DESCRIBE TABLE {_q(name)}").collect()  # a row per column
    listed = [(i + 1, r["col_name"], r["data_type"]) for i, r in enumerate(rows)]
    return spark.createDataFrame(listed, "position int, col_name string, data_type string")
