"""Overwrite of an external table that a failed job can't empty.

``INSERT OVERWRITE`` removes the old files before it writes the new ones, so a
job that dies in between leaves no table.  Here the rows are written to a fresh
location beside the table's and the table is then pointed there, which is one
change of the catalog: readers see all old rows or all new ones, and the old
files stay until ``remove_old_versions``.  Only a declared location without
files is written in place: there is nothing to lose.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.sources.tables import set_location, table_location

#: Versions of the table at ``<location>`` are folders of ``<location>.v``.
VERSIONS = ".v"


def first_location(location: str) -> str:
    """The location that a table was declared with, from that of one of its versions."""
    return location.split(f"{VERSIONS}/")[0]


def _files(spark: SparkSession, location: str) -> list:
    """Hadoop paths of the visible files and folders of a location."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = [s.getPath() for s in files.listStatus(path)] if files.exists(path) else []
    return [p for p in listed if p.getName()[0] not in "._"]


def swap_overwrite(df: DataFrame, table: str, source: str = "orc") -> str:
    """Replace the rows of ``table`` (columns by name, cast to its types); returns the new location."""
    spark = df.sparkSession
    schema = spark.table(table).schema
    now = table_location(spark, table)
    new = f"{first_location(now)}{VERSIONS}/{uuid.uuid4().hex[:12]}" if _files(spark, now) else now
    rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    rows.write.format(source).mode("append").save(new)
    set_location(spark, table, new)
    return new


def remove_old_versions(spark: SparkSession, table: str) -> int:
    """Delete the files that ``table`` doesn't point to any more; returns how many versions there were."""
    now = table_location(spark, table)
    first = first_location(now)
    versions = [p for p in _files(spark, first + VERSIONS) if p.getName() != now.rsplit("/", 1)[-1]]
    stale = _files(spark, first) if now != first else []
    for p in versions + stale:
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(versions) + bool(stale)
