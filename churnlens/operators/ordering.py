"""Positions in a total order, without one task that sorts everything.

Rows are dealt by ranges of the order, so the rows of a task are a stretch of
it.  A row's position is its number within the stretch plus the rows of the
stretches before, and those prefix counts are one number a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.quantiles import attach_scalars
from churnlens.session import scratch_dir

_PART, _STARTS = "__stretch", "__starts"


def numbered(rows: DataFrame, order: Sequence[Column], position: str = "position") -> DataFrame:
    """``rows`` and each one's place, from 1, in ``order`` (equal rows in any order).

    The dealt rows are written once: the ranges are drawn from a sample, so a
    repeated task must not draw them again between counting and numbering.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, "numbered")
    dealt = rows.repartitionByRange(*order).withColumn(_PART, F.spark_partition_id())
    dealt.write.parquet(path)
    kept = spark.read.schema(dealt.schema).parquet(path)
    # one row a stretch: as many as shuffle partitions
    counts = kept.groupBy(_PART).agg(F.count(F.lit(1)).alias("n")).agg(F.sort_array(F.collect_list(F.struct(_PART, "n"))).alias("c"))
    starts = counts.select(
        F.map_from_entries(
            F.transform(
                "c",
                lambda x, i: F.struct(
                    x[_PART].alias("key"), F.aggregate(F.slice(F.col("c"), 1, i), F.lit(0).cast("long"), lambda s, y: s + y["n"]).alias("value")
                ),
            )
        ).alias(_STARTS)
    )
    place = F.row_number().over(Window.partitionBy(_PART).orderBy(*order))
    out = attach_scalars(kept.withColumn(position, place), starts)
    return out.withColumn(position, F.col(position) + F.element_at(_STARTS, F.col(_PART))).select(position, *rows.columns)
