"""Grouped totals that follow arriving batches, with retraction.

Each batch leaves two small things: its *winners* (the records that are now the
latest of their key) and its *cells* (per group: rows and targets gained, minus
those of the records that the winners replace).  Cells add up, so the totals
over all batches are one aggregate over a table of cells, and no earlier input
is read again.  A batch reads, of the winners before it, those of its own keys.

Batches are appended under their number; one that is run again (after a lost
driver, say) replaces what it had left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators.dedupe import latest_per_key, valid_target_rows


class RunningCells:
    """Totals per ``keys`` of the latest record per ``key``, kept below ``path``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        key: str,
        target: str,
        order: Mapping[str, Column],
        tiebreak: Sequence[str],
    ) -> None:
        self.spark, self.path = spark, path
        self.keys, self.key, self.target, self.order, self.tiebreak = list(keys), key, target, order, list(tiebreak)
        self._columns = list(dict.fromkeys([key, *order, *tiebreak, *keys, target]))

    def _batches(self, part: str, first: int, last: int) -> list[str]:
        return [f"{self.path}/{part}/batch={n}" for n in range(first, last)]

    def add(self, batch: DataFrame, number: int) -> None:
        """Take batch ``number`` (0, 1, ...; all before it have been taken)."""
        new = latest_per_key(valid_target_rows(batch.select(*self._columns), self.key, self.target), self.key, self.order, self.tiebreak)
        old = self.spark.read.parquet(*self._batches("winners", 0, number)) if number else new.limit(0)
        # of a key's earlier winners only the last stands; keys that the batch doesn't have are left out
        old = latest_per_key(old.join(new.select(self.key), self.key, "left_semi").select(*self._columns), self.key, self.order, self.tiebreak)
        both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
        # a record that ties with the one before it changes nothing
        best = latest_per_key(both, self.key, self.order, [*self.tiebreak, "__new"])
        changed = best.where("__new = 1").drop("__new")
        changed.write.mode("overwrite").parquet(self._batches("winners", number, number + 1)[0])
        changed = self.spark.read.schema(changed.schema).parquet(self._batches("winners", number, number + 1)[0])
        gone = old.join(changed.select(self.key), self.key, "left_semi").withColumn("__sign", F.lit(-1))
        delta = changed.withColumn("__sign", F.lit(1)).unionByName(gone)
        cells = delta.groupBy(*self.keys).agg(F.sum("__sign").alias("n"), F.sum(F.col("__sign") * F.col(self.target)).cast("bigint").alias("s"))
        cells.write.mode("overwrite").parquet(self._batches("cells", number, number + 1)[0])

    def totals(self, batches: int, count_name: str = "total_customers", sum_name: str = "churned_customers") -> DataFrame:
        """Rows and target sum per group after that many batches (empty groups left out)."""
        cells = self.spark.read.parquet(*self._batches("cells", 0, batches))
        out = cells.groupBy(*self.keys).agg(F.sum("n").alias(count_name), F.sum("s").alias(sum_name))
        return out.where(F.col(count_name) > 0)
