"""The keys a growing table already has, kept so that asking for them moves no key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .writers import scratch_path


class KeyStore:
    """Distinct keys of a target as a catalog table bucketed by the key.

    A load asks which of its rows are new: only the load is shuffled, into the store's buckets; the keys
    are read where they lie. New keys are appended, one file per bucket. Choose at least as many
    buckets as a shuffle has partitions, or Spark shuffles both sides to get more. NULL keys are not kept, and
    a row with a NULL key is never new.
    """

    def __init__(self, spark: SparkSession, table: str, key: str, buckets: int, path: str | None = None) -> None:
        self.spark, self.table, self.key, self.buckets, self.path = spark, table, key, buckets, path

    def _exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def add(self, keys: DataFrame) -> None:
        """Append the keys (one column) the store lacks."""
        fresh = self.unseen(keys.toDF(self.key).distinct(), self.key)
        # rows are dealt by bucket first, or every task would write a file into every bucket
        writer = fresh.repartition(self.buckets, self.key).write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
        if self._exists():
            writer.mode("append").saveAsTable(self.table)
        else:
            writer.option("path", self.path or scratch_path(self.spark, self.table)).saveAsTable(self.table)

    def unseen(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows whose key the store does not have."""
        rows = rows.where(F.col(key).isNotNull())
        if not self._exists():
            return rows
        known = self.spark.table(self.table).select(F.col(self.key).alias("_known"))
        return rows.join(known.hint("merge"), F.col(key) == F.col("_known"), "left_anti")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
