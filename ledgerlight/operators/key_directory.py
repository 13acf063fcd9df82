"""Where the rows of a stored mart lie: the months of each key, in a table bucketed by key.

An upsert has to find older copies of its keys, which may lie in other months. Without help it scans and shuffles
the keys of all stored rows. The directory holds each key with its months and nothing else, written in Spark's
own buckets: a join with a batch needs no exchange of the directory, only the batch's keys travel.

Entries are added before the rows they speak of are published and never taken back, so the months of a key are a superset
of those that hold it: after a run that failed, or a row that moved on, a month too many is looked through and nothing
is missed. A full load begins a new directory.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlight.session import path_exists


class KeyDirectory:
    """The directory of one history (the number of a full load) of the table below ``root``.

    ``buckets`` should not be below the session's shuffle partitions, or Spark exchanges both sides for more parallelism.
    They are fixed when the directory is begun.
    """

    def __init__(self, spark: SparkSession, root: str, history: int, buckets: int) -> None:
        self.spark = spark
        self.path = f"{root.rstrip('/')}/keys/history={history}-buckets={buckets}"
        self.name = f"keys_{hashlib.md5(self.path.encode()).hexdigest()}"
        self.buckets = buckets

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/_SUCCESS")

    def _table(self) -> str:
        """The folder as a table of the session's catalog, which knows its buckets."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (row_key STRING, month STRING) USING parquet "
            f"CLUSTERED BY (row_key) SORTED BY (row_key) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        return self.name

    def read(self) -> DataFrame:
        return self.spark.table(self._table())

    def add(self, entries: DataFrame) -> None:
        """Rows of (``row_key``, ``month``)."""
        entries.select("row_key", "month").write.insertInto(self._table())
        self.spark.catalog.refreshTable(self.name)

    def of(self, keys: DataFrame) -> DataFrame:
        """All entries of ``keys(row_key)``, distinct: ``row_key``, ``month``."""
        return self.read().join(keys, "row_key", "left_semi").distinct()

    def take(self, batch: DataFrame, key: str, month: Column) -> set[str]:
        """Adds a batch's keys where they are new, and gives the months in which copies of them may lie."""
        own = batch.select(F.col(key).cast("string").alias("row_key"), month.alias("month"))
        known = self.of(own.select("row_key"))
        months = {r[0] for r in known.select("month").distinct().collect()}
        self.add(own.join(known, ["row_key", "month"], "left_anti"))
        return months
