"""Tables between the steps of a job, kept in the folder the whole cluster shares."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import ledgerlight

from ledgerlight.session import scratch_folder, shuffle_files_dropped

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers of the session, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.abspath(ledgerlight.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerlight-code-"), "ledgerlight.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


def map_batches(table: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the workers, which give Arrow's free memory back after each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    ship_package(table.sparkSession)
    return table.mapInArrow(run, schema)


class Workspace:
    """A fresh folder for the tables of one run; a written table cuts the lineage."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = scratch_folder(spark, name)
        self.held: list[str] = []

    def write(self, table: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        with shuffle_files_dropped(self.spark):
            table.write.option("compression", "zstd").parquet(path)
        self.held.append(name)
        return self.spark.read.schema(table.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes tables that no later step reads."""
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
            self.held.remove(name)

    def keep(self, *names: str) -> None:
        """Deletes all tables but these."""
        self.drop(*[name for name in self.held if name not in names])
