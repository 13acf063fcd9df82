"""Session settings the jobs are tuned for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A one-machine session for tests and timing."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("ledgerlight")
    options = {**SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **settings}
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder of the cluster.

    Only a local session without that setting gets a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerlight-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, each finished SQL execution drops its shuffle files at once.

    A step ends in a written table, so nothing reads them again; a lost file
    before that end is made anew from the step's inputs.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def write_files(rows: DataFrame, path: str, *partitions: str, mode: str = "errorifexists") -> None:
    """Write rows in small files, at zstd's fastest level, and drop the shuffle files of the write with its end."""
    writer = rows.write.mode(mode).options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": "1"})
    with shuffle_files_dropped(rows.sparkSession):
        (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any store that Spark reaches."""
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()).exists(hadoop_path)
