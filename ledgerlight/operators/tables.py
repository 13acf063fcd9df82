"""Stored marts: full replace and keyed upsert over Parquet partitioned by month or by day.

A table is a folder of immutable partitions, ``<root>/version=N/<column>=...``,
and one small list per publish that names the version each month (or day) is
read from. A run writes only the partitions it touches and then publishes
a new list; readers keep the list they opened, a failed run leaves nothing
visible, and a partition nobody touched is never copied. Files leave out the md5 keys
that a row's columns give again, and ``read`` makes them when they are asked for. A feed that delivers a few days again
should be stored by day: an upsert then rewrites those days and not their months.

Where the catalog supports row-level merge (``merge_into``), use that instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerlight.context import RunContext
from ledgerlight.functions.keys import LEFT_OUT, as_stored, from_stored
from ledgerlight.operators.key_directory import KeyDirectory
from ledgerlight.session import path_exists, write_files

MONTH_LISTS = "month_lists"
MONTH_LIST_SCHEMA = "publish int, month string, version int"
INCOMING = "incoming"
# The folder name Spark gives to a NULL partition value.
DAY_COLUMN = "partition_day"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class Watcher(Protocol):
    """An audit that also rides on the write of the rows it looks at."""

    def watched(self, rows: DataFrame) -> DataFrame: ...

    def check(self, written: DataFrame, unique: str | None = None) -> None: ...


# Looks at written rows before they are published; raises to stop the publish.
Audit = Callable[[DataFrame], None] | Watcher


def _watched(rows: DataFrame, audit: Audit | None) -> DataFrame:
    return audit.watched(rows) if hasattr(audit, "watched") else rows


def _run_audit(audit: Audit | None, written: DataFrame, unique: str | None = None) -> None:
    if hasattr(audit, "check"):
        audit.check(written, unique)
    elif audit is not None:
        audit(written)


def any_rows(rows: DataFrame) -> bool:
    return not rows.isEmpty()


def merge_rows(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``batch``: same key replaced, new key added, nothing deleted.

    Columns only the batch has are appended, NULL in older rows.
    """
    kept = target.join(batch.select(key), key, "left_anti")
    return batch.unionByName(kept, allowMissingColumns=True)


def duplicate_keys(batch: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; a batch with any cannot be merged."""
    return batch.groupBy(key).count().where("count > 1")


class MonthTable:
    """One stored mart, partitioned by a ``yyyyMM`` column, or by the days of a date column (``day``).

    ``month_in_key=True`` says that the key already contains the month, so a row
    cannot move to another one and an upsert need not look for old copies. With ``key_buckets`` the months of
    each key are kept in a ``KeyDirectory`` of so many buckets, and an upsert finds old copies there instead of
    scanning the keys of all stored rows.
    """

    def __init__(
        self, spark: SparkSession, root: str, key: str, month: str, *, month_in_key: bool = False, day: str | None = None,
        key_buckets: int | None = None, month_comment: str | None = None,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.key = key
        self.day = day
        # The partition column; that of a table by day is no column of the mart.
        self.month = DAY_COLUMN if day else month
        self.month_in_key = month_in_key
        self.key_buckets = None if month_in_key else key_buckets
        # Files hold the other columns' comments; a partition column is in no file.
        self.month_notes = {"comment": month_comment} if month_comment and not day else None

    def _cut(self, rows: DataFrame) -> DataFrame:
        """Rows with the partition column."""
        return rows.withColumn(DAY_COLUMN, F.date_format(self.day, "yyyyMMdd")) if self.day else rows

    def _uncut(self, rows: DataFrame) -> DataFrame:
        return rows.drop(DAY_COLUMN) if self.day else rows

    def _published(self) -> tuple[int, dict[str, int]]:
        """The newest publish and its months; one row per calendar month."""
        if not path_exists(self.spark, f"{self.root}/{MONTH_LISTS}"):
            return 0, {}
        lists = self.spark.read.schema(MONTH_LIST_SCHEMA).json(f"{self.root}/{MONTH_LISTS}")
        newest = lists.agg(F.max("publish")).scalar()
        rows = lists.where(F.col("publish") == newest).collect()
        return rows[0].publish, {r.month: r.version for r in rows if r.month is not None}

    def months(self) -> dict[str, int]:
        """Month -> version its rows are read from; empty before the first load."""
        return self._published()[1]

    def exists(self) -> bool:
        return bool(self.months())

    def _folder(self, month: str, version: int) -> str:
        return f"{self.root}/version={version}/{self.month}={month or NULL_FOLDER}"

    def _label(self) -> Column:
        return F.coalesce(F.col(self.month), F.lit(""))

    def _read(self, listed: dict[str, int]) -> DataFrame:
        # The newest folder decides the columns; older files lack appended ones and give NULL.
        newest = self.spark.read.parquet(f"{self.root}/version={max(listed.values())}").schema
        schema = StructType([f for f in newest.fields if f.name not in (self.month, LEFT_OUT)])
        folders = [self._folder(month, version) for month, version in sorted(listed.items())]
        return from_stored(
            self.spark.read.schema(schema.add(LEFT_OUT, "string").add(self.month, "string").add("version", "integer"))
            .option("basePath", self.root)
            .parquet(*folders)
            .drop("version")
            .withColumn(self.month, F.col(self.month).alias(self.month, metadata=self.month_notes or {}))
        )

    def read(self) -> DataFrame:
        """The published rows. Months are partitions: a filter on the month prunes files."""
        listed = self.months()
        if not listed:
            raise ValueError(f"nothing published in {self.root}")
        return self._uncut(self._read(listed))

    def read_like(self, rows: DataFrame) -> DataFrame | None:
        """The published rows of the months (or days) that ``rows`` belong to; None if there are none. Other partitions are not read."""
        listed = self.months()
        wanted = {r[0] for r in self._cut(rows).select(self._label()).distinct().collect()}
        shared = {month: version for month, version in listed.items() if month in wanted}
        if not shared:
            return None
        return self._uncut(self._read(shared))

    def newest_day(self, day: str) -> date | None:
        """The latest value of a date column that the month is derived from; reads the last month only."""
        listed = {month: version for month, version in self.months().items() if month}
        if not listed:
            return None
        last = max(listed)
        return self._read({last: listed[last]}).agg(F.max(day)).first()[0]

    def _publish(
        self, rows: DataFrame, publish: int, keep: dict[str, int], audit: Audit | None = None, cut_by: str | None = None, parts: int = 1
    ) -> None:
        target = f"{self.root}/version={publish}"
        # An empty month comes back from its folder as NULL, and so it counts in a key.
        named = rows.withColumn(self.month, F.nullif(F.col(self.month), F.lit(""))) if dict(rows.dtypes)[self.month] == "string" else rows
        for part in range(parts):
            own = named.where(F.pmod(F.xxhash64(cut_by), F.lit(parts)) == part) if parts > 1 else named
            # Rebalance joins small pieces of a month and splits a month that is too large for one file.
            moved = as_stored(_watched(own, audit)).hint("rebalance", self.month)
            write_files(moved, target, self.month, mode="append" if part else "overwrite")
        schema = StructType([*rows.schema.fields]).add(LEFT_OUT, "string")
        written = from_stored(self.spark.read.schema(schema).parquet(target))
        _run_audit(audit, self._uncut(written))
        listed = dict(keep)
        if any_rows(written):
            listed |= {r[0]: publish for r in written.select(self._label()).distinct().collect()}
        entries = [(publish, month, version) for month, version in sorted(listed.items())]
        # One small file, visible at once when the write commits.
        self.spark.createDataFrame(entries or [(publish, None, None)], MONTH_LIST_SCHEMA).coalesce(1).write.mode(
            "append"
        ).json(f"{self.root}/{MONTH_LISTS}")

    def _directory(self, listed: dict[str, int], stored: DataFrame) -> KeyDirectory:
        """The directory of the present history; begun from the stored rows where there is none."""
        directory = KeyDirectory(self.spark, self.root, min(listed.values()), self.key_buckets)
        if not directory.exists():
            directory.add(stored.select(F.col(self.key).cast("string").alias("row_key"), self._label().alias("month")))
        return directory

    def replace(self, rows: DataFrame, *, audit: Audit | None = None, cut_by: str | None = None, parts: int = 1) -> None:
        """Full load: the table holds exactly ``rows`` afterwards.

        ``audit`` sees the written rows before they are published and may raise. With ``parts`` the rows are made and written in so many
        parts by the hash of ``cut_by``, one after the other, so the disk holds the shuffle of one part; the column should be one that a filter
        on the rows passes down to their sources. What is published is complete.
        """
        self._publish(self._cut(rows), self._published()[0] + 1, {}, audit, cut_by, parts)

    def upsert(self, batch: DataFrame, *, replace_months: bool = False, audit: Audit | None = None) -> None:
        """Merge a batch by key; only months that gain, change or lose a row are rewritten.

        A row may have moved to another month: the months that hold an old copy of
        a batch key are found by a scan of the key and month columns alone.
        ``replace_months=True`` drops every stored row of the batch's months first,
        so rows that vanished upstream vanish here too. A first load takes the
        batch as it is.
        """
        publish, listed = self._published()
        # Written once: the batch is read several times below, and a lost executor costs no rerun of its plan.
        incoming_path = f"{self.root}/{INCOMING}/{uuid.uuid4().hex}"
        write_files(_watched(batch, audit), incoming_path)
        batch = self.spark.read.schema(batch.schema).parquet(incoming_path)
        if not any_rows(batch):
            return
        if any_rows(duplicate_keys(batch, self.key)):
            raise ValueError(f"batch repeats a value of {self.key}")
        _run_audit(audit, batch, self.key)
        if not listed:
            return self._publish(self._cut(batch), publish + 1, {})
        batch = self._cut(batch)
        incoming = {r[0] for r in batch.select(self._label()).distinct().collect()}
        stored = self._read(listed)
        moved_from = set()
        if self.key_buckets:
            moved_from = self._directory(listed, stored).take(batch, self.key, self._label())
        elif not self.month_in_key:
            old_copies = stored.select(self.key, self.month).join(batch.select(self.key), self.key, "left_semi")
            moved_from = {r[0] for r in old_copies.select(self._label()).distinct().collect()}
        touched = incoming | moved_from
        old = stored.where(self._label().isin(sorted(touched)))
        if replace_months:
            old = old.where(~self._label().isin(sorted(incoming)))
        keep = {month: version for month, version in listed.items() if month not in touched}
        self._publish(merge_rows(old, batch, self.key), publish + 1, keep)


def merge_into(batch: DataFrame, table: str, key: str) -> None:
    """Upsert into a catalog table whose format supports row-level merge."""
    condition = F.col(f"{table}.{key}") == F.col(f"batch.{key}")
    (
        batch.alias("batch").mergeInto(table, condition)
        .withSchemaEvolution()
        .whenMatched().updateAll()
        .whenNotMatched().insertAll()
        .merge()
    )


# --- which rows an incremental run takes -------------------------------------


def since_last_load(staged: DataFrame, stored: DataFrame, day: str, ctx: RunContext) -> DataFrame:
    """Rows from ``lookback_days`` before the newest stored day on; all rows if nothing is stored."""
    newest = stored.agg(F.max(day)).scalar()
    floor = F.date_sub(newest, ctx.lookback_days)
    return staged.where(F.col(day) >= F.coalesce(floor, F.lit("0001-01-01").cast("date")))


def changing_subscriptions(staged: DataFrame, ctx: RunContext, *, include_recent_ends: bool = True) -> DataFrame:
    """Subscriptions an incremental run takes again.

    Active ones and those whose trial began in the lookback months. Without
    ``include_recent_ends`` an old subscription that was cancelled since the last
    run is missed and stays active in the stored fact; with it, ends and
    cancellations inside the lookback are taken too.
    """
    recent = F.add_months(ctx.today(), -ctx.lookback_months)
    chosen = F.col("is_active") | (F.col("trial_start_date") >= recent)
    if include_recent_ends:
        ended = F.coalesce(F.greatest("cancelled_date", "subscription_end_date") >= recent, F.lit(False))
        chosen = F.coalesce(chosen, F.lit(False)) | ended
    return staged.where(chosen)


# --- sinks without months -----------------------------------------------------


def replace_table(rows: DataFrame, path: str) -> None:
    """Full replace of a mart without a month column. ``rows`` must not read ``path``."""
    write_files(rows, path, mode="overwrite")


def as_view(rows: DataFrame, name: str) -> DataFrame:
    """Expose a staging or intermediate result to SQL under a name."""
    rows.createOrReplaceTempView(name)
    return rows
