"""The event feed as a stream.

Late events are taken for the same number of days as in a batch run. State
grows with the events of those days: on a large feed, run with ``durable_state``, which keeps it in RocksDB and
writes only changes to the checkpoint. Events that come later still are left out by the state's watermark;
``stream_late_events`` brings them in by their key.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ledgerlight.context import RunContext
from ledgerlight.functions.dates import yyyymm
from ledgerlight.functions.keys import surrogate_key
from ledgerlight.operators import contracts, facts
from ledgerlight.operators.contracts import CONTRACTS
from ledgerlight.operators.staging import stg_events
from ledgerlight.operators.tables import MonthTable


ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def durable_state(spark: SparkSession) -> Iterator[None]:
    """Streams started within it keep their state on the executors' disks and log changes to their checkpoint.

    A checkpoint stays with the kind of state it was begun with.
    """
    before = {name: spark.conf.get(name, None) for name in ROCKSDB_STATE}
    for name, value in ROCKSDB_STATE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def cleaned_stream(raw: DataFrame, ctx: RunContext) -> DataFrame:
    """Staged events of a raw stream, each event id once within the lookback."""
    return (
        stg_events(raw, keep_event_time=True)
        .withWatermark("event_ts", f"{ctx.lookback_days} days")
        .dropDuplicatesWithinWatermark(["event_id"])
    )


def stream_events(
    raw: DataFrame, users: DataFrame, table: MonthTable, checkpoint: str, ctx: RunContext
) -> StreamingQuery:
    """Upsert a raw event stream into the stored event fact; takes what is there, then stops.

    A batch that is run again after a failure replaces its own rows.
    """

    def merge(batch: DataFrame, _: int) -> None:
        rows = facts.fct_events(batch.drop("event_ts"), users)
        table.upsert(contracts.enforce(rows, CONTRACTS["fct_events"]))

    return (
        cleaned_stream(raw, ctx)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_late_events(
    raw: DataFrame, users: DataFrame, table: MonthTable, checkpoint: str, ctx: RunContext
) -> StreamingQuery:
    """Upsert the events that came after their lookback; takes what is there, then stops. Runs after ``stream_events`` over the same feed.

    Older than the lookback of the newest stored day, and not stored yet: only the months (or days) such events
    belong to are read. No state is kept, so nothing is too late.
    """

    def merge(batch: DataFrame, _: int) -> None:
        newest = table.newest_day("event_date")
        if newest is None:
            return
        # Most of what is old is stored: raw rows meet the stored keys, and only the missing ones are staged.
        day = F.col("event_at").cast("date")
        placed = batch.withColumns({"sk_event_id": surrogate_key("event_id"), "event_date": day, "event_month": yyyymm(day)})
        missing = placed.where(F.col("event_date") <= F.lit(newest - timedelta(days=ctx.lookback_days)))
        stored = table.read_like(missing)
        if stored is not None:
            missing = missing.join(stored.select(table.key), table.key, "left_anti")
        staged = stg_events(missing.select(batch.columns)).dropDuplicates(["event_id"])
        table.upsert(contracts.enforce(facts.fct_events(staged, users), CONTRACTS["fct_events"]))

    return (
        raw.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def churn_monitor(
    raw: DataFrame, users: DataFrame, table: MonthTable, checkpoint: str, ctx: RunContext
) -> StreamingQuery:
    """Keep the cancellations of a raw event stream; takes what is there, then stops.

    One row per cancellation, keyed by event, so open days show at once, later
    ones replace nothing, and a batch that is run again counts once. ``churn_counts`` reads the table.
    """
    channels = users.select("user_id", "acquisition_channel")
    kept = ["sk_event_id", "event_date", "event_month", "churn_reason", "acquisition_channel"]

    def merge(batch: DataFrame, _: int) -> None:
        table.upsert(batch.join(channels, "user_id", "left").select(kept))

    return (
        cleaned_stream(raw, ctx)
        .where("is_churn")
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def churn_counts(cancellations: DataFrame) -> DataFrame:
    """Cancellations per day, reason and channel, open days included."""
    return cancellations.groupBy("event_date", "churn_reason", "acquisition_channel").agg(F.count("*").alias("cancellations"))
