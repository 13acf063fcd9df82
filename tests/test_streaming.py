import json
from datetime import date, datetime, timedelta

import pytest

from ledgerlight.context import RunContext
from ledgerlight.operators.staging import stg_events
from ledgerlight.operators.tables import MonthTable
from ledgerlight.sources.schemas import RAW_EVENTS
from ledgerlight.streaming import events
from ledgerlight.streaming.events import churn_counts, churn_monitor, durable_state, stream_events, stream_late_events
from ledgerlight.streaming.freshness import freshness

CTX = RunContext(as_of=date(2024, 3, 15))


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [("k1", "u1", "ads"), ("k2", "u2", "organic")], "sk_user_id string, user_id string, acquisition_channel string"
    )


def test_events_too_late_for_the_state_come_in_by_their_key(spark, users, tmp_path):
    feed = Feed(spark, tmp_path / "feed")
    table = MonthTable(spark, str(tmp_path / "fct_events"), "sk_event_id", "event_month", day="event_date")

    def run():
        with durable_state(spark):
            for start, name in ((stream_events, "state"), (stream_late_events, "late")):
                start(feed.stream(), users, table, str(tmp_path / name), CTX).awaitTermination()
        return {r.event_id: (r.sk_user_id, str(r.event_date)) for r in table.read().collect()}

    feed.add(("e1", "u1", "signed_up", "2024-01-10 10:00:00"), ("e2", "u2", "activated", "2024-02-10 09:00:00"))
    expected = {"e1": ("k1", "2024-01-10"), "e2": ("k2", "2024-02-10")}
    assert run() == expected
    # Weeks late, once in a delivery of its own day and twice over; a known one again; one on time.
    feed.add(("e3", "u1", "activated", "2024-01-10 11:00:00"), ("e4", "u2", "activated", "2023-12-01 08:00:00"),
             ("e4", "u2", "activated", "2023-12-01 08:00:00"), ("e1", "u1", "signed_up", "2024-01-10 10:00:00"),
             ("e5", "u1", "converted_paid", "2024-02-11 00:00:00"))
    versions = dict(table.months())
    expected |= {"e3": ("k1", "2024-01-10"), "e4": ("k2", "2023-12-01"), "e5": ("k1", "2024-02-11")}
    assert run() == expected and table.read().count() == 5
    assert table.months()["20240210"] == versions["20240210"]
    assert (tmp_path / "state" / "state").exists() and list((tmp_path / "state" / "state").rglob("*.changelog"))
    feed.add(("e4", "u2", "activated", "2023-12-01 08:00:00"))
    versions = dict(table.months())
    assert run() == expected and table.months() == versions


class Feed:
    """A folder of event files, read one file per batch."""

    def __init__(self, spark, root):
        self.spark, self.root, self.files = spark, root, 0
        root.mkdir()

    def add(self, *events):
        self.files += 1
        names = ("event_id", "user_id", "event_name", "event_at", "reason")
        lines = []
        for values in events:
            row = dict(zip(names, values))
            row["properties"] = json.dumps({"reason": row.pop("reason", None)})
            row["session_id"] = "s"
            lines.append(json.dumps(row))
        (self.root / f"{self.files:03}.json").write_text("\n".join(lines))

    def stream(self):
        return self.spark.readStream.schema(RAW_EVENTS).option("maxFilesPerTrigger", 1).json(str(self.root))


def test_stream_upserts_each_event_once(spark, users, tmp_path):
    feed = Feed(spark, tmp_path / "feed")
    feed.add(("e1", "u1", "signed_up", "2024-01-30 10:00:00"), ("e1", "u1", "signed_up", "2024-01-30 10:00:00"),
             ("e2", "u9", "activated", "2024-01-31 09:00:00"))
    # Two days late is taken, a copy within the lookback is not.
    feed.add(("e3", "u2", "activated", "2024-01-29 10:00:00"), ("e1", "u1", "signed_up", "2024-01-30 10:00:00"))
    table = MonthTable(spark, str(tmp_path / "fct_events"), "sk_event_id", "event_month")
    stream_events(feed.stream(), users, table, str(tmp_path / "checkpoint"), CTX).awaitTermination()
    # The next run goes on where this one stopped; an event nine days late is too late.
    feed.add(("e4", "u1", "converted_paid", "2024-02-10 00:00:00"))
    stream_events(feed.stream(), users, table, str(tmp_path / "checkpoint"), CTX).awaitTermination()
    feed.add(("e5", "u1", "converted_paid", "2024-02-01 00:00:00"))
    stream_events(feed.stream(), users, table, str(tmp_path / "checkpoint"), CTX).awaitTermination()
    found = {r.event_id: (r.sk_user_id, r.event_month) for r in table.read().collect()}
    assert found == {"e1": ("k1", "202401"), "e2": (None, "202401"), "e3": ("k2", "202401"), "e4": ("k1", "202402")}
    assert table.read().count() == 4


def test_churn_monitor_shows_open_days_and_goes_on(spark, users, tmp_path):
    feed = Feed(spark, tmp_path / "feed")
    feed.add(("e1", "u1", "cancellation_initiated", "2024-01-01 10:00:00", "price"),
             ("e2", "u1", "cancellation_initiated", "2024-01-01 12:00:00", "price"),
             ("e3", "u2", "cancellation_initiated", "2024-01-01 12:00:00", "price"),
             ("e4", "u2", "signed_up", "2024-01-01 12:00:00"))
    feed.add(("e5", "u2", "cancellation_initiated", "2024-01-05 12:00:00", "other"))
    table = MonthTable(spark, str(tmp_path / "out"), "sk_event_id", "event_month")

    def counts():
        churn_monitor(feed.stream(), users, table, str(tmp_path / "checkpoint"), CTX).awaitTermination()
        rows = churn_counts(table.read()).collect()
        return {(r.event_date, r.churn_reason, r.acquisition_channel): r.cancellations for r in rows}

    first, later = date(2024, 1, 1), date(2024, 1, 5)
    closed = {(first, "price", "ads"): 2, (first, "price", "organic"): 1}
    assert counts() == closed | {(later, "other", "organic"): 1}
    feed.add(("e6", "u2", "cancellation_initiated", "2024-01-05 13:00:00", "other"), ("e5", "u2", "cancellation_initiated", "2024-01-05 12:00:00", "other"))
    assert counts() == closed | {(later, "other", "organic"): 2}


@pytest.mark.parametrize(("hours", "status"), [(1, "pass"), (30, "warn"), (100, "error")])
def test_freshness(spark, hours, status):
    rows = spark.sql("select timestamp '2024-01-01 00:00:00' as loaded")
    now = datetime(2024, 1, 1) + timedelta(hours=hours)
    row = freshness(rows, "s", "loaded", now, timedelta(days=1), timedelta(days=3)).first()
    assert (row.age_seconds, row.status) == (hours * 3600, status)
    empty = freshness(rows.limit(0), "s", "loaded", now, timedelta(days=1), timedelta(days=3)).first()
    assert empty.status == "error"


def test_only_missing_late_events_are_staged(spark, users, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path / "feed")
    table = MonthTable(spark, str(tmp_path / "fct_events"), "sk_event_id", "event_month")
    staged = []

    def counted(raw, **options):
        if not raw.isStreaming:
            staged.append(raw.count())
        return stg_events(raw, **options)

    monkeypatch.setattr(events, "stg_events", counted)
    feed.add(("e1", "u1", "signed_up", "2024-01-10 10:00:00"), ("e2", "u1", "activated", "2024-02-10 09:00:00"))
    stream_events(feed.stream(), users, table, str(tmp_path / "state"), CTX).awaitTermination()
    feed.add(("e1", "u1", "signed_up", "2024-01-10 10:00:00"), ("e3", "u2", "activated", "2024-01-10 11:00:00", "price"),
             ("e3", "u2", "activated", "2024-01-10 11:00:00", "price"), ("e4", "u2", "activated", "2024-02-11 11:00:00"), (None, "u2", "activated", "2024-01-09 11:00:00"))
    stream_late_events(feed.stream(), users, table, str(tmp_path / "late"), CTX).awaitTermination()
    # Both copies of e3 and the one without an id, which staging leaves out.
    assert max(staged) == 3
    found = sorted((r.event_id, r.sk_user_id, r.churn_reason) for r in table.read().collect())
    assert [f[:2] for f in found] == [("e1", "k1"), ("e2", "k1"), ("e3", "k2")] and found[2][2] == "price"
