from dataclasses import replace
from datetime import date
from hashlib import md5

import pyarrow.parquet as pq
import pytest
from fixtures import event, subscription, table
from pyspark.sql import functions as F

from ledgerlight.context import RunContext
from ledgerlight.functions.keys import with_known_keys, without_known_keys
from ledgerlight.operators import checks, contracts, tables
from ledgerlight.operators.contracts import CONTRACTS
from ledgerlight.operators.dimensions import dim_plans
from ledgerlight.operators.funnel import fct_user_funnel
from ledgerlight.operators.staging import stg_plans, stg_subscriptions
from ledgerlight.operators.tables import MonthTable
from ledgerlight.plans.build import build_marts, check_build
from ledgerlight.plans.marts import Marts
from ledgerlight.sources.readers import RawTables, plan_seed

CTX = RunContext(as_of=date(2024, 3, 15), reporting_start=date(2023, 1, 1))


def rows(spark, values, columns="k string, month string, v int"):
    return spark.createDataFrame(values, columns)


def content(stored):
    return sorted((r.k, r.month, r.v) for r in stored.read().collect())


def test_upsert_replaces_adds_and_moves(spark, tmp_path):
    stored = MonthTable(spark, str(tmp_path), "k", "month")
    assert not stored.exists()
    stored.upsert(rows(spark, [("a", "202401", 1), ("b", "202401", 2), ("c", "202402", 3), ("n", None, 4)]))
    stored.upsert(rows(spark, [("a", "202401", 10), ("c", "202403", 30), ("d", "202402", 40)]))
    found = sorted(((r.k, r.month, r.v) for r in stored.read().collect()), key=lambda r: r[0])
    assert found == [("a", "202401", 10), ("b", "202401", 2), ("c", "202403", 30), ("d", "202402", 40), ("n", None, 4)]
    # The month nobody touched is still read from the first version.
    assert stored.months()[""] == 1 and stored.months()["202403"] == 2


def test_a_month_can_empty_out(spark, tmp_path):
    stored = MonthTable(spark, str(tmp_path), "k", "month")
    stored.upsert(rows(spark, [("a", "202401", 1), ("b", "202402", 2)]))
    stored.upsert(rows(spark, [("a", "202402", 1)]))
    assert stored.months() == {"202402": 2}
    assert content(stored) == [("a", "202402", 1), ("b", "202402", 2)]


def test_duplicate_keys_in_a_batch_are_refused_and_nothing_changes(spark, tmp_path):
    stored = MonthTable(spark, str(tmp_path), "k", "month")
    stored.upsert(rows(spark, [("a", "202401", 1)]))
    with pytest.raises(ValueError, match="repeats"):
        stored.upsert(rows(spark, [("b", "202401", 1), ("b", "202402", 2)]))
    assert content(stored) == [("a", "202401", 1)]


def test_a_failed_audit_publishes_nothing(spark, tmp_path):
    def refuse(_):
        raise RuntimeError("no")

    stored = MonthTable(spark, str(tmp_path), "k", "month")
    stored.replace(rows(spark, [("a", "202401", 1)]))
    with pytest.raises(RuntimeError):
        stored.replace(rows(spark, [("z", "202401", 9)]), audit=refuse)
    with pytest.raises(RuntimeError):
        stored.upsert(rows(spark, [("z", "202401", 9)]), audit=refuse)
    assert content(stored) == [("a", "202401", 1)]
    stored.upsert(rows(spark, [("b", "202401", 2)]))
    assert content(stored) == [("a", "202401", 1), ("b", "202401", 2)]


def test_new_columns_are_appended(spark, tmp_path):
    stored = MonthTable(spark, str(tmp_path), "k", "month")
    stored.upsert(rows(spark, [("a", "202401", 1), ("b", "202402", 2)]))
    stored.upsert(rows(spark, [("a", "202401", 5, "x")], "k string, month string, v int, extra string"))
    assert {r.k: r.extra for r in stored.read().collect()} == {"a": "x", "b": None}


def test_vanished_rows_go_only_if_months_are_replaced(spark, tmp_path):
    stored = MonthTable(spark, str(tmp_path), "k", "month", month_in_key=True)
    stored.upsert(rows(spark, [("a", "202401", 1), ("b", "202401", 2), ("c", "202402", 3)]))
    stored.upsert(rows(spark, [("a", "202401", 1)]))
    assert len(content(stored)) == 3
    stored.upsert(rows(spark, [("a", "202401", 1)]), replace_months=True)
    assert content(stored) == [("a", "202401", 1), ("c", "202402", 3)]


def test_month_filter_prunes_partitions(spark, tmp_path):
    stored = MonthTable(spark, str(tmp_path), "k", "month")
    stored.upsert(rows(spark, [("a", "202401", 1), ("b", "202402", 2)]))
    plan = stored.read().where("month = '202402'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_lookback_takes_late_rows_of_three_days(spark):
    days = spark.createDataFrame([(date(2024, 1, d),) for d in (5, 7, 8, 10)], "event_date date")
    stored = days.where(F.col("event_date") == date(2024, 1, 10))
    taken = tables.since_last_load(days, stored, "event_date", CTX).collect()
    assert sorted(r.event_date.day for r in taken) == [7, 8, 10]
    assert tables.since_last_load(days, stored.limit(0), "event_date", CTX).count() == 4


def test_old_subscription_cancelled_now_is_taken(spark):
    staged = stg_subscriptions(table(spark, "subscriptions", [
        subscription("old", "u", "2023-01-01", "2024-03-01", 1, "cancelled"),
        subscription("older", "u", "2023-01-01", "2023-03-01", 1, "cancelled"),
        subscription("new", "u", "2024-02-01", "2024-02-10", 1, "cancelled"),
        subscription("open", "u", "2023-01-01", None, 1, "active"),
    ]), CTX)

    def ids(**options):
        return sorted(r.subscription_id for r in tables.changing_subscriptions(staged, CTX, **options).collect())

    assert ids() == ["new", "old", "open"]
    assert ids(include_recent_ends=False) == ["new", "open"]


def raw_tables(spark, events, subscriptions):
    users = [{"user_id": "u1", "created_at": "2024-01-01", "email": "a@b.co"},
             {"user_id": "u2", "created_at": "2024-01-01", "email": "a@b.co"}]
    payments = [{"payment_id": s["subscription_id"], "user_id": s["user_id"], "plan_id": "plan_starter",
                 "billing_cycle": "monthly", "amount": "10", "status": "succeeded",
                 "payment_date": s["subscription_start"]} for s in subscriptions]
    return RawTables(
        events=table(spark, "events", events),
        payments=table(spark, "payments", payments),
        subscriptions=table(spark, "subscriptions", subscriptions),
        users=table(spark, "users", users),
        plans=plan_seed(spark),
    )


def mart_rows(mart):
    kept = [c for c in mart.columns if c != "_stg_loaded_at"]
    return sorted(mart.select(sorted(kept)).collect(), key=str)


def expected_marts(raw):
    """The marts straight from the raw tables, in contract shape."""
    marts = Marts(raw, CTX)
    funnel = fct_user_funnel(marts.events, marts.subscriptions, marts.users, CTX, zero_stages=True)
    found = {"dim_users": marts.users, "dim_plans": marts.plans, "fct_events": marts.events, "fct_mrr": marts.mrr,
             "fct_payments": marts.payments, "fct_subscriptions": marts.subscriptions,
             "fct_cohort_retention": marts.cohort_retention, "fct_user_funnel": funnel}
    return {name: contracts.enforce(rows, CONTRACTS[name]) for name, rows in found.items()}


def test_incremental_build_equals_a_full_one(spark, tmp_path):
    events = [event("e1", "u1", "signed_up", "2024-02-27"), event("e2", "u1", "activated", "2024-03-08")]
    subs = [subscription("s1", "u1", "2023-05-01", None, 49, "active"),
            subscription("s2", "u2", "2023-11-01", "2024-01-15", 49, "cancelled")]
    first_ctx = replace(CTX, as_of=date(2024, 3, 10))
    build_marts(spark, raw_tables(spark, events, subs), first_ctx, str(tmp_path / "a"))

    # A late event, a corrected one, a cancellation and a new subscription arrive.
    events += [event("e3", "u2", "signed_up", "2024-03-06"), event("e4", "u2", "activated", "2024-03-12")]
    events[1] = event("e2", "u1", "converted_paid", "2024-03-08")
    subs[0] = subscription("s1", "u1", "2023-05-01", "2024-01-20", 49, "cancelled")
    subs.append(subscription("s3", "u1", "2024-03-11", None, 99, "active"))
    raw = raw_tables(spark, events, subs)
    grown = build_marts(spark, raw, CTX, str(tmp_path / "a"))
    fresh = expected_marts(raw)
    for name in fresh:
        if name != "fct_mrr":
            assert mart_rows(grown[name]) == mart_rows(fresh[name]), name
    # The MRR merge never deletes: a month the cancelled subscription lost stays until a refresh.
    extra = set(mart_rows(grown["fct_mrr"])) - set(mart_rows(fresh["fct_mrr"]))
    assert {(r.subscription_id, r.mrr_month) for r in extra} == {("s1", "202403")}
    assert set(mart_rows(fresh["fct_mrr"])) <= set(mart_rows(grown["fct_mrr"]))
    replaced = build_marts(spark, raw, CTX, str(tmp_path / "a"), replace_months=True)
    assert mart_rows(replaced["fct_mrr"]) == mart_rows(fresh["fct_mrr"])
    refreshed = build_marts(spark, raw, CTX, str(tmp_path / "a"), full_refresh=True)
    for name in fresh:
        assert mart_rows(refreshed[name]) == mart_rows(fresh[name]), name


def test_a_batch_of_one_day_leaves_other_days_alone(spark, tmp_path):
    def days(*rows):
        return spark.createDataFrame(rows, "k string, d date, v int")

    table = MonthTable(spark, str(tmp_path / "t"), "k", "unused", day="d")
    table.replace(days(("a", date(2024, 1, 1), 1), ("b", date(2024, 1, 2), 1), ("c", date(2024, 1, 3), 1), ("n", None, 1)))
    table.upsert(days(("b", date(2024, 1, 2), 2), ("d", date(2024, 1, 2), 2)))
    assert table.months() == {"20240101": 1, "20240102": 2, "20240103": 1, "": 1}
    assert {tuple(r) for r in table.read().select("k", "v").collect()} == {("a", 1), ("b", 2), ("c", 1), ("d", 2), ("n", 1)}
    # A row that moves to another day leaves the old one.
    table.upsert(days(("a", date(2024, 1, 3), 3)))
    assert table.months() == {"20240102": 2, "20240103": 3, "": 1}
    assert table.read().columns == ["k", "d", "v"]
    assert table.newest_day("d") == date(2024, 1, 3)


def test_checks_end_a_build_and_leave_no_old_failures(spark, tmp_path):
    events = [event("e1", "u1", "signed_up", "2024-02-27")]
    subs = [subscription("s1", "u1", "2023-05-01", None, 49, "active")]
    root, failures = str(tmp_path / "a"), str(tmp_path / "failures")
    raw = raw_tables(spark, events, subs)
    with pytest.raises(checks.ChecksFailed, match="raw_payments.subscription_id not_null: 1"):
        build_marts(spark, raw, CTX, root, failures=failures)
    rows_of = lambda: spark.read.parquet(f"{failures}/raw_payments/not_null__subscription_id").count()
    assert rows_of() == 1
    mended = replace(raw, payments=raw.payments.withColumn("subscription_id", F.lit("s1")))
    check_build(spark, mended, CTX, root, {}, failures)
    assert rows_of() == 0


def test_views_and_replace(spark, tmp_path):
    first = rows(spark, [("a", "202401", 1)])
    tables.replace_table(first, str(tmp_path / "t"))
    tables.replace_table(first, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    tables.as_view(first, "some_view")
    assert spark.sql("select v from some_view").first().v == 1


def test_comments_are_stored(spark, tmp_path):
    plans = dim_plans(stg_plans(plan_seed(spark)))
    tables.replace_table(contracts.enforce(plans, CONTRACTS["dim_plans"]), str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t")).schema
    assert stored["tier"].metadata["comment"] == "rank of the plan, 1 lowest"
    assert stored["sk_plan_id"].metadata["grain"] == "plan"


def test_old_copies_are_found_through_the_directory_of_keys(spark, tmp_path):
    def rows(*values):
        return spark.createDataFrame([(k, m, v) for k, m, v in values], "k string, m string, v int")

    plain = MonthTable(spark, str(tmp_path / "plain"), "k", "m")
    table = MonthTable(spark, str(tmp_path / "kept"), "k", "m", key_buckets=8)
    first = rows(*[(f"k{i}", f"2024{1 + i % 6:02d}", i) for i in range(60)])
    batches = [
        rows(("k0", "202406", 100), ("k1", "202402", 101), ("new", "202407", 102)),  # moved, changed, new
        rows(("k0", "202401", 200), ("new", "202401", 201), ("k5", "202406", 202)),  # moved back, moved
        rows(("k0", "202403", 300)),
    ]
    for t in (plain, table):
        t.replace(first)
        for batch in batches:
            t.upsert(batch)
    found = sorted(map(tuple, table.read().collect()))
    assert found == sorted(map(tuple, plain.read().collect())) and len(found) == 61
    directory = table._directory(table.months(), table.read())
    assert sorted(r.month for r in directory.of(rows(("k0", "", 0)).selectExpr("k row_key")).collect()) == ["202401", "202403", "202406"]

    # A run that fails after its keys were noted leaves the rows as they were, and the next one is right.
    def refuse(_):
        raise RuntimeError

    before = table.months()
    publish, table._publish = table._publish, refuse
    with pytest.raises(TypeError):
        table.upsert(rows(("k9", "202405", 400)))
    table._publish = publish
    assert table.months() == before
    table.upsert(rows(("k9", "202406", 401)))
    assert [tuple(r) for r in table.read().where("k = 'k9'").select("k", "m", "v").collect()] == [("k9", "202406", 401)]

    # A full load begins a new directory.
    table.replace(rows(("k0", "202401", 1)))
    table.upsert(rows(("k0", "202402", 2)))
    assert [tuple(r) for r in table.read().select("k", "m", "v").collect()] == [("k0", "202402", 2)]


def test_a_join_with_the_directory_moves_the_batch_only(spark, tmp_path):
    from ledgerlight.operators.key_directory import KeyDirectory

    directory = KeyDirectory(spark, str(tmp_path), 1, 8)
    directory.add(spark.range(2000).selectExpr("cast(id as string) row_key", "'202401' month"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = directory.of(spark.range(5).selectExpr("cast(id * 7 as string) row_key"))
        assert joined.count() == 5
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    join = plan[plan.index("SortMergeJoin"):]
    assert "Bucketed: true" in join
    # Below the join one exchange: that of the batch.
    assert join.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1


def test_stored_rows_travel_without_keys_that_their_columns_give_again(spark, tmp_path):
    rows = spark.sql("""
        select *, '202401' as mrr_month from values
            (md5('s1-202401'), 's1', md5('s1'), md5('u1'), 'u1'), ('own', 's2', md5(' s2'), null, 'u2'), (md5('s3-202401'), 's3', '', '=x', null)
        as t(sk_mrr_id, subscription_id, sk_subscription_id, sk_user_id, user_id)""")
    moved = without_known_keys(rows)
    assert [tuple(r)[2:4] for r in moved.collect()] == [(None, None), (f"={md5(b' s2').hexdigest()}", ""), ("=", "==x")]
    assert [r.sk_mrr_id for r in moved.collect()] == [None, "=own", None]
    assert with_known_keys(moved, rows).collect() == rows.collect()
    table = MonthTable(spark, str(tmp_path / "t"), "sk_mrr_id", "mrr_month", month_in_key=True)
    table.replace(rows)
    stored = table.read().select(rows.columns)
    assert sorted(stored.collect(), key=str) == sorted(rows.collect(), key=str)
    files = list((tmp_path / "t" / "version=1").rglob("*.parquet"))
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
