from datetime import date

import pytest
from fixtures import subscription, table
from hypothesis import HealthCheck, given, settings, strategies as st

from ledgerlight.context import RunContext
from ledgerlight.operators import facts, mrr, staging
from ledgerlight.operators.mrr_carry import CarriedState, fct_mrr_window, window_start
from ledgerlight.operators.tables import MonthTable
from ledgerlight.plans import revenue
from ledgerlight.sources.readers import plan_seed

CTX = RunContext(as_of=date(2022, 8, 15), reporting_start=date(2022, 1, 1))

CASES = [
    subscription("S1", "U1", "2022-01-15", "2022-03-10", 49, "cancelled"),
    subscription("S2", "U1", "2022-06-01", None, 49, "active"),
    subscription("S3", "U2", "2022-02-01", "2022-03-31", 49, "cancelled"),
    subscription("S4", "U2", "2022-04-01", None, 129, "active"),
    subscription("S5", "U3", "2022-05-10", "2022-06-30", 129, "cancelled"),
    subscription("S6", "U3", "2022-07-01", None, 49, "active"),
    subscription("S7", "U4", "2021-11-20", "2022-01-31", 99, "cancelled"),
    subscription("S8", "U5", "2022-08-02", "2022-08-20", 49, "cancelled"),
]

EXPECTED = {
    "U1": "202201 new 49, 202202 retained 0, 202203 retained 0, 202204 churned -49, 202206 reactivation 0, "
          "202207 retained 0, 202208 retained 0",
    "U2": "202202 new 49, 202203 retained 0, 202204 churned -49, 202204 expansion 80, 202205 retained 0, "
          "202206 retained 0, 202207 retained 0, 202208 retained 0",
    "U3": "202205 new 129, 202206 retained 0, 202207 churned -129, 202207 contraction -80, 202208 retained 0",
    "U4": "202201 new 99, 202202 churned -99",
    "U5": "202208 new 49, 202209 churned -49",
}


def subscriptions(spark, rows, ctx=CTX):
    plans = staging.stg_plans(plan_seed(spark))
    return facts.fct_subscriptions(staging.stg_subscriptions(table(spark, "subscriptions", rows), ctx), None, plans)


def by_user(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.user_id, r.mrr_month, r.mrr_movement_type)):
        found.setdefault(r.user_id, []).append(f"{r.mrr_month} {r.mrr_movement_type} {r.mrr_delta:.0f}")
    return {user: ", ".join(texts) for user, texts in found.items()}


def key(r):
    return (r.subscription_id, r.mrr_month, r.mrr_movement_type, r.mrr, r.prev_mrr, r.mrr_delta, r.sk_mrr_id)


def all_split(subs, ctx=CTX):
    """Every user with two month rows or more in the split lane."""
    return mrr.find_hot_users(subs, ctx, min_rows=1)


def test_every_movement(spark):
    rows = mrr.fct_mrr(subscriptions(spark, CASES), CTX).collect()
    assert len(rows) == 24
    assert by_user(rows) == EXPECTED


def test_split_lane_gives_the_same_rows(spark):
    subs = subscriptions(spark, CASES)
    assert by_user(mrr.fct_mrr(subs, CTX, hot=all_split(subs)).collect()) == EXPECTED


def test_no_user_is_hot_by_default(spark):
    assert mrr.find_hot_users(subscriptions(spark, CASES), CTX) is None


def test_order_within_a_month_is_start_then_id(spark):
    subs = subscriptions(spark, [
        subscription("B", "U", "2022-08-01", None, 20, "active"),
        subscription("A", "U", "2022-08-05", None, 30, "active"),
        subscription("C", "U", "2022-08-01", None, 10, "active"),
    ])
    rows = {r.subscription_id: r for r in mrr.fct_mrr(subs, CTX).collect()}
    assert [rows[s].mrr_movement_type for s in "BCA"] == ["new", "contraction", "expansion"]


def test_starts_after_as_of_and_ends_before_the_window_leave_no_month(spark):
    subs = subscriptions(spark, [
        subscription("late", "U", "2022-09-01", None, 20, "active"),
        subscription("early", "U", "2021-01-01", "2021-06-01", 20, "trial expired"),
    ])
    assert mrr.fct_mrr(subs, CTX).count() == 0


def test_cancelled_without_end_repeats_a_month(spark):
    subs = subscriptions(spark, [
        subscription("S", "U", "2022-05-01", None, 20, "cancelled", cancelled_at="2022-06-10"),
    ])
    rows = mrr.fct_mrr(subs, CTX).collect()
    assert by_user(rows) == {
        "U": "202205 new 20, 202206 retained 0, 202207 churned -20, 202207 retained 0, 202208 retained 0"
    }
    assert mrr.fct_mrr(subs, CTX, hot=all_split(subs)).count() == len(rows)


def test_reactivation_may_book_the_full_mrr(spark):
    subs = subscriptions(spark, CASES[:2])
    rows = mrr.fct_mrr(subs, CTX, reactivation_delta="full").where("mrr_movement_type = 'reactivation'").collect()
    assert [int(r.mrr_delta) for r in rows] == [49]
    with pytest.raises(ValueError):
        mrr.fct_mrr(subs, CTX, reactivation_delta="half")


def test_incremental_rows_are_the_full_rows_of_the_lookback(spark):
    subs = subscriptions(spark, CASES)
    full = {key(r) for r in mrr.fct_mrr(subs, CTX).collect() if r.mrr_month >= "202205"}
    assert {key(r) for r in mrr.fct_mrr(subs, CTX, incremental=True).collect()} == full


def test_totals_per_span_equal_the_month_rows(spark):
    subs = subscriptions(spark, CASES)
    from_rows = revenue.mrr_arr(mrr.live_rows(mrr.fct_mrr(subs, CTX))).collect()
    assert revenue.mrr_arr(mrr.active_mrr_by_month(subs, CTX)).collect() == from_rows
    latest = mrr.latest_month(subs, CTX).first().mrr_month
    assert latest == max(r.mrr_month for r in mrr.fct_mrr(subs, CTX).collect())


day = st.dates(date(2021, 10, 1), date(2022, 10, 1))
one_subscription = st.tuples(
    st.sampled_from(["u1", "u2", None]), day, st.none() | day, st.integers(1, 3), st.sampled_from(["active", "cancelled"])
)


def brute_force(rows):
    """Month by month over plain Python rows."""
    def number(d):
        return d.year * 12 + d.month - 1

    live, result = [], []
    for position, (user, start, end, amount, status) in enumerate(rows):
        last = min(end or CTX.as_of, CTX.as_of)
        for month in range(max(number(start), number(CTX.reporting_start)), number(last) + 1):
            live.append((user or "", month, start, f"id{position}", amount))
        if status == "cancelled" and end is not None:
            result.append((f"id{position}", number(end) + 1, "churned", -amount))
    before = {}
    for user, month, _, subscription_id, amount in sorted(live):
        previous = before.get(user)
        if previous is None:
            movement, delta = "new", amount
        else:
            delta = amount - previous[1]
            movement = ("reactivation" if month > previous[0] + 1 else "expansion" if delta > 0
                        else "contraction" if delta < 0 else "retained")
        before[user] = (month, amount)
        result.append((subscription_id, month, movement, delta))
    return sorted(result)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(one_subscription, min_size=1, max_size=8))
def test_both_lanes_against_brute_force(spark, rows):
    raw = [
        subscription(f"id{i}", user, str(start), str(end) if end else None, amount, status)
        for i, (user, start, end, amount, status) in enumerate(rows)
    ]
    subs = subscriptions(spark, raw)
    for hot in (None, all_split(subs)):
        found = sorted(
            (r.subscription_id, int(r.mrr_month[:4]) * 12 + int(r.mrr_month[4:]) - 1, r.mrr_movement_type, int(r.mrr_delta))
            for r in mrr.fct_mrr(subs, CTX, hot=hot).collect()
        )
        assert found == brute_force(rows)


def stored_mrr(spark, root, subs, ctx):
    table_ = MonthTable(spark, f"{root}/fct_mrr", "sk_mrr_id", "mrr_month", month_in_key=True)
    table_.replace(mrr.fct_mrr(subs, ctx))
    return table_


RUNS = [date(2022, 5, 31), date(2022, 6, 2), date(2022, 8, 15), date(2023, 1, 10)]


def test_carried_state_gives_the_rows_of_a_full_run_month_after_month(spark, tmp_path):
    ctxs = [RunContext(as_of=d, reporting_start=date(2022, 1, 1)) for d in RUNS]
    subs = subscriptions(spark, CASES)
    stored = stored_mrr(spark, tmp_path, subs, ctxs[0])
    states = CarriedState(spark, str(tmp_path), stored)
    for ctx in ctxs[1:]:
        rows = states.rows(subs, ctx)
        full = {key(r) for r in mrr.fct_mrr(subs, ctx).collect()}
        # Five months pass before the last run, so its window begins where the stored live rows end.
        start = min(window_start(ctx).strftime("%Y%m"), "202208")
        assert {key(r) for r in rows.collect()} == {r for r in full if r[1] >= start}
        stored.upsert(rows)
        assert {key(r) for r in stored.read().collect()} == full


def test_only_months_between_two_windows_are_scanned(spark, tmp_path):
    subs = subscriptions(spark, CASES)
    stored = stored_mrr(spark, tmp_path, subs, CTX)
    states = CarriedState(spark, str(tmp_path), stored)
    first = states.before(date(2022, 3, 1), subs)
    assert {r.user_id: (r.month_start, int(r.mrr)) for r in first.collect()} == {"U1": (date(2022, 2, 1), 49), "U2": (date(2022, 2, 1), 49), "U4": (date(2022, 1, 1), 99)}
    for month in ("202201", "202202"):  # no longer needed
        for path in (tmp_path / "fct_mrr").glob(f"version=*/mrr_month={month}/*.parquet"):
            path.unlink()
    later = states.before(date(2022, 5, 1), subs)
    assert {r.user_id: r.month_start for r in later.collect()} == {
        "U1": date(2022, 3, 1), "U2": date(2022, 4, 1), "U4": date(2022, 1, 1)
    }


def test_a_full_load_makes_older_states_invalid(spark, tmp_path):
    stored = stored_mrr(spark, tmp_path, subscriptions(spark, CASES), CTX)
    states = CarriedState(spark, str(tmp_path), stored)
    assert states.before(window_start(CTX), subscriptions(spark, CASES)).count() == 3
    fewer = subscriptions(spark, CASES[:2])
    stored.replace(mrr.fct_mrr(fewer, CTX))
    assert [r.user_id for r in states.before(window_start(CTX), fewer).collect()] == ["U1"]


def test_only_changed_users_are_computed(spark, tmp_path):
    subs = subscriptions(spark, CASES)
    stored = stored_mrr(spark, tmp_path, subs, CTX)
    changed = subscriptions(spark, CASES[:3] + [subscription("S4", "U2", "2022-04-01", "2022-07-20", 129, "cancelled")] + CASES[4:])
    states = CarriedState(spark, str(tmp_path), stored)
    rows = states.rows(changed, CTX, users=spark.createDataFrame([("U2",)], "user_id string"))
    assert {r.user_id for r in rows.collect()} == {"U2"}
    expected = {key(r) for r in mrr.fct_mrr(changed, CTX, incremental=True).collect() if r.user_id == "U2"}
    assert {key(r) for r in rows.collect()} == expected


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(one_subscription, min_size=1, max_size=8))
def test_carried_state_of_random_histories_in_both_lanes(spark, tmp_path_factory, rows):
    raw = [
        subscription(f"id{i}", user, str(start), str(end) if end else None, amount, status)
        for i, (user, start, end, amount, status) in enumerate(rows)
    ]
    subs, root = subscriptions(spark, raw), tmp_path_factory.mktemp("carry")
    full = mrr.fct_mrr(subs, CTX)
    if full.isEmpty():
        return
    states = CarriedState(spark, str(root), stored_mrr(spark, root, subs, CTX))
    expected = {key(r) for r in mrr.fct_mrr(subs, CTX, incremental=True).collect()}
    for hot in (None, all_split(subs)):
        assert {key(r) for r in fct_mrr_window(subs, states.before(window_start(CTX), subs), CTX, hot=hot).collect()} == expected
