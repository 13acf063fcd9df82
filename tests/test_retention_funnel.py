from datetime import date
from decimal import Decimal

from fixtures import event, subscription, table

from ledgerlight.context import RunContext
from ledgerlight.operators import dimensions, facts, funnel, retention, staging
from ledgerlight.plans import product
from ledgerlight.sources.readers import plan_seed

CTX = RunContext(as_of=date(2024, 3, 15))


def staged(spark, subscriptions, events):
    return (
        staging.stg_subscriptions(table(spark, "subscriptions", subscriptions), CTX),
        staging.stg_events(table(spark, "events", events)),
    )


def test_one_row_per_cohort_up_to_twelve_months(spark):
    subs, events = staged(spark, [
        subscription("a", "u1", "2024-03-01", None, 1, "active"),
        subscription("b", "u2", "2023-03-01", None, 1, "active"),
        subscription("c", "u3", "2023-03-20", "2024-02-28", 1, "active"),
        subscription("d", "u4", "2023-02-01", None, 1, "active"),
        subscription("e", None, "2024-01-01", None, 1, "active"),
        subscription("f", "u5", "2024-01-01", None, 1, "cancelled"),
    ], [event("1", "u2", "activated", "2024-01-01"), event("2", "u2", "activated", "2024-01-02")])
    counts = retention.cohort_retention_asof(subs, events, CTX)
    rows = {r.cohort_month: r for r in retention.fct_cohort_retention(counts).collect()}
    # The cohort of age 13 is out; a cohort of unknown users keeps an empty row.
    assert set(rows) == {"202403", "202303", "202401"}
    newest, year_old, unknown = rows["202403"], rows["202303"], rows["202401"]
    assert (newest.months_since_cohort, newest.retention_rate, newest.period_label) == (0, 1, "Month 0 (start)")
    assert newest.activated_retention_rate is None and newest.activation_retention_lift is None
    assert (year_old.total_users, year_old.retained_users, year_old.activated_total_users) == (2, 1, 1)
    assert year_old.retention_rate == Decimal("0.5000") and year_old.retention_benchmark == Decimal("0.40")
    assert year_old.retention_vs_benchmark == Decimal("0.1000") and year_old.activation_retention_lift == 1
    assert (unknown.total_users, unknown.retention_rate) == (0, None)


def test_triangle_has_every_offset(spark):
    subs, events = staged(spark, [
        subscription("a", "u1", "2024-01-10", "2024-02-20", 1, "cancelled"),
        subscription("b", "u2", "2024-01-10", None, 1, "active"),
        subscription("c", "u2", "2024-01-12", "2024-01-15", 1, "cancelled"),
    ], [])
    rows = retention.cohort_retention_triangle(subs, events, CTX).orderBy("months_since_cohort").collect()
    assert [(r.months_since_cohort, r.total_users, r.retained_users) for r in rows] == [(0, 2, 2), (1, 2, 2), (2, 2, 1)]


def test_funnel_milestones(spark):
    users = dimensions.dim_users(staging.stg_users(table(spark, "users", [
        {"user_id": "u1", "created_at": "2024-01-01"},
        {"user_id": "u2", "created_at": "2024-01-01"},
        {"user_id": "u3", "created_at": "2024-01-01"},
    ])))
    subs, events = staged(spark, [
        subscription("old", "u1", "2023-01-01", "2023-06-01", 10, "cancelled", cancel_reason="price"),
        subscription("new", "u1", "2024-01-01", None, 30, "active"),
        subscription("never", "u2", None, None, 5, "trial expired"),
        subscription("paid", "u2", "2024-01-01", "2024-02-01", 7, "cancelled", cancel_reason="price"),
    ], [
        event("1", "u1", "signed_up", "2024-01-05"),
        event("2", "u1", "activated", "2024-01-09"),
        event("3", "u1", "activated", "2024-01-07"),
        event("4", "u1", "invited_team_member", "2024-01-10"),
        event("5", "u2", "mystery", "2024-01-10"),
    ])
    rows = {r.user_id: r for r in funnel.fct_user_funnel(
        facts.fct_events(events, None), facts.fct_subscriptions(subs, None, staging.stg_plans(plan_seed(spark))), users, CTX
    ).collect()}
    first = rows["u1"]
    assert (first.highest_funnel_stage_order, first.highest_funnel_stage_name) == (6, "activated")
    assert (first.distinct_funnel_stages_reached, first.days_to_activation) == (2, 2)
    assert first.has_churned and first.has_paid_subscription
    assert first.last_cancel_reason is None and first.current_mrr == 30
    # Only an unknown event: no milestone, signup falls back to the profile.
    second = rows["u2"]
    assert second.distinct_funnel_stages_reached is None and second.signed_up_date == date(2024, 1, 1)
    # A trial that never became paid counts as the latest subscription.
    assert second.current_mrr == 5 and second.last_cancel_reason is None
    assert rows["u3"].has_paid_subscription is False and rows["u3"].current_mrr is None


def test_shares_and_medians(spark):
    funnel_rows = spark.createDataFrame(
        [("a", 1, "signed up", 1), ("b", 1, "signed up", 2), ("c", 6, "activated", 9), ("d", None, None, None)],
        "user_id string, highest_funnel_stage_order int, highest_funnel_stage_name string, days int",
    ).selectExpr("*", "days days_to_email_verified", "days days_to_activation", "days days_to_conversion")
    shares = {r.stage_order: r.pct_of_all_users for r in product.funnel_dropoff(funnel_rows).collect()}
    assert shares == {1: Decimal("50.0"), 6: Decimal("25.0"), None: Decimal("25.0")}
    row = product.time_to_milestones(funnel_rows).first()
    assert (row.p50_days_to_activation, row.avg_days_to_activation) == (2.0, 4.0)
