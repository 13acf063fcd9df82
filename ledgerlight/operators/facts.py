"""Event, payment and subscription facts: staged rows plus dimension keys.

All joins are left joins, so a row without its user or plan stays, with a NULL
key. No join carries a hint: Spark checks the size of the dimension, broadcasts
it while it is small (the plan catalogue has a handful of rows) and otherwise
sorts and merges, where adaptive execution splits the partition of a user or a
NULL key that holds a large share of the fact.

``users=None`` leaves the user key out. The dimension holds one row per user, so
the join never changes the rows, and reports that do not read the key skip a
full shuffle of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

EVENT_COLUMNS = [
    "sk_event_id",
    "event_id",
    "sk_user_id",
    "user_id",
    "session_id",
    "event_name",
    "funnel_stage_order",
    "is_funnel_event",
    "is_activation_event",
    "is_conversion_event",
    "is_upsell_event",
    "is_payment_failure_event",
    "is_churn",
    "event_source",
    "activation_action",
    "feature_used",
    "upgraded_from_plan",
    "upgraded_to_plan",
    "churn_reason",
    "raw_properties",
    "event_date",
    "event_month",
    "_stg_loaded_at",
]
PAYMENT_COLUMNS = [
    "sk_payment_id",
    "payment_id",
    "sk_user_id",
    "sk_plan_id",
    "user_id",
    "plan_id",
    "subscription_id",
    "billing_cycle",
    "currency",
    "status",
    "is_revenue_recognised",
    "is_failed",
    "is_refunded",
    "amount",
    "mrr_contribution",
    "payment_date",
    "payment_month",
    "period_start",
    "period_end",
    "days_in_period",
    "_stg_loaded_at",
]
SUBSCRIPTION_COLUMNS = [
    "sk_subscription_id",
    "subscription_id",
    "sk_user_id",
    "sk_plan_id",
    "user_id",
    "plan_id",
    "billing_cycle",
    "status",
    "cancel_reason",
    "cohort_month",
    "is_active",
    "is_churned",
    "is_trial_expired",
    "is_spike_churn",
    "mrr",
    "trial_duration_days",
    "subscription_duration_days",
    "trial_start_date",
    "trial_end_date",
    "subscription_start_date",
    "subscription_end_date",
    "cancelled_date",
    "effective_end_date",
    "_stg_loaded_at",
]


def with_user_key(rows: DataFrame, users: DataFrame | None) -> DataFrame:
    if users is None:
        return rows
    return rows.join(users.select("user_id", "sk_user_id"), "user_id", "left")


def with_plan_key(rows: DataFrame, plans: DataFrame) -> DataFrame:
    return rows.join(plans.select("plan_id", "sk_plan_id"), "plan_id", "left")


def _shaped(rows: DataFrame, columns: list[str], users: DataFrame | None) -> DataFrame:
    return rows.select([c for c in columns if users is not None or c != "sk_user_id"])


def fct_events(staged: DataFrame, users: DataFrame | None) -> DataFrame:
    return _shaped(with_user_key(staged, users), EVENT_COLUMNS, users)


def fct_payments(staged: DataFrame, users: DataFrame | None, plans: DataFrame) -> DataFrame:
    return _shaped(with_plan_key(with_user_key(staged, users), plans), PAYMENT_COLUMNS, users)


def fct_subscriptions(staged: DataFrame, users: DataFrame | None, plans: DataFrame) -> DataFrame:
    return _shaped(with_plan_key(with_user_key(staged, users), plans), SUBSCRIPTION_COLUMNS, users)
