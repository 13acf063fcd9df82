"""User funnel snapshot: one row per user with milestones, depth and subscription state.

Events and subscriptions are folded to one row per user by aggregates that
combine map-side, so a user with very many rows sends one row per task. The
user table is the spine of both left joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlight.context import RunContext
from ledgerlight.operators.staging import FUNNEL_EVENTS, FUNNEL_STAGES

FUNNEL_COLUMNS = [
    "sk_user_id",
    "user_id",
    "acquisition_channel",
    "company_size",
    "industry",
    "country",
    "signed_up_at",
    "signup_month",
    "email_verified_date",
    "trial_started_date",
    "onboarding_step1_date",
    "onboarding_step2_date",
    "activated_date",
    "converted_date",
    "highest_funnel_stage_order",
    "highest_funnel_stage_name",
    "distinct_funnel_stages_reached",
    "current_mrr",
    "max_subscription_duration_days",
    "first_subscription_start_date",
    "last_cancel_reason",
    "signed_up_date",
    "has_verified_email",
    "has_started_trial",
    "has_activated",
    "has_converted",
    "days_to_email_verified",
    "days_to_activation",
    "days_to_conversion",
    "has_paid_subscription",
    "has_churned",
]

# Milestone column -> the event that sets it.
MILESTONES = {
    "signed_up_event_date": "signed up",
    "email_verified_date": "email verified",
    "trial_started_date": "trial started",
    "onboarding_step1_date": "onboarding step1",
    "onboarding_step2_date": "onboarding step2",
    "activated_date": "activated",
    "converted_date": "converted paid",
}


STATE_COLUMNS = ["user_id", *MILESTONES, "stage_bits"]


def milestone_state(events: DataFrame) -> DataFrame:
    """What the funnel keeps of a user's events: the first date per milestone, and a bit per stage reached.

    A funnel event name and its stage number stand for each other, so the
    distinct names are counted as bits of one integer, and the deepest name is
    looked up by its number: no second aggregation, and no text in the buffer, which would make Spark sort all events.
    Users without a funnel event have no row. Both parts only ever take the smaller date or add a bit, so states
    can be merged in any order and any number of times.
    """
    name, stage = F.col("event_name"), F.col("funnel_stage_order")
    first_dates = [
        F.min(F.when(name == event, F.col("event_date"))).alias(column) for column, event in MILESTONES.items()
    ]
    stage_bit = F.call_function("shiftleft", F.lit(1), stage)
    return events.where("is_funnel_event").groupBy("user_id").agg(*first_dates, F.bit_or(stage_bit).alias("stage_bits"))


def merged_milestones(state: DataFrame, batch: DataFrame) -> DataFrame:
    """The state after the events of ``batch``, itself a state. Late and repeated events do no harm."""
    both = state.select(STATE_COLUMNS).unionByName(batch.select(STATE_COLUMNS))
    return both.groupBy("user_id").agg(*[F.min(c).alias(c) for c in MILESTONES], F.bit_or("stage_bits").alias("stage_bits"))


def milestones(state: DataFrame) -> DataFrame:
    """First date per milestone, deepest stage and number of distinct stages per user, from the state."""
    name_of = F.create_map(*[F.lit(x) for n in FUNNEL_EVENTS for x in (FUNNEL_STAGES[n], n)])
    deepest = F.length(F.bin("stage_bits")) - 1
    return state.select(
        "user_id",
        *MILESTONES,
        deepest.alias("highest_funnel_stage_order"),
        F.bit_count("stage_bits").cast("bigint").alias("distinct_funnel_stages_reached"),
        F.element_at(name_of, deepest).alias("highest_funnel_stage_name"),
    )


def user_milestones(events: DataFrame) -> DataFrame:
    """The milestones of each user with funnel events, read off all events."""
    return milestones(milestone_state(events))


def user_subscription_state(subscriptions: DataFrame, ctx: RunContext) -> DataFrame:
    """Subscriptions of a user as one row; the latest start decides MRR and reason.

    A subscription that never started its paid phase counts as started at ``as_of``.
    """
    recency = F.struct(F.coalesce("subscription_start_date", ctx.today()), F.col("subscription_id"))
    return subscriptions.groupBy("user_id").agg(
        F.bool_or("is_active").alias("any_active"),
        F.bool_or("is_churned").alias("any_churned"),
        F.max_by("mrr", recency).alias("current_mrr"),
        F.max("subscription_duration_days").alias("max_subscription_duration_days"),
        F.min("subscription_start_date").alias("first_subscription_start_date"),
        F.max_by(F.when(F.col("is_churned"), F.col("cancel_reason")), recency).alias("last_cancel_reason"),
    )


def fct_user_funnel(
    events: DataFrame, subscriptions: DataFrame, users: DataFrame, ctx: RunContext, *, zero_stages: bool = False
) -> DataFrame:
    """The funnel snapshot.

    Users without funnel events have a NULL stage count; ``zero_stages=True``
    gives 0 instead.
    """
    return funnel_of(user_milestones(events), user_subscription_state(subscriptions, ctx), users, zero_stages=zero_stages)


def funnel_of(reached: DataFrame, subscribed: DataFrame, users: DataFrame, *, zero_stages: bool = False) -> DataFrame:
    """The snapshot from the milestones and the subscription state of users."""
    joined = users.select(FUNNEL_COLUMNS[:8]).join(reached, "user_id", "left").join(subscribed, "user_id", "left")
    signed_up = F.coalesce("signed_up_event_date", "signed_up_at")
    stages = F.col("distinct_funnel_stages_reached")
    return joined.withColumns({
        "signed_up_date": signed_up,
        "distinct_funnel_stages_reached": F.coalesce(stages, F.lit(0)) if zero_stages else stages,
        "has_verified_email": F.col("email_verified_date").isNotNull(),
        "has_started_trial": F.col("trial_started_date").isNotNull(),
        "has_activated": F.col("activated_date").isNotNull(),
        "has_converted": F.col("converted_date").isNotNull(),
        "days_to_email_verified": F.date_diff(F.col("email_verified_date"), signed_up),
        "days_to_activation": F.date_diff(F.col("activated_date"), signed_up),
        "days_to_conversion": F.date_diff(F.col("converted_date"), signed_up),
        "has_paid_subscription": F.coalesce("any_active", F.lit(False)),
        "has_churned": F.coalesce("any_churned", F.lit(False)),
    }).select(FUNNEL_COLUMNS)
