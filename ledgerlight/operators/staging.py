"""Staging: one cleaner per raw table. Projection and filter only, never a shuffle.

Each cleaner drops rows whose id is NULL (an empty id stays), types every
column and derives the flags the marts need. With ``lenient=True`` a value that
cannot be cast becomes NULL instead of ending the job; ``rejected_rows`` lists
the rows concerned.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.context import RunContext
from ledgerlight.functions.dates import days_from, yyyymm
from ledgerlight.functions.keys import surrogate_key
from ledgerlight.functions.text import lowered, spaced, trimmed, underscored, uppered

# Stage numbers, sentinels and default texts that stored results rely on.
FUNNEL_STAGES = {
    "signed up": 1,
    "email verified": 2,
    "trial started": 3,
    "onboarding step1": 4,
    "onboarding step2": 5,
    "activated": 6,
    "feature core used": 7,
    "feature advanced used": 8,
    "invited team member": 9,
    "converted paid": 10,
    "upgraded plan": 11,
    "payment failed": 12,
    "cancellation initiated": 13,
}
# Inviting a team member has a stage number but is no step of the funnel.
FUNNEL_EVENTS = [name for name, stage in FUNNEL_STAGES.items() if stage <= 10 and stage != 9]
UNKNOWN_CODE = 999999
OPEN_END = date(2099, 12, 31)
NOT_CANCELLED = "not cancelled"
UNKNOWN = "unknown"
COMPANY_SIZES = {"1-5": ("micro", 1), "6-20": ("small", 2), "21-50": ("medium", 3), "51-200": ("large", 4)}
JSON_FIELDS = {
    "event_source": "source",
    "activation_action": "action",
    "feature_used": "feature",
    "upgraded_from_plan": "from_plan",
    "upgraded_to_plan": "to_plan",
    "churn_reason": "reason",
}
MONEY = "decimal(10,2)"

# Casts each cleaner makes on raw columns, for the rejected-row report.
RAW_CASTS = {
    "events": {"event_at": "date"},
    "payments": {"amount": MONEY, "payment_date": "date", "period_start": "date", "period_end": "date"},
    "plans": {"monthly_price": MONEY, "annual_price": MONEY, "tier": "int", "max_seats": "int"},
    "subscriptions": {
        "mrr": MONEY,
        "trial_start": "date",
        "trial_end": "date",
        "subscription_start": "date",
        "subscription_end": "date",
        "cancelled_at": "date",
    },
    "users": {"created_at": "date"},
}


def _caster(lenient: bool) -> Callable[[str, str], Column]:
    def cast(name: str, to: str) -> Column:
        return F.col(name).try_cast(to) if lenient else F.col(name).cast(to)

    return cast


def rejected_rows(raw: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Raw rows with a value that does not fit its type, with the columns at fault."""
    bad = F.array_compact(
        F.array(*[F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in casts.items()])
    )
    return raw.withColumn("rejected_columns", bad).where(F.size("rejected_columns") > 0)


def stg_events(
    raw: DataFrame, *, lenient: bool = False, keep_event_time: bool = False, single_pass_json: bool = True
) -> DataFrame:
    """Clean events: name, stage, flags, JSON properties, date.

    ``single_pass_json`` parses each JSON text once instead of once per field. If a
    text may repeat a key (it holds a quoted field name twice, or an escape), its
    fields are read one by one all the same, as there the first occurrence counts.
    """
    cast = _caster(lenient)
    name = spaced("event_name")
    stage_of = F.create_map(*[F.lit(x) for pair in FUNNEL_STAGES.items() for x in pair])
    day = cast("event_at", "date")
    rows = raw.where(trimmed("event_id").isNotNull())
    if single_pass_json:
        fields = F.json_tuple(F.col("properties").cast("string"), *JSON_FIELDS.values()).alias(*JSON_FIELDS)
        rows = rows.select("*", fields)
        text = F.col("properties").cast("string")
        once = F.lit(True)
        for field in JSON_FIELDS.values():
            quoted = f'"{field}"'
            once &= F.length(text) - F.length(F.replace(text, F.lit(quoted))) <= len(quoted)
        once &= ~text.contains("\\")
        properties = [
            F.when(once, F.col(target)).otherwise(F.get_json_object(text, f"$.{field}")).alias(target)
            for target, field in JSON_FIELDS.items()
        ]
    else:
        properties = [
            F.get_json_object(F.col("properties").cast("string"), f"$.{field}").alias(target)
            for target, field in JSON_FIELDS.items()
        ]
    return rows.select(
        surrogate_key("event_id").alias("sk_event_id"),
        trimmed("event_id").alias("event_id"),
        trimmed("user_id").alias("user_id"),
        trimmed("session_id").alias("session_id"),
        name.alias("event_name"),
        F.coalesce(stage_of[name], F.lit(UNKNOWN_CODE)).alias("funnel_stage_order"),
        day.alias("event_date"),
        yyyymm(day).alias("event_month"),
        (name == "activated").alias("is_activation_event"),
        (name == "converted paid").alias("is_conversion_event"),
        (name == "upgraded plan").alias("is_upsell_event"),
        (name == "payment failed").alias("is_payment_failure_event"),
        (name == "cancellation initiated").alias("is_churn"),
        name.isin(FUNNEL_EVENTS).alias("is_funnel_event"),
        lowered("properties").alias("raw_properties"),
        *properties,
        F.current_timestamp().alias("_stg_loaded_at"),
        *([cast("event_at", "timestamp").alias("event_ts")] if keep_event_time else []),
    )


def stg_payments(raw: DataFrame, *, lenient: bool = False) -> DataFrame:
    """Clean payments; annual amounts also as their monthly share."""
    cast = _caster(lenient)
    status, cycle, amount = lowered("status"), lowered("billing_cycle"), cast("amount", MONEY)
    paid_on, start, end = (cast(c, "date") for c in ("payment_date", "period_start", "period_end"))
    return raw.where(trimmed("payment_id").isNotNull()).select(
        surrogate_key("payment_id").alias("sk_payment_id"),
        trimmed("payment_id").alias("payment_id"),
        trimmed("subscription_id").alias("subscription_id"),
        trimmed("user_id").alias("user_id"),
        trimmed("plan_id").alias("plan_id"),
        cycle.alias("billing_cycle"),
        uppered("currency").alias("currency"),
        status.alias("status"),
        (status == "succeeded").alias("is_revenue_recognised"),
        (status == "failed").alias("is_failed"),
        (status == "refunded").alias("is_refunded"),
        amount.alias("amount"),
        F.when(cycle == "annual", F.round(amount / 12, 2)).otherwise(amount).cast(MONEY).alias("mrr_contribution"),
        paid_on.alias("payment_date"),
        yyyymm(paid_on).alias("payment_month"),
        start.alias("period_start"),
        end.alias("period_end"),
        days_from(start, end).alias("days_in_period"),
        F.current_timestamp().alias("_stg_loaded_at"),
    )


def stg_plans(raw: DataFrame, *, lenient: bool = False) -> DataFrame:
    cast = _caster(lenient)
    return raw.where(trimmed("plan_id").isNotNull()).select(
        surrogate_key("plan_id").alias("sk_plan_id"),
        trimmed("plan_id").alias("plan_id"),
        lowered("plan_name").alias("plan_name"),
        *[cast(c, t).alias(c) for c, t in RAW_CASTS["plans"].items()],
        lowered("features").alias("features"),
        F.current_timestamp().alias("_stg_loaded_at"),
    )


def stg_subscriptions(
    raw: DataFrame, ctx: RunContext, *, lenient: bool = False, spaced_status: bool = False
) -> DataFrame:
    """Clean subscriptions: status flags, cohort month, open end date, durations.

    By default a status such as ``trial_expired`` keeps its underscore and so
    matches no flag; ``spaced_status=True`` turns underscores into blanks first.
    """
    cast = _caster(lenient)
    status = spaced("status") if spaced_status else lowered("status")
    cycle = spaced("billing_cycle") if spaced_status else lowered("billing_cycle")
    churned = status == "cancelled"
    trial_start, trial_end, start, end, cancelled = (
        cast(c, "date")
        for c in ("trial_start", "trial_end", "subscription_start", "subscription_end", "cancelled_at")
    )
    in_spike = (cancelled >= F.lit(ctx.spike_start)) & (cancelled < F.lit(ctx.spike_end))
    return raw.where(trimmed("subscription_id").isNotNull()).select(
        surrogate_key("subscription_id").alias("sk_subscription_id"),
        trimmed("subscription_id").alias("subscription_id"),
        trimmed("user_id").alias("user_id"),
        trimmed("plan_id").alias("plan_id"),
        cycle.alias("billing_cycle"),
        status.alias("status"),
        F.coalesce(spaced("cancel_reason"), F.lit(NOT_CANCELLED)).alias("cancel_reason"),
        (status == "active").alias("is_active"),
        churned.alias("is_churned"),
        (status == "trial expired").alias("is_trial_expired"),
        (churned & in_spike).alias("is_spike_churn"),
        cast("mrr", MONEY).alias("mrr"),
        trial_start.alias("trial_start_date"),
        yyyymm(trial_start).alias("cohort_month"),
        trial_end.alias("trial_end_date"),
        start.alias("subscription_start_date"),
        end.alias("subscription_end_date"),
        cancelled.alias("cancelled_date"),
        F.coalesce(end, F.lit(OPEN_END)).alias("effective_end_date"),
        days_from(trial_start, F.coalesce(trial_end, ctx.today())).alias("trial_duration_days"),
        days_from(start, F.coalesce(end, ctx.today())).alias("subscription_duration_days"),
        F.current_timestamp().alias("_stg_loaded_at"),
    )


def stg_users(raw: DataFrame, *, lenient: bool = False) -> DataFrame:
    """Clean users: case, defaults, size bucket, three-state delete flag."""
    cast = _caster(lenient)
    size, deleted, signed_up = trimmed("company_size"), lowered("is_deleted"), cast("created_at", "date")
    bucket, bucket_order = F.lit(UNKNOWN), F.lit(0)
    for raw_size, (label, position) in COMPANY_SIZES.items():
        bucket = F.when(size == raw_size, label).otherwise(bucket)
        bucket_order = F.when(size == raw_size, position).otherwise(bucket_order)
    return raw.where(trimmed("user_id").isNotNull()).select(
        surrogate_key("user_id").alias("sk_user_id"),
        trimmed("user_id").alias("user_id"),
        uppered("company_name").alias("company_name"),
        lowered("email").alias("email"),
        uppered("country").alias("country"),
        F.coalesce(lowered("industry"), F.lit(UNKNOWN)).alias("industry"),
        F.coalesce(underscored("acquisition_channel"), F.lit(UNKNOWN)).alias("acquisition_channel"),
        size.alias("company_size_raw"),
        bucket.alias("company_size"),
        bucket_order.alias("company_size_order"),
        signed_up.alias("signed_up_at"),
        yyyymm(signed_up).alias("signup_month"),
        F.when(deleted == "true", 1).when(deleted == "false", 0).otherwise(UNKNOWN_CODE).alias("is_deleted"),
        F.current_timestamp().alias("_stg_loaded_at"),
    )
