"""The declared checks of all layers."""

from __future__ import annotations

from ledgerlight.operators.checks import (
    Check,
    accepted_values,
    email,
    expression,
    not_null,
    relationships,
    unique,
    unique_combination,
)
from ledgerlight.operators.staging import FUNNEL_STAGES

# The accepted categories.
PLAN_IDS = ["plan_starter", "plan_growth", "plan_scale", "plan_enterprise"]
COUNTRIES = ["FR", "NL", "ES", "IE", "DE", "IT", "GB", "PL"]
PAYMENT_STATES = ["succeeded", "failed", "refunded"]
COMPANY_CLASSES = ["micro", "small", "medium", "large", "unknown"]
MOVEMENTS = ["new", "expansion", "contraction", "reactivation", "retained", "churned"]

# Table -> (unique columns, not-null columns).
KEYS = {
    "raw_events": (["event_id"], ["event_id", "user_id", "event_at", "session_id"]),
    "raw_payments": (["payment_id"], ["payment_id", "subscription_id", "user_id", "plan_id"]),
    "raw_subscriptions": (["subscription_id"], ["subscription_id", "plan_id"]),
    "raw_users": (["user_id"], ["user_id", "email"]),
    "stg_events": (
        ["event_id", "sk_event_id"],
        ["event_id", "user_id", "session_id", "sk_event_id", "is_funnel_event", "is_activation_event",
         "is_conversion_event", "is_upsell_event", "is_payment_failure_event", "is_churn", "event_date"],
    ),
    "stg_payments": (
        ["payment_id", "sk_payment_id"],
        ["payment_id", "user_id", "sk_payment_id", "amount", "payment_date"],
    ),
    "stg_plans": (["plan_id", "sk_plan_id"], ["plan_id", "sk_plan_id", "monthly_price", "annual_price"]),
    "stg_subscriptions": (
        ["subscription_id", "sk_subscription_id"],
        ["subscription_id", "user_id", "sk_subscription_id"],
    ),
    "stg_users": (["sk_user_id", "user_id"], ["sk_user_id", "user_id", "email", "signed_up_at"]),
    "int_cohort_retention": ([], ["cohort_month", "months_since_cohort", "total_users", "retained_users"]),
    "dim_plans": (["sk_plan_id", "plan_id"], ["sk_plan_id", "plan_id"]),
    "dim_users": (["sk_user_id", "user_id"], ["sk_user_id", "user_id", "signed_up_at"]),
    "fct_cohort_retention": ([], ["cohort_month"]),
    "fct_events": (["sk_event_id", "event_id"], ["sk_event_id", "event_id", "event_date"]),
    "fct_mrr": (["sk_mrr_id"], ["sk_mrr_id", "mrr_month", "mrr_movement_type"]),
    "fct_payments": (["sk_payment_id", "payment_id"], ["sk_payment_id", "payment_id"]),
    "fct_subscriptions": (["sk_subscription_id", "subscription_id"], ["sk_subscription_id", "subscription_id"]),
    "fct_user_funnel": (["sk_user_id", "user_id"], ["sk_user_id", "user_id"]),
}

USER_KEY = ("sk_user_id", "dim_users", "sk_user_id")
PLAN_KEY = ("sk_plan_id", "dim_plans", "sk_plan_id")

OTHERS = [
    accepted_values("raw_subscriptions", "plan_id", PLAN_IDS),
    accepted_values("stg_events", "event_name", FUNNEL_STAGES),
    accepted_values("stg_payments", "status", PAYMENT_STATES),
    accepted_values("stg_users", "country", COUNTRIES, severity="warn"),
    accepted_values("dim_plans", "plan_id", PLAN_IDS),
    accepted_values("dim_users", "company_size", COMPANY_CLASSES, severity="warn"),
    accepted_values("fct_events", "event_name", FUNNEL_STAGES, severity="warn"),
    accepted_values("fct_mrr", "mrr_movement_type", MOVEMENTS),
    accepted_values("fct_payments", "status", PAYMENT_STATES),
    email("stg_users", "email"),
    *[relationships(table, *key) for table in ("fct_mrr", "fct_payments", "fct_subscriptions")
      for key in (USER_KEY, PLAN_KEY)],
    relationships("fct_events", *USER_KEY),
    expression("int_cohort_retention", "retention_rate", "between 0 and 1"),
    expression("dim_plans", "tier", "between 1 and 4"),
    expression("dim_plans", "monthly_price", "> 0"),
    expression("dim_plans", "annual_price", "> 0"),
    expression("fct_cohort_retention", "cohort_size", "> 0"),
    expression("fct_cohort_retention", "months_since_cohort", "between 0 and 12"),
    expression("fct_cohort_retention", "retained_users", "<= total_users"),
    expression("fct_cohort_retention", "retention_rate", "between 0 and 1"),
    expression("fct_mrr", "mrr", ">= 0"),
    expression("fct_payments", "amount", ">= 0"),
    expression("fct_subscriptions", "mrr", ">= 0"),
    *[expression("fct_user_funnel", column, ">= 0", where=f"{column} is not null")
      for column in ("days_to_email_verified", "days_to_activation", "days_to_conversion")],
    unique_combination("fct_cohort_retention", ["cohort_month", "months_since_cohort"]),
    unique_combination("fct_mrr", ["subscription_id", "mrr_month"]),
]


def declared_checks(kinds: set[str] | None = None) -> list[Check]:
    """All checks, or those of some kinds."""
    checks = [unique(table, c) for table, (columns, _) in KEYS.items() for c in columns]
    checks += [not_null(table, c) for table, (_, columns) in KEYS.items() for c in columns]
    checks += OTHERS
    return [c for c in checks if kinds is None or c.kind in kinds]
