"""Mart contracts: fixed columns and types, NOT NULL columns, one primary key.

``enforce`` settles names and types when the plan is built, before any job runs.
``violations`` counts what only the data can tell, and ``audit`` refuses rows
that break the contract. Stored tables check written rows before they publish; ``WriteAudit`` counts NULLs in the write itself.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StructType

from ledgerlight.operators import checks
from ledgerlight.operators.checks import Check
from ledgerlight.session import shuffle_files_dropped

# One line per column: name, type, and "!" where NULL is not allowed.
DIM_PLANS = """
sk_plan_id string !
plan_id string !
plan_name string !
tier integer !
max_seats integer !
features string
monthly_price decimal(10,2) !
annual_price decimal(10,2) !
annual_monthly_equivalent decimal(10,2) !
annual_discount_pct decimal(10,1)
_stg_loaded_at timestamp !
"""
DIM_USERS = """
sk_user_id string !
user_id string !
company_name string
company_size string !
company_size_order integer !
industry string !
acquisition_channel string !
country string
signed_up_at date !
signup_month string !
is_deleted integer !
_stg_loaded_at timestamp !
"""
FCT_COHORT_RETENTION = """
cohort_month string !
cohort_size long !
months_since_cohort long !
period_label string !
total_users long !
retained_users long !
retention_rate decimal(10,4) !
cohort_size_bucket string !
retention_benchmark decimal(10,2)
retention_vs_benchmark decimal(10,4)
activated_total_users long !
activated_retained_users long !
activated_retention_rate decimal(10,4)
non_activated_total_users long !
non_activated_retained_users long !
non_activated_retention_rate decimal(10,4)
activation_retention_lift decimal(10,4)
"""
FCT_EVENTS = """
sk_event_id string !
event_id string !
sk_user_id string
user_id string !
session_id string
event_name string !
funnel_stage_order integer !
is_funnel_event boolean !
is_activation_event boolean !
is_conversion_event boolean !
is_upsell_event boolean !
is_payment_failure_event boolean !
is_churn boolean !
event_source string
activation_action string
feature_used string
upgraded_from_plan string
upgraded_to_plan string
churn_reason string
raw_properties string
event_date date !
event_month string !
_stg_loaded_at timestamp !
"""
FCT_MRR = """
sk_mrr_id string !
subscription_id string !
sk_subscription_id string
user_id string !
sk_user_id string
plan_id string
sk_plan_id string
mrr_month string !
mrr decimal(10,2) !
billing_cycle string
cohort_month string
is_spike_churn boolean !
prev_mrr decimal(10,2)
mrr_movement_type string !
mrr_delta decimal(10,2) !
"""
FCT_PAYMENTS = """
sk_payment_id string !
payment_id string !
sk_user_id string
sk_plan_id string
user_id string !
plan_id string
subscription_id string
billing_cycle string
currency string
status string
is_revenue_recognised boolean !
is_failed boolean !
is_refunded boolean !
amount decimal(10,2) !
mrr_contribution decimal(10,2)
payment_date date !
payment_month string !
period_start date
period_end date
days_in_period long
_stg_loaded_at timestamp !
"""
FCT_SUBSCRIPTIONS = """
sk_subscription_id string !
subscription_id string !
sk_user_id string
sk_plan_id string
user_id string !
plan_id string
billing_cycle string
status string
cancel_reason string
cohort_month string
is_active boolean !
is_churned boolean !
is_trial_expired boolean !
is_spike_churn boolean !
mrr decimal(10,2)
trial_duration_days long
subscription_duration_days long
trial_start_date date
trial_end_date date
subscription_start_date date
subscription_end_date date
cancelled_date date
effective_end_date date !
_stg_loaded_at timestamp !
"""
FCT_USER_FUNNEL = """
sk_user_id string !
user_id string !
acquisition_channel string
company_size string
industry string
country string
signed_up_at date
signup_month string
signed_up_date date !
email_verified_date date
trial_started_date date
onboarding_step1_date date
onboarding_step2_date date
activated_date date
converted_date date
highest_funnel_stage_order integer
highest_funnel_stage_name string
distinct_funnel_stages_reached long !
has_verified_email boolean !
has_started_trial boolean !
has_activated boolean !
has_converted boolean !
days_to_email_verified integer
days_to_activation integer
days_to_conversion integer
has_paid_subscription boolean !
has_churned boolean !
current_mrr decimal(10,2)
max_subscription_duration_days long
first_subscription_start_date date
last_cancel_reason string
"""

# Column comments; a name means the same in every mart.
COMMENTS = {
    "_stg_loaded_at": "when staging took the row",
    "acquisition_channel": "marketing channel, blanks as underscores, 'unknown' if not given",
    "activated_date": "first activation, NULL if none",
    "activated_retained_users": "activated users still subscribed",
    "activated_retention_rate": "kept share of activated users, NULL without any",
    "activated_total_users": "users of the cohort who ever activated",
    "activation_action": "action in the event properties",
    "activation_retention_lift": "retention of activated minus other users",
    "amount": "amount charged, for annual billing the whole year",
    "annual_discount_pct": "what annual billing saves against twelve months, in percent",
    "annual_monthly_equivalent": "annual price per month",
    "annual_price": "list price of a year",
    "billing_cycle": "monthly or annual",
    "cancel_reason": "stated reason, 'not cancelled' if none",
    "cancelled_date": "day of cancellation",
    "churn_reason": "reason in the event properties",
    "cohort_month": "month the trial began, yyyyMM",
    "cohort_size": "users of the cohort at its start",
    "cohort_size_bucket": "size class, to compare like with like",
    "company_name": "company name in upper case",
    "company_size": "size class of the company",
    "company_size_order": "sort order of the size class, 0 for unknown",
    "converted_date": "first conversion to paid, NULL if none",
    "country": "two-letter country code",
    "currency": "currency code as charged, never converted",
    "current_mrr": "MRR of the subscription that started last",
    "days_in_period": "days the payment covers",
    "days_to_activation": "days from signup to the first activation",
    "days_to_conversion": "days from signup to the first conversion",
    "days_to_email_verified": "days from signup to the first verified email",
    "distinct_funnel_stages_reached": "number of different funnel stages",
    "effective_end_date": "end date, 2099-12-31 while open",
    "email_verified_date": "first verified email, NULL if none",
    "event_date": "day of the event",
    "event_id": "event id of the source, trimmed",
    "event_month": "month of the event, yyyyMM",
    "event_name": "event in lower case with blanks",
    "event_source": "source in the event properties",
    "feature_used": "feature in the event properties",
    "features": "features of the plan, separated by commas",
    "first_subscription_start_date": "first paid start",
    "funnel_stage_order": "stage number, 999999 if unknown",
    "has_activated": "reached activation",
    "has_churned": "any subscription was cancelled",
    "has_converted": "reached conversion",
    "has_paid_subscription": "any subscription is active",
    "has_started_trial": "reached the trial",
    "has_verified_email": "reached the verified email",
    "highest_funnel_stage_name": "event of the deepest stage",
    "highest_funnel_stage_order": "number of the deepest stage",
    "industry": "industry in lower case, 'unknown' if not given",
    "is_activation_event": "the event activates the user",
    "is_active": "status is active",
    "is_churn": "the event begins a cancellation",
    "is_churned": "status is cancelled",
    "is_conversion_event": "the event converts the user to paid",
    "is_deleted": "1 deleted, 0 not, 999999 unknown",
    "is_failed": "payment failed",
    "is_funnel_event": "the event is a step of the funnel",
    "is_payment_failure_event": "the event reports a failed payment",
    "is_refunded": "payment was refunded",
    "is_revenue_recognised": "payment succeeded; filter for revenue",
    "is_spike_churn": "cancelled inside the spike window",
    "is_trial_expired": "status is trial expired",
    "is_upsell_event": "the event upgrades the plan",
    "last_cancel_reason": "reason of the subscription that started last, if it is cancelled",
    "max_seats": "seats included",
    "max_subscription_duration_days": "days of the longest paid subscription",
    "monthly_price": "list price of a month",
    "months_since_cohort": "months from the cohort month",
    "mrr": "monthly recurring revenue",
    "mrr_contribution": "amount per month",
    "mrr_delta": "change of MRR this row books",
    "mrr_month": "month the row counts in, yyyyMM",
    "mrr_movement_type": "class of the change",
    "non_activated_retained_users": "other users still subscribed",
    "non_activated_retention_rate": "kept share of other users, NULL without any",
    "non_activated_total_users": "users of the cohort who never activated",
    "onboarding_step1_date": "first onboarding step 1, NULL if none",
    "onboarding_step2_date": "first onboarding step 2, NULL if none",
    "payment_date": "day of the payment",
    "payment_id": "payment id of the source, trimmed",
    "payment_month": "month of the payment, yyyyMM",
    "period_end": "last day the payment covers",
    "period_label": "label of the offset",
    "period_start": "first day the payment covers",
    "plan_id": "plan id of the source, trimmed",
    "plan_name": "plan name in lower case",
    "prev_mrr": "MRR of the user's row before, NULL for the first",
    "raw_properties": "all event properties as text in lower case",
    "retained_users": "users whose subscription reaches the month",
    "retention_benchmark": "expected retention at this offset",
    "retention_rate": "kept share of the cohort, 0 to 1",
    "retention_vs_benchmark": "retention minus benchmark",
    "session_id": "session id of the source, trimmed",
    "signed_up_at": "day of signup in the profile",
    "signed_up_date": "first signup event, else the day in the profile",
    "signup_month": "month of signup, yyyyMM",
    "sk_event_id": "surrogate key of the event",
    "sk_mrr_id": "surrogate key of subscription and month",
    "sk_payment_id": "surrogate key of the payment",
    "sk_plan_id": "surrogate key of the plan",
    "sk_subscription_id": "surrogate key of the subscription",
    "sk_user_id": "surrogate key of the user",
    "status": "status in lower case",
    "subscription_duration_days": "paid days so far, NULL before the start",
    "subscription_end_date": "end of the paid phase, NULL while open",
    "subscription_id": "subscription id of the source, trimmed",
    "subscription_start_date": "start of the paid phase",
    "tier": "rank of the plan, 1 lowest",
    "total_users": "users observed",
    "trial_duration_days": "days of the trial",
    "trial_end_date": "end of the trial",
    "trial_start_date": "start of the trial",
    "trial_started_date": "first started trial, NULL if none",
    "upgraded_from_plan": "old plan in the event properties",
    "upgraded_to_plan": "new plan in the event properties",
    "user_id": "user id of the source, trimmed",
}

OWNER = "analytics engineering"
REFRESH = "daily"


@dataclass(frozen=True)
class Contract:
    table: str
    schema: StructType
    primary_key: str | None
    grain: str
    owner: str = OWNER
    refresh: str = REFRESH

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _contract(table: str, columns: str, primary_key: str | None, grain: str) -> Contract:
    schema = StructType()
    for line in columns.split("\n"):
        if line:
            name, data_type, *required = line.split(" ")
            schema = schema.add(name, data_type, nullable=not required)
    return Contract(table, schema, primary_key, grain)


CONTRACTS = {
    c.table: c
    for c in [
        _contract("dim_plans", DIM_PLANS, "sk_plan_id", "plan"),
        _contract("dim_users", DIM_USERS, "sk_user_id", "user"),
        _contract("fct_cohort_retention", FCT_COHORT_RETENTION, None, "cohort month and months since"),
        _contract("fct_events", FCT_EVENTS, "sk_event_id", "event"),
        _contract("fct_mrr", FCT_MRR, "sk_mrr_id", "subscription and month"),
        _contract("fct_payments", FCT_PAYMENTS, "sk_payment_id", "payment"),
        _contract("fct_subscriptions", FCT_SUBSCRIPTIONS, "sk_subscription_id", "subscription"),
        _contract("fct_user_funnel", FCT_USER_FUNNEL, "sk_user_id", "user"),
    ]
}

# Columns with personal data per staged table; no mart holds any.
PII_COLUMNS = {"stg_users": ("email",)}


def pii_columns(table: str) -> tuple[str, ...]:
    return PII_COLUMNS.get(table, ())


class ContractBroken(Exception):
    pass


def enforce(rows: DataFrame, contract: Contract) -> DataFrame:
    """``rows`` in the contract's column order and types; missing or extra columns are an error.

    Every column carries its comment, the first one also the table facts (grain,
    owner, refresh); both are stored with the table.
    """
    expected, found = set(contract.schema.names), set(rows.columns)
    if expected != found:
        raise ContractBroken(
            f"{contract.table}: missing {sorted(expected - found)}, unexpected {sorted(found - expected)}"
        )
    facts = {"grain": contract.grain, "owner": contract.owner, "refresh": contract.refresh}
    columns = []
    for position, f in enumerate(contract.schema.fields):
        notes = {"comment": COMMENTS[f.name], **(facts if position == 0 else {})}
        columns.append(F.col(f.name).cast(f.dataType).alias(f.name, metadata=notes))
    return rows.select(columns)


def described(rows: DataFrame) -> DataFrame:
    """One row per column of a stored mart: place, name, type, comment, whether it holds personal data, and its filled rows.

    Comments and types are read off the stored table, not off the contract.
    """
    counts = rows.agg(*[F.count(F.col(f.name)).alias(f.name) for f in rows.schema])
    personal = {c for columns in PII_COLUMNS.values() for c in columns}
    facts = [
        F.struct(
            F.lit(place).alias("place"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.metadata.get("comment")).cast("string").alias("comment"),
            F.lit(f.name in personal).alias("is_personal"),
            F.col(f.name).alias("filled_rows"),
        )
        for place, f in enumerate(rows.schema.fields, 1)
    ]
    return counts.select(F.inline(F.array(*facts)))


def _rules(contract: Contract) -> list[Check]:
    rules = [checks.not_null(contract.table, c) for c in contract.required]
    return rules + ([checks.unique(contract.table, contract.primary_key)] if contract.primary_key else [])


def _report(tables: dict[str, DataFrame], contracts: list[Contract]) -> DataFrame:
    found = checks.run_checks(tables, [rule for c in contracts for rule in _rules(c)])
    rule = F.when(F.col("check_type") == "unique", "primary_key").otherwise(F.col("check_type"))
    return found.select("table_name", rule.alias("rule"), "column_name", F.col("failures").alias("violations"))


def violations(rows: DataFrame, contract: Contract) -> DataFrame:
    """One row per rule: NULLs per required column, and repeated primary keys; one scan."""
    return _report({contract.table: rows}, [contract])


def contract_report(marts: dict[str, DataFrame]) -> DataFrame:
    """The rules of several marts in one table; each mart is scanned once."""
    return _report({name: enforce(rows, CONTRACTS[name]) for name, rows in marts.items()}, [CONTRACTS[name] for name in marts])


def _raise(contract: Contract, broken: list[tuple[str, str, int]]) -> None:
    if broken:
        raise ContractBroken("; ".join(f"{contract.table}.{column} {rule}: {n}" for column, rule, n in broken))


def audit(rows: DataFrame, contract: Contract) -> None:
    """Raise if rows break the contract; the message names rule, column and count."""
    found = violations(rows, contract).where("violations > 0").collect()
    _raise(contract, [(r.column_name, r.rule, r.violations) for r in found])


class WriteAudit:
    """An audit whose NULLs are counted by the job that writes the rows; only keys are looked at afterwards.

    Good for one write, or all parts of one. The counts tell none from some; a task that ran twice may count its rows twice.
    """

    def __init__(self, contract: Contract) -> None:
        self.contract = contract
        self.observed: list[Observation] = []

    def watched(self, rows: DataFrame) -> DataFrame:
        self.observed.append(Observation())
        return rows.observe(self.observed[-1], *self._nulls())

    def _nulls(self) -> list[Column]:
        return [F.count_if(F.col(c).isNull()).alias(c) for c in self.contract.required]

    def check(self, written: DataFrame, unique: str | None = None) -> None:
        """Raise if the written rows break the contract; the key ``unique`` is known to have no repeats."""
        try:
            nulls = sum((Counter(o.get) for o in self.observed), Counter())
        except Py4JJavaError:  # rows that are known to be none are not run, and so not counted
            nulls = written.agg(*self._nulls()).first().asDict()
        broken = [(c, "not_null", nulls[c]) for c in self.contract.required if nulls.get(c)]
        key = self.contract.primary_key
        if key is not None and key != unique:
            with shuffle_files_dropped(written.sparkSession):
                (found,) = checks.run_checks({self.contract.table: written}, [checks.unique(self.contract.table, key)]).collect()
            broken += [(key, "primary_key", found.failures)] if found.failures else []
        _raise(self.contract, broken)
