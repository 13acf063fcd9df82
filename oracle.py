"""The same results in DuckDB SQL, written from the definitions and not from the Spark plans.

Calendars are joined by range, distinct users are counted directly and totals
are plain windows: the straightforward form, to compare the tuned jobs with.
"""

from __future__ import annotations

import re

from ledgerlight.operators.checks import ROW_KINDS, Check
from ledgerlight.operators.contracts import CONTRACTS
from ledgerlight.plans.check_list import declared_checks
from ledgerlight.plans.registry import EVENTS_LOADED, LATE_CONTEXT, PAYMENTS_LOADED
from ledgerlight.sources.sample_feed import SAMPLE_CONTEXT
from ledgerlight.sources.schemas import PLAN_SEED

# Written out here and not taken from the package: a wrong value there shows as a difference.
EVENT_NAMES = {
    "signup": (("signed_up", 1), ("email_verified", 2), ("trial_started", 3)),
    "view": (("onboarding_step1", 4), ("onboarding_step2", 5), ("Feature_core_used", 7)),
    "click": (("activated", 6), ("feature_advanced_used", 8), ("invited_team_member", 9)),
    "purchase": (("converted_paid", 10), ("upgraded_plan", 11), (" Converted_paid", 10)),
    "error": (("payment_failed", 12), ("cancellation_initiated", 13), ("unknown_evt", 14)),
}
STAGE_EVENTS = (
    "signed_up", "email_verified", "trial_started", "onboarding_step1", "onboarding_step2", "activated", "Feature_core_used",
    "feature_advanced_used", "invited_team_member", "converted_paid", "upgraded_plan", "payment_failed",
    "cancellation_initiated", "unknown_evt",
)
FUNNEL_STAGES = {
    "signed up": 1, "email verified": 2, "trial started": 3, "onboarding step1": 4, "onboarding step2": 5, "activated": 6,
    "feature core used": 7, "feature advanced used": 8, "invited team member": 9, "converted paid": 10, "upgraded plan": 11,
    "payment failed": 12, "cancellation initiated": 13,
}
FUNNEL_EVENTS = [
    "signed up", "email verified", "trial started", "onboarding step1", "onboarding step2", "activated", "feature core used",
    "feature advanced used", "converted paid",
]
COMPANY_SIZES = {"1-5": ("micro", 1), "6-20": ("small", 2), "21-50": ("medium", 3), "51-200": ("large", 4)}
JSON_FIELDS = {
    "event_source": "source", "activation_action": "action", "feature_used": "feature", "upgraded_from_plan": "from_plan",
    "upgraded_to_plan": "to_plan", "churn_reason": "reason",
}
# Name, type, comment, and what to count for the filled rows (a load timestamp is never NULL), in the stored order.
USER_COLUMNS = (
    ("sk_user_id", "string", "surrogate key of the user", "sk_user_id"),
    ("user_id", "string", "user id of the source, trimmed", "user_id"),
    ("company_name", "string", "company name in upper case", "company_name"),
    ("company_size", "string", "size class of the company", "company_size"),
    ("company_size_order", "int", "sort order of the size class, 0 for unknown", "company_size_order"),
    ("industry", "string", "industry in lower case, 'unknown' if not given", "industry"),
    ("acquisition_channel", "string", "marketing channel, blanks as underscores, 'unknown' if not given", "acquisition_channel"),
    ("country", "string", "two-letter country code", "country"),
    ("signed_up_at", "date", "day of signup in the profile", "signed_up_at"),
    ("is_deleted", "int", "1 deleted, 0 not, 999999 unknown", "is_deleted"),
    ("_stg_loaded_at", "timestamp", "when staging took the row", "*"),
    ("signup_month", "string", "month of signup, yyyyMM", "signup_month"),
)
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def _day(value) -> str:
    return f"DATE '{value}'"


def _key(*parts: str) -> str:
    texts = [f"coalesce(CAST({p} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for p in parts]
    return "md5(" + " || '-' || ".join(texts) + ")"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _event_case(position: int) -> str:
    arms = [
        f"WHEN event_type = '{kind}' AND k % 3 = {i} THEN {choice[position]!r}"
        for kind, choices in EVENT_NAMES.items()
        for i, choice in enumerate(choices)
    ]
    return f"CASE {' '.join(arms)} END"


def _ctes(ctx) -> dict[str, str]:
    as_of, first = _day(ctx.as_of), _day(ctx.reporting_start)
    stage = " ".join(f"WHEN '{name}' THEN {order}" for name, order in FUNNEL_STAGES.items())
    size = " ".join(f"WHEN '{raw}' THEN '{label}'" for raw, (label, _) in COMPANY_SIZES.items())
    size_order = " ".join(f"WHEN '{raw}' THEN {order}" for raw, (_, order) in COMPANY_SIZES.items())
    json = ", ".join(f"json_extract_string(properties, '$.{field}') AS {column}" for column, field in JSON_FIELDS.items())
    return {
        "raw_users": """
            SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS company_name,
                   'User' || c_custkey || CASE WHEN c_custkey % 50 = 0 THEN '#bad' ELSE '@example.com' END AS email,
                   ['fr','nl','es','ie','de','it','gb','pl'][c_nationkey % 8 + 1] AS country,
                   c_mktsegment AS industry,
                   ['1-5','6-20','21-50','51-200','500+'][c_custkey % 5 + 1] AS company_size,
                   ['Organic Search','paid ads','referral',NULL][c_nationkey % 4 + 1] AS acquisition_channel,
                   DATE '2023-12-01' AS created_at,
                   CASE WHEN c_custkey % 97 = 0 THEN 'n/a' WHEN c_custkey % 10 = 0 THEN 'True' ELSE 'false' END AS is_deleted
            FROM customer""",
        # MRR in whole cents: a binary double would round 69.195 down.
        "raw_subscriptions": """
            SELECT CAST(o_orderkey AS VARCHAR) AS subscription_id, CAST(o_custkey AS VARCHAR) AS user_id,
                   ['plan_starter','plan_growth','plan_scale','plan_enterprise'][o_orderkey % 4 + 1] AS plan_id,
                   CASE WHEN o_orderkey % 3 = 0 THEN 'Annual' ELSE ' monthly ' END AS billing_cycle,
                   CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'cancelled' ELSE 'trial expired' END AS status,
                   CAST(o_orderdate AS DATE) - 14 AS trial_start,
                   CAST(o_orderdate AS DATE) AS trial_end,
                   CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS subscription_start,
                   CASE WHEN o_orderstatus = 'F'
                        THEN CAST(CAST(o_orderdate AS DATE) + to_months(CAST(1 + o_orderkey % 18 AS INTEGER)) AS DATE)
                   END AS subscription_end,
                   subscription_end AS cancelled_at,
                   CASE WHEN o_orderstatus = 'F' THEN
                        ['pricing_change','too_expensive','missing_features','switched_tool','other']
                        [CAST(left(o_orderpriority, 1) AS INTEGER)] END AS cancel_reason,
                   CAST((CAST(round(o_totalprice * 100) AS BIGINT) + 500) // 1000 AS DECIMAL(12,0)) / 100 AS mrr_exact,
                   CAST(mrr_exact AS DECIMAL(10,2)) AS mrr
            FROM orders""",
        "raw_payments": """
            SELECT CAST(o_orderkey AS VARCHAR) AS payment_id, CAST(o_orderkey AS VARCHAR) AS subscription_id,
                   CAST(o_custkey AS VARCHAR) AS user_id,
                   ['plan_starter','plan_growth','plan_scale','plan_enterprise'][o_orderkey % 4 + 1] AS plan_id,
                   CASE WHEN o_orderkey % 3 = 0 THEN 'Annual' ELSE ' monthly ' END AS billing_cycle,
                   CAST(o_totalprice AS DECIMAL(10,2)) AS amount, 'gbp' AS currency,
                   CASE o_orderstatus WHEN 'O' THEN 'Succeeded' WHEN 'F' THEN 'failed' ELSE 'refunded' END AS status,
                   CAST(o_orderdate AS DATE) AS payment_date, CAST(o_orderdate AS DATE) AS period_start,
                   CAST(CAST(o_orderdate AS DATE)
                        + to_months(CASE WHEN o_orderkey % 3 = 0 THEN 12 ELSE 1 END) AS DATE) AS period_end
            FROM orders""",
        "raw_events": f"""
            SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
                   CASE WHEN {_event_case(1)} <= 2 + user_id % 13 THEN {_event_case(0)}
                        ELSE [{_quoted(STAGE_EVENTS)}][({_event_case(1)} - 1) % (2 + user_id % 13) + 1] END AS event_name,
                   ts AS event_at,
                   '{{"source":"web","action":"a' || k % 4 || '","feature":"f' || k % 5 || '","reason":"r' || k % 3 || '"}}'
                       AS properties,
                   user_id || '-' || CAST(ts AS DATE) AS session_id
            FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
        "raw_plans": "SELECT * FROM (VALUES " + ", ".join(
            f"('{p}', '{n}', CAST({m} AS DECIMAL(10,2)), CAST({a} AS DECIMAL(10,2)), {t}, {s}, '{f}')"
            for p, n, m, a, t, s, f in PLAN_SEED
        ) + ") AS seed(plan_id, plan_name, monthly_price, annual_price, tier, max_seats, features)",
        "stg_events": f"""
            SELECT {_key('event_id')} AS sk_event_id, trim(event_id) AS event_id, trim(user_id) AS user_id,
                   trim(session_id) AS session_id, lower(trim(replace(event_name, '_', ' '))) AS event_name,
                   CASE lower(trim(replace(event_name, '_', ' '))) {stage} ELSE 999999 END AS funnel_stage_order,
                   CAST(event_at AS DATE) AS event_date, strftime(event_at, '%Y%m') AS event_month,
                   funnel_stage_order = 6 AS is_activation_event, funnel_stage_order = 10 AS is_conversion_event,
                   funnel_stage_order = 11 AS is_upsell_event, funnel_stage_order = 12 AS is_payment_failure_event,
                   funnel_stage_order = 13 AS is_churn,
                   funnel_stage_order <= 10 AND funnel_stage_order <> 9 AS is_funnel_event,
                   lower(trim(properties)) AS raw_properties, {json}, event_at AS event_ts
            FROM raw_events WHERE trim(event_id) IS NOT NULL""",
        "stg_payments": f"""
            SELECT {_key('payment_id')} AS sk_payment_id, trim(payment_id) AS payment_id,
                   trim(subscription_id) AS subscription_id, trim(user_id) AS user_id, trim(plan_id) AS plan_id,
                   lower(trim(r.billing_cycle)) AS billing_cycle, upper(trim(r.currency)) AS currency,
                   lower(trim(r.status)) AS status, lower(trim(r.status)) = 'succeeded' AS is_revenue_recognised,
                   lower(trim(r.status)) = 'failed' AS is_failed, lower(trim(r.status)) = 'refunded' AS is_refunded,
                   amount,
                   CASE WHEN lower(trim(r.billing_cycle)) = 'annual'
                        THEN (CAST(amount * 100 AS BIGINT) * 2 + 12) // 24 / 100.0 ELSE CAST(amount AS DOUBLE)
                   END AS mrr_contribution,
                   payment_date, strftime(payment_date, '%Y%m') AS payment_month, period_start, period_end,
                   CAST(period_end - period_start AS BIGINT) AS days_in_period
            FROM raw_payments AS r WHERE trim(payment_id) IS NOT NULL""",
        "stg_plans": f"""
            SELECT {_key('plan_id')} AS sk_plan_id, plan_id, lower(plan_name) AS plan_name, monthly_price,
                   annual_price, tier, max_seats, lower(features) AS features
            FROM raw_plans""",
        "stg_subscriptions": f"""
            SELECT {_key('subscription_id')} AS sk_subscription_id, trim(subscription_id) AS subscription_id,
                   trim(user_id) AS user_id, trim(plan_id) AS plan_id, lower(trim(r.billing_cycle)) AS billing_cycle,
                   lower(trim(r.status)) AS status,
                   coalesce(lower(trim(replace(r.cancel_reason, '_', ' '))), 'not cancelled') AS cancel_reason,
                   lower(trim(r.status)) = 'active' AS is_active, lower(trim(r.status)) = 'cancelled' AS is_churned,
                   lower(trim(r.status)) = 'trial expired' AS is_trial_expired,
                   lower(trim(r.status)) = 'cancelled' AND cancelled_at >= {_day(ctx.spike_start)}
                       AND cancelled_at < {_day(ctx.spike_end)} AS is_spike_churn,
                   mrr, trial_start AS trial_start_date, strftime(trial_start, '%Y%m') AS cohort_month,
                   trial_end AS trial_end_date, subscription_start AS subscription_start_date,
                   subscription_end AS subscription_end_date, cancelled_at AS cancelled_date,
                   coalesce(subscription_end, DATE '2099-12-31') AS effective_end_date,
                   CAST(coalesce(trial_end, {as_of}) - trial_start AS BIGINT) AS trial_duration_days,
                   CAST(coalesce(subscription_end, {as_of}) - subscription_start AS BIGINT) AS subscription_duration_days
            FROM raw_subscriptions AS r WHERE trim(subscription_id) IS NOT NULL""",
        "stg_users": f"""
            SELECT {_key('user_id')} AS sk_user_id, trim(user_id) AS user_id, upper(trim(r.company_name)) AS company_name,
                   lower(trim(r.email)) AS email, upper(trim(r.country)) AS country,
                   coalesce(lower(trim(r.industry)), 'unknown') AS industry,
                   coalesce(lower(trim(replace(r.acquisition_channel, ' ', '_'))), 'unknown') AS acquisition_channel,
                   trim(r.company_size) AS company_size_raw,
                   CASE trim(r.company_size) {size} ELSE 'unknown' END AS company_size,
                   CASE trim(r.company_size) {size_order} ELSE 0 END AS company_size_order,
                   created_at AS signed_up_at, strftime(created_at, '%Y%m') AS signup_month,
                   CASE lower(trim(r.is_deleted)) WHEN 'true' THEN 1 WHEN 'false' THEN 0 ELSE 999999 END AS is_deleted
            FROM raw_users AS r WHERE trim(user_id) IS NOT NULL""",
        "dim_users": "SELECT * EXCLUDE (email, company_size_raw) FROM stg_users",
        "dim_plans": """
            SELECT *, CAST(round(annual_price / 12, 2) AS DECIMAL(10,2)) AS annual_monthly_equivalent,
                   CAST(round(100 - 100.0 * annual_price / (12 * monthly_price), 1) AS DECIMAL(10,1)) AS annual_discount_pct
            FROM stg_plans""",
        "fct_events": "SELECT e.* EXCLUDE (event_ts), u.sk_user_id FROM stg_events AS e LEFT JOIN dim_users AS u USING (user_id)",
        "fct_payments": """
            SELECT p.*, u.sk_user_id, d.sk_plan_id FROM stg_payments AS p
            LEFT JOIN dim_users AS u USING (user_id) LEFT JOIN dim_plans AS d USING (plan_id)""",
        "fct_subscriptions": """
            SELECT s.*, u.sk_user_id, d.sk_plan_id FROM stg_subscriptions AS s
            LEFT JOIN dim_users AS u USING (user_id) LEFT JOIN dim_plans AS d USING (plan_id)""",
        "calendar": f"""
            SELECT CAST(month_start AS DATE) AS month_start, strftime(month_start, '%Y%m') AS mrr_month
            FROM generate_series({first}, date_trunc('month', {as_of}), INTERVAL 1 MONTH) AS t(month_start)""",
        "month_rows": f"""
            SELECT s.*, c.month_start, c.mrr_month,
                   lag(mrr) OVER by_user AS prev_mrr, lag(c.month_start) OVER by_user AS prev_start
            FROM fct_subscriptions AS s JOIN calendar AS c
              ON c.mrr_month BETWEEN strftime(s.subscription_start_date, '%Y%m')
                                 AND strftime(coalesce(s.subscription_end_date, {as_of}), '%Y%m')
            WHERE s.subscription_start_date IS NOT NULL
            WINDOW by_user AS (PARTITION BY user_id ORDER BY c.mrr_month, subscription_start_date, subscription_id)""",
        "fct_mrr": f"""
            SELECT {_key('subscription_id', 'mrr_month')} AS sk_mrr_id, subscription_id, sk_subscription_id, user_id,
                   sk_user_id, plan_id, sk_plan_id, mrr_month, cohort_month, billing_cycle,
                   CASE WHEN prev_start IS NULL THEN 'new'
                        WHEN date_diff('month', prev_start, month_start) > 1 THEN 'reactivation'
                        WHEN mrr > prev_mrr THEN 'expansion' WHEN mrr < prev_mrr THEN 'contraction'
                        ELSE 'retained' END AS mrr_movement_type,
                   is_spike_churn, mrr, prev_mrr, mrr - coalesce(prev_mrr, 0) AS mrr_delta
            FROM month_rows
            UNION ALL
            SELECT {_key('subscription_id', 'after_end')}, subscription_id, sk_subscription_id, user_id, sk_user_id,
                   plan_id, sk_plan_id, after_end, cohort_month, billing_cycle, 'churned', is_spike_churn, mrr, mrr, -mrr
            FROM (SELECT *, strftime(coalesce(subscription_end_date, cancelled_date) + to_months(1), '%Y%m') AS after_end
                  FROM fct_subscriptions)
            WHERE is_churned AND subscription_start_date IS NOT NULL AND after_end IS NOT NULL""",
        "live": "SELECT * FROM fct_mrr WHERE mrr_movement_type <> 'churned'",
        "activated": "SELECT DISTINCT user_id FROM stg_events WHERE is_activation_event",
        "cohort_rows": f"""
            SELECT s.*, strptime(cohort_month || '01', '%Y%m%d') AS born,
                   date_diff('month', strptime(cohort_month || '01', '%Y%m%d'), date_trunc('month', {as_of})) AS age,
                   user_id IN (SELECT user_id FROM activated) AS has_activated
            FROM stg_subscriptions AS s""",
        "int_cohort_retention": _retention_sql(
            "SELECT *, age AS months_since_cohort FROM cohort_rows WHERE is_active AND age <= 12"
        ),
        "triangle": _retention_sql("""
            SELECT c.*, o.months_since_cohort
            FROM cohort_rows AS c
            JOIN (SELECT CAST(n AS BIGINT) AS months_since_cohort FROM range(13) AS t(n)) AS o
              ON o.months_since_cohort <= c.age
            WHERE subscription_start_date IS NOT NULL"""),
        "fct_cohort_retention": _benchmarked("int_cohort_retention"),
        "fct_cohort_triangle": _benchmarked("triangle"),
        "milestones": "SELECT user_id, " + ", ".join(
            f"min(event_date) FILTER (WHERE event_name = '{name}') AS first_{FUNNEL_STAGES[name]}" for name in FUNNEL_EVENTS
        ) + """, max(funnel_stage_order) AS deepest, arg_max(event_name, funnel_stage_order) AS deepest_name,
                count(DISTINCT event_name) AS stages
            FROM stg_events WHERE is_funnel_event GROUP BY user_id""",
        "ranked_subscriptions": f"""
            SELECT *, row_number() OVER (PARTITION BY user_id
                   ORDER BY coalesce(subscription_start_date, {as_of}) DESC, subscription_id DESC) AS recency
            FROM stg_subscriptions""",
        "subscription_state": """
            SELECT user_id, bool_or(is_active) AS any_active, bool_or(is_churned) AS any_churned,
                   max(mrr) FILTER (WHERE recency = 1) AS current_mrr,
                   max(subscription_duration_days) AS longest, min(subscription_start_date) AS first_start,
                   max(cancel_reason) FILTER (WHERE recency = 1 AND is_churned) AS last_reason
            FROM ranked_subscriptions GROUP BY user_id""",
        "fct_user_funnel": """
            SELECT u.sk_user_id, u.user_id, u.acquisition_channel, u.company_size, u.industry, u.country,
                   u.signed_up_at, u.signup_month, m.first_2 AS email_verified_date, m.first_3 AS trial_started_date,
                   m.first_4 AS onboarding_step1_date, m.first_5 AS onboarding_step2_date, m.first_6 AS activated_date,
                   m.first_10 AS converted_date, m.deepest AS highest_funnel_stage_order,
                   m.deepest_name AS highest_funnel_stage_name, m.stages AS distinct_funnel_stages_reached,
                   s.current_mrr, s.longest AS max_subscription_duration_days,
                   s.first_start AS first_subscription_start_date, s.last_reason AS last_cancel_reason,
                   coalesce(m.first_1, u.signed_up_at) AS signed_up_date,
                   m.first_2 IS NOT NULL AS has_verified_email, m.first_3 IS NOT NULL AS has_started_trial,
                   m.first_6 IS NOT NULL AS has_activated, m.first_10 IS NOT NULL AS has_converted,
                   CAST(m.first_2 - coalesce(m.first_1, u.signed_up_at) AS INTEGER) AS days_to_email_verified,
                   CAST(m.first_6 - coalesce(m.first_1, u.signed_up_at) AS INTEGER) AS days_to_activation,
                   CAST(m.first_10 - coalesce(m.first_1, u.signed_up_at) AS INTEGER) AS days_to_conversion,
                   coalesce(s.any_active, false) AS has_paid_subscription, coalesce(s.any_churned, false) AS has_churned
            FROM dim_users AS u LEFT JOIN milestones AS m USING (user_id) LEFT JOIN subscription_state AS s USING (user_id)""",
        "monthly": """
            SELECT mrr_month, strptime(mrr_month || '01', '%Y%m%d') AS month_start,
                   coalesce(sum(mrr) FILTER (WHERE mrr_movement_type <> 'churned'), 0) AS active_mrr,
                   abs(coalesce(sum(mrr_delta) FILTER (WHERE mrr_movement_type = 'churned'), 0)) AS churned_mrr,
                   coalesce(sum(mrr_delta) FILTER (WHERE mrr_movement_type = 'new'), 0) AS new_mrr,
                   coalesce(sum(mrr_delta) FILTER (WHERE mrr_movement_type = 'expansion'), 0) AS expansion_mrr,
                   coalesce(sum(mrr_delta) FILTER (WHERE mrr_movement_type = 'contraction'), 0) AS contraction_mrr
            FROM fct_mrr GROUP BY mrr_month""",
        "live_totals": """
            SELECT mrr_month, strptime(mrr_month || '01', '%Y%m%d') AS month_start, sum(mrr) AS total
            FROM live GROUP BY mrr_month""",
    }


def _retention_sql(rows: str) -> str:
    still = "effective_end_date >= born + to_months(CAST(months_since_cohort AS INTEGER))"

    def users(condition: str) -> str:
        return f"count(DISTINCT user_id) FILTER (WHERE {condition})"

    def rate(kept: str, total: str) -> str:
        return f"round({kept} / nullif({total}, 0), 4)"

    return f"""
        SELECT *, {rate('retained_users', 'total_users')} AS retention_rate,
               {rate('activated_retained_users', 'activated_total_users')} AS activated_retention_rate,
               {rate('non_activated_retained_users', 'non_activated_total_users')} AS non_activated_retention_rate
        FROM (
            SELECT cohort_month, months_since_cohort, count(DISTINCT user_id) AS total_users,
                   {users(still)} AS retained_users, {users('has_activated')} AS activated_total_users,
                   {users('has_activated AND ' + still)} AS activated_retained_users,
                   {users('NOT has_activated')} AS non_activated_total_users,
                   {users('NOT has_activated AND ' + still)} AS non_activated_retained_users
            FROM ({rows}) GROUP BY cohort_month, months_since_cohort)"""


def _benchmarked(source: str) -> str:
    return f"""
        SELECT r.*, total_users AS cohort_size,
               round(activated_retention_rate - non_activated_retention_rate, 4) AS activation_retention_lift,
               CASE months_since_cohort WHEN 0 THEN 'Month 0 (start)' ELSE 'Month ' || months_since_cohort END AS period_label,
               CASE WHEN total_users >= 200 THEN 'large (200+)' WHEN total_users >= 50 THEN 'medium (50–199)'
                    WHEN total_users >= 10 THEN 'small (10–49)' ELSE 'xs (< 10)' END AS cohort_size_bucket,
               b.benchmark AS retention_benchmark, round(retention_rate - b.benchmark, 4) AS retention_vs_benchmark
        FROM {source} AS r LEFT JOIN
             (VALUES (0, 0, 1.0::DOUBLE), (1, 3, 0.7), (4, 6, 0.5), (7, 12, 0.4)) AS b(low, high, benchmark)
          ON months_since_cohort BETWEEN b.low AND b.high"""


def _with(ctes: dict[str, str], final: str, materialized: bool = False) -> str:
    """``final`` with the parts it needs, in the order they are declared."""
    needed, open_texts = set(), [final]
    while open_texts:
        words = set(re.findall(r"\b[a-z_]+\b", open_texts.pop()))
        for name in words & (ctes.keys() - needed):
            needed.add(name)
            open_texts.append(ctes[name])
    hint = "MATERIALIZED " if materialized else ""
    parts = [f"{name} AS {hint}({sql})" for name, sql in ctes.items() if name in needed]
    return f"WITH {', '.join(parts)} {final}"


def _flat(source: str, *, dates: str = "", decimals: str = "", drop: str = "") -> str:
    """All columns of a table, dates as text and decimals as double."""
    changes = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    changes += [f"CAST({c} AS DOUBLE) AS {c}" for c in decimals.split()]
    exclude = f" EXCLUDE ({', '.join(drop.split())})" if drop else ""
    replace = f" REPLACE ({', '.join(changes)})" if changes else ""
    return f"SELECT *{exclude}{replace} FROM {source}"


SUBSCRIPTION_DATES = (
    "trial_start_date trial_end_date subscription_start_date subscription_end_date cancelled_date effective_end_date"
)
FUNNEL_DATES = (
    "signed_up_at signed_up_date email_verified_date trial_started_date onboarding_step1_date onboarding_step2_date "
    "activated_date converted_date first_subscription_start_date"
)
PAYMENT_DATES = "payment_date period_start period_end"
KEYLESS = "sk_user_id"


def _pct(top: str, base: str, digits: int = 1) -> str:
    return f"round(100.0 * ({top}) / nullif({base}, 0), {digits})"


def _per_user(amount: str) -> str:
    """A sum per distinct user, rounded half up to whole cents in integers; amounts are not negative."""
    users = "count(DISTINCT user_id)"
    return f"CAST((2 * CAST(sum({amount}) * 100 AS BIGINT) + {users}) // (2 * {users}) / 100.0 AS DOUBLE)"


def _finals(ctx) -> dict[str, str]:
    recent = f"CAST({_day(ctx.as_of)} - to_months({ctx.lookback_months}) AS DATE)"
    event_floor = f"(SELECT max(event_date) - {ctx.lookback_days} FROM stg_events WHERE event_date <= {_day(EVENTS_LOADED)})"
    payment_floor = (
        f"(SELECT max(payment_date) - {ctx.lookback_days} FROM stg_payments WHERE payment_date <= {_day(PAYMENTS_LOADED)})"
    )
    mrr_flat = _flat("fct_mrr", decimals="mrr prev_mrr mrr_delta")
    # Stored rates are decimal(10,4), so a percentage that ends in 5 is rounded up exactly.
    def percent_of(rate: str, name: str) -> str:
        return f"CAST(round(CAST({rate} AS DECIMAL(10,4)) * 100, 1) AS DOUBLE) AS {name}"

    heatmap = f"""
        SELECT cohort_month, months_since_cohort, cohort_size, retained_users,
               {percent_of('retention_rate', 'retention_pct')},
               {percent_of('retention_benchmark', 'benchmark_pct')},
               {percent_of('retention_vs_benchmark', 'vs_benchmark_pct')} FROM {{}}"""
    lift = """
        SELECT months_since_cohort, round(avg(activated_retention_rate) * 100, 1) AS activated_retention_pct,
               round(avg(non_activated_retention_rate) * 100, 1) AS non_activated_retention_pct,
               round(avg(activation_retention_lift) * 100, 1) AS avg_retention_lift_pct
        FROM {} GROUP BY months_since_cohort"""
    events_flat = _flat("fct_events", dates="event_date")
    users_of = "count(DISTINCT user_id)"
    return {
        "stg_events": _flat("stg_events", dates="event_date", drop="event_ts"),
        "stg_events_single_pass_json": _flat("stg_events", dates="event_date", drop="event_ts"),
        "stg_events_field_wise_json": _flat("stg_events", dates="event_date", drop="event_ts"),
        "stg_payments": _flat("stg_payments", dates=PAYMENT_DATES, decimals="amount"),
        "stg_subscriptions": _flat("stg_subscriptions", dates=SUBSCRIPTION_DATES, decimals="mrr"),
        "stg_users": _flat("stg_users", dates="signed_up_at"),
        "rejected_payments": "SELECT payment_id, CAST(amount AS DOUBLE) AS amount, 'amount' AS rejected_columns "
        "FROM raw_payments WHERE amount > 99999.99",
        "dim_users": _flat("dim_users", dates="signed_up_at"),
        "fct_events": events_flat,
        "stream_events": events_flat,
        "stream_late_events": events_flat,
        "fct_payments": _flat("fct_payments", dates=PAYMENT_DATES, decimals="amount"),
        "fct_subscriptions": _flat("fct_subscriptions", dates=SUBSCRIPTION_DATES, decimals="mrr"),
        "fct_mrr": mrr_flat,
        "fct_mrr_full_reactivation": """
            SELECT * EXCLUDE (sk_user_id) REPLACE (CAST(mrr AS DOUBLE) AS mrr, CAST(prev_mrr AS DOUBLE) AS prev_mrr,
                   CAST(CASE mrr_movement_type WHEN 'reactivation' THEN mrr ELSE mrr_delta END AS DOUBLE) AS mrr_delta)
            FROM fct_mrr""",
        "incremental_mrr": _flat("fct_mrr", decimals="mrr prev_mrr mrr_delta", drop=KEYLESS)
        + f" WHERE mrr_month >= strftime({recent}, '%Y%m')",
        "incremental_mrr_carried": _flat("fct_mrr", decimals="mrr prev_mrr mrr_delta", drop=KEYLESS)
        + f" WHERE mrr_month >= strftime({recent}, '%Y%m')",
        "fct_cohort_retention": "SELECT * FROM fct_cohort_retention",
        "fct_user_funnel": _flat("fct_user_funnel", dates=FUNNEL_DATES, decimals="current_mrr"),
        "users_by_span": """
            SELECT kind, span, plan, count(DISTINCT user_id) AS distinct_users FROM (
              SELECT user_id, unnest([plan_id, 'all plans']) AS plan, mrr_month FROM live WHERE user_id IS NOT NULL),
              LATERAL (VALUES ('month', mrr_month), ('year', left(mrr_month, 4)),
                ('quarter', left(mrr_month, 4) || 'Q' || CAST(ceil(CAST(right(mrr_month, 2) AS INT) / 3) AS INT))) AS s(kind, span)
            GROUP BY ALL""",
        "users_rolling_year": """
            SELECT m.mrr_month, count(DISTINCT user_id) AS distinct_users
            FROM (SELECT DISTINCT mrr_month FROM live WHERE user_id IS NOT NULL) AS m JOIN live AS l
              ON strptime(l.mrr_month, '%Y%m') <= strptime(m.mrr_month, '%Y%m')
             AND strptime(l.mrr_month, '%Y%m') > strptime(m.mrr_month, '%Y%m') - INTERVAL 12 MONTH
            GROUP BY ALL""",
        "funnel_from_batches": _flat("fct_user_funnel", dates=FUNNEL_DATES, decimals="current_mrr"),
        "retention_from_batches": "SELECT 'asof' AS form, * FROM fct_cohort_retention "
        "UNION ALL BY NAME SELECT 'triangle' AS form, * FROM fct_cohort_triangle",
        "cohort_retention_asof": "SELECT * FROM int_cohort_retention",
        "cohort_retention_triangle": "SELECT * FROM fct_cohort_triangle",
        "mrr_arr": "SELECT mrr_month, CAST(sum(mrr) AS DOUBLE) AS total_mrr, CAST(sum(mrr) * 12 AS DOUBLE) AS arr "
        "FROM live GROUP BY mrr_month",
        "mrr_waterfall": f"""
            SELECT mrr_month, mrr_movement_type, CAST(sum(mrr_delta) AS DOUBLE) AS mrr_impact,
                   {users_of} AS subscriber_count
            FROM fct_mrr GROUP BY ALL""",
        "revenue_churn_nrr": f"""
            SELECT mrr_month, CAST(active_mrr AS DOUBLE) AS active_mrr, CAST(churned_mrr AS DOUBLE) AS churned_mrr,
                   CAST(new_mrr AS DOUBLE) AS new_mrr, CAST(expansion_mrr AS DOUBLE) AS expansion_mrr,
                   {_pct('m.churned_mrr', 'm.active_mrr', 2)} AS revenue_churn_rate_pct,
                   {_pct('m.new_mrr + m.expansion_mrr - m.churned_mrr', 'm.active_mrr', 2)} AS net_revenue_retention_pct
            FROM monthly AS m""",
        "nrr_standard": f"""
            SELECT m.mrr_month, CAST(p.active_mrr AS DOUBLE) AS beginning_mrr,
                   CAST(m.expansion_mrr AS DOUBLE) AS expansion_mrr,
                   CAST(m.contraction_mrr AS DOUBLE) AS contraction_mrr, CAST(m.churned_mrr AS DOUBLE) AS churned_mrr,
                   {_pct('p.active_mrr + m.expansion_mrr + m.contraction_mrr - m.churned_mrr', 'p.active_mrr', 2)} AS nrr_pct
            FROM monthly AS m LEFT JOIN monthly AS p ON p.month_start + to_months(1) = m.month_start""",
        "churn_rate_beginning": f"""
            SELECT m.mrr_month, CAST(p.active_mrr AS DOUBLE) AS beginning_mrr, CAST(m.churned_mrr AS DOUBLE) AS churned_mrr,
                   {_pct('m.churned_mrr', 'p.active_mrr', 2)} AS churn_rate_pct
            FROM monthly AS m LEFT JOIN monthly AS p ON p.month_start + to_months(1) = m.month_start""",
        "mrr_yoy": f"""
            SELECT m.mrr_month, CAST(m.total AS DOUBLE) AS total_mrr, CAST(p.total AS DOUBLE) AS mrr_last_year,
                   {_pct('m.total - p.total', 'p.total', 2)} AS yoy_growth_pct
            FROM live_totals AS m LEFT JOIN live_totals AS p ON p.month_start + to_months(12) = m.month_start""",
        "arpu_by_plan": f"""
            SELECT plan_name, mrr_month, {_per_user('mrr')} AS arpu
            FROM live JOIN dim_plans USING (sk_plan_id) GROUP BY ALL""",
        "ltv_by_plan": """
            SELECT plan_name, round(avg(mrr), 2) AS avg_mrr,
                   round(100.0 * count(*) FILTER (WHERE is_churned) / count(*), 2) AS monthly_churn_rate_pct,
                   round(avg(mrr) * count(*) / nullif(count(*) FILTER (WHERE is_churned), 0), 2) AS ltv
            FROM fct_subscriptions JOIN dim_plans USING (sk_plan_id) GROUP BY plan_name""",
        "seasonality": "SELECT left(mrr_month, 4) AS revenue_year, right(mrr_month, 2) AS month_of_year, "
        "CAST(total AS DOUBLE) AS monthly_mrr FROM live_totals",
        "seasonality_avg": "SELECT right(mrr_month, 2) AS month_of_year, round(avg(total), 2) AS avg_mrr_for_month "
        "FROM live_totals GROUP BY ALL",
        "waterfall_wide": """
            SELECT mrr_month, CAST(coalesce(sum(mrr) FILTER (mrr_movement_type = 'new'), 0) AS DOUBLE) AS new_mrr,
                   CAST(coalesce(sum(mrr_delta) FILTER (mrr_movement_type = 'expansion'), 0) AS DOUBLE) AS expansion_mrr,
                   CAST(coalesce(sum(mrr_delta) FILTER (mrr_movement_type = 'contraction'), 0) AS DOUBLE) AS contraction_mrr,
                   CAST(coalesce(sum(mrr) FILTER (mrr_movement_type = 'churned'), 0) AS DOUBLE) AS churned_mrr
            FROM fct_mrr GROUP BY mrr_month""",
        "ltv_per_user": "SELECT user_id, CAST(sum(mrr) AS DOUBLE) AS lifetime_mrr, "
        "count(DISTINCT mrr_month) AS active_months FROM live GROUP BY user_id",
        "ltv_by_cohort": f"SELECT cohort_month, CAST(sum(mrr) AS DOUBLE) AS lifetime_mrr, {users_of} AS users, "
        f"{_per_user('mrr')} AS mrr_per_user FROM live GROUP BY cohort_month",
        "funnel_conversion": """
            SELECT count(*) AS total_users, count(*) FILTER (has_verified_email) AS email_verified,
                   count(*) FILTER (has_started_trial) AS trial_started, count(*) FILTER (has_activated) AS activated,
                   count(*) FILTER (has_converted) AS converted,
                   round(email_verified / total_users * 100, 1) AS email_verified_pct,
                   round(trial_started / total_users * 100, 1) AS trial_started_pct,
                   round(activated / total_users * 100, 1) AS activation_rate_pct,
                   round(converted / total_users * 100, 1) AS conversion_rate_pct
            FROM fct_user_funnel""",
        "funnel_dropoff": """
            SELECT highest_funnel_stage_order AS stage_order, highest_funnel_stage_name AS stage_name,
                   count(*) AS users_stopped_here,
                   round(100.0 * count(*) / (SELECT count(*) FROM fct_user_funnel), 1) AS pct_of_all_users
            FROM fct_user_funnel GROUP BY ALL""",
        "time_to_milestones": "SELECT " + ", ".join(
            f"quantile_cont(days_to_{m}, 0.5) AS p50_days_to_{m}, avg(days_to_{m}) AS avg_days_to_{m}"
            for m in ("email_verified", "activation", "conversion")
        ) + " FROM fct_user_funnel",
        "activation_retention": lift.format("fct_cohort_retention"),
        "activation_retention_triangle": lift.format("fct_cohort_triangle"),
        "retention_heatmap": heatmap.format("fct_cohort_retention"),
        "retention_heatmap_triangle": heatmap.format("fct_cohort_triangle"),
        "converter_profile": f"""
            SELECT has_converted, acquisition_channel, company_size, count(*) AS total_users,
                   round(avg(days_to_activation), 1) AS avg_days_to_activation,
                   round(avg(days_to_conversion), 1) AS avg_days_to_conversion,
                   {_pct('count(*) FILTER (has_activated)', 'count(*)')} AS activation_rate_pct
            FROM fct_user_funnel GROUP BY has_converted, acquisition_channel, company_size""",
        "channel_conversion": f"""
            SELECT acquisition_channel, company_size, count(*) AS total_users,
                   {_pct('count(*) FILTER (has_converted)', 'count(*)')} AS conversion_rate_pct,
                   {_pct('count(*) FILTER (has_activated)', 'count(*)')} AS activation_rate_pct,
                   round(avg(days_to_activation), 1) AS avg_days_to_activation
            FROM fct_user_funnel GROUP BY acquisition_channel, company_size""",
        "funnel_stage_users": f"""
            SELECT funnel_stage_order, event_name, users, users_stage_before,
                   users_stage_before - users AS drop_off, {_pct('users', 'users_stage_before')} AS step_conversion_pct
            FROM (SELECT *, lag(users) OVER (ORDER BY funnel_stage_order) AS users_stage_before
                  FROM (SELECT funnel_stage_order, event_name, {users_of} AS users FROM stg_events
                        WHERE is_funnel_event GROUP BY ALL))""",
        "activation_latency": """
            SELECT user_id, CAST(signed_up_at AS VARCHAR) AS signed_up_at, CAST(first_day AS VARCHAR) AS first_activation_date,
                   CAST(first_day - signed_up_at AS INTEGER) AS days_to_activation
            FROM dim_users JOIN (SELECT user_id, min(event_date) AS first_day FROM stg_events
                                 WHERE is_activation_event GROUP BY user_id) USING (user_id)""",
        "feature_conversion_pivot": f"""
            SELECT feature_used, count(DISTINCT user_id) FILTER (user_id IN buyers) AS converted,
                   count(DISTINCT user_id) FILTER (user_id NOT IN buyers) AS not_converted,
                   {_pct('converted', 'converted + not_converted')} AS conversion_pct
            FROM stg_events, (SELECT list(DISTINCT user_id) AS buyers FROM stg_events WHERE is_conversion_event)
            WHERE feature_used IS NOT NULL GROUP BY feature_used""",
        "activation_conversion": """
            SELECT has_activated, count(*) AS total_users, avg(CAST(has_converted AS INTEGER)) AS conversion_rate,
                   avg(days_to_conversion) AS avg_days_to_conversion
            FROM fct_user_funnel GROUP BY has_activated""",
        "stage_conversion": """
            SELECT highest_funnel_stage_order, highest_funnel_stage_name, count(*) AS users_reached,
                   count(*) FILTER (has_converted) AS converted
            FROM fct_user_funnel GROUP BY ALL""",
        "cancel_reasons": """
            SELECT cancel_reason, plan_name, n AS churned_subscriptions,
                   round(100.0 * n / sum(n) OVER (), 1) AS pct_of_all_churned,
                   round(100.0 * n / sum(n) OVER (PARTITION BY cancel_reason), 1) AS pct_within_reason
            FROM (SELECT cancel_reason, plan_name, count(*) AS n
                  FROM fct_subscriptions JOIN dim_plans USING (sk_plan_id) WHERE is_churned GROUP BY ALL)""",
        "payment_success": f"""
            SELECT plan_name, billing_cycle, count(*) AS total_payments,
                   count(*) FILTER (is_revenue_recognised) AS successful_payments,
                   count(*) FILTER (is_failed) AS failed_payments,
                   {_pct('count(*) FILTER (is_revenue_recognised)', 'count(*)')} AS success_rate_pct
            FROM fct_payments JOIN dim_plans USING (sk_plan_id) GROUP BY plan_name, billing_cycle""",
        "revenue_by_month": """
            SELECT payment_month, CAST(sum(amount) AS DOUBLE) AS revenue,
                   CAST(sum(CAST(mrr_contribution AS DECIMAL(12,2))) AS DOUBLE) AS mrr_contribution, count(*) AS payments
            FROM fct_payments WHERE is_revenue_recognised GROUP BY payment_month""",
        "revenue_by_segment_payments": f"""
            SELECT company_size, industry, CAST(sum(amount) AS DOUBLE) AS revenue, count(*) AS payments,
                   {users_of} AS paying_users
            FROM fct_payments JOIN dim_users USING (user_id) WHERE is_revenue_recognised GROUP BY ALL""",
        "revenue_yoy": """
            SELECT left(payment_month, 4) AS revenue_year, right(payment_month, 2) AS month_of_year,
                   CAST(sum(amount) AS DOUBLE) AS revenue
            FROM fct_payments WHERE is_revenue_recognised GROUP BY payment_month""",
        "arpu_payments": f"""
            SELECT payment_month, CAST(sum(amount) AS DOUBLE) AS revenue, {users_of} AS paying_users,
                   {_per_user('amount')} AS arpu
            FROM fct_payments WHERE is_revenue_recognised GROUP BY payment_month""",
        "subscription_churn_rate": f"""
            SELECT count(*) AS total_subscriptions, count(*) FILTER (is_churned) AS churned_subscriptions,
                   {_pct('count(*) FILTER (is_churned)', 'count(*)', 2)} AS churn_rate_pct
            FROM fct_subscriptions""",
        "ltv_duration": """
            SELECT plan_id, round(sum(mrr * subscription_duration_days) / 30, 2) AS lifetime_value,
                   count(*) AS subscriptions
            FROM fct_subscriptions WHERE subscription_duration_days IS NOT NULL GROUP BY plan_id""",
        "longest_segments": """
            SELECT company_size, acquisition_channel, count(*) AS subscriptions,
                   round(avg(subscription_duration_days), 1) AS avg_duration_days
            FROM fct_subscriptions JOIN dim_users USING (user_id)
            WHERE subscription_duration_days IS NOT NULL GROUP BY ALL""",
        "dq_failed_emails": "SELECT user_id, email FROM stg_users WHERE email LIKE '%#bad'",
        "upsert_events": f"""
            SELECT * EXCLUDE (event_ts) REPLACE (CAST(event_date AS VARCHAR) AS event_date,
                   CASE WHEN event_date < {event_floor} THEN 'as loaded first' ELSE raw_properties END AS raw_properties)
            FROM stg_events""",
        "upsert_payments": f"""
            SELECT * EXCLUDE (sk_user_id) REPLACE (CAST(payment_date AS VARCHAR) AS payment_date,
                   CAST(period_start AS VARCHAR) AS period_start, CAST(period_end AS VARCHAR) AS period_end,
                   CAST(amount AS DOUBLE) AS amount,
                   CASE WHEN payment_date < {payment_floor} THEN 'as loaded first' ELSE status END AS status)
            FROM fct_payments""",
        "upsert_payments_directory": f"""
            SELECT * EXCLUDE (sk_user_id) REPLACE (CAST(payment_date AS VARCHAR) AS payment_date,
                   CAST(period_start AS VARCHAR) AS period_start, CAST(period_end AS VARCHAR) AS period_end,
                   CAST(amount AS DOUBLE) AS amount,
                   CASE WHEN payment_date < {payment_floor} THEN 'as loaded first' ELSE status END AS status)
            FROM fct_payments""",
        "append_columns": f"""
            SELECT * EXCLUDE (sk_user_id) REPLACE (CAST(payment_date AS VARCHAR) AS payment_date,
                   CAST(period_start AS VARCHAR) AS period_start, CAST(period_end AS VARCHAR) AS period_end,
                   CAST(amount AS DOUBLE) AS amount,
                   CASE WHEN payment_date >= {payment_floor} THEN days_in_period END AS days_in_period)
            FROM fct_payments""",
        "full_refresh_subscriptions": _flat("fct_subscriptions", dates=SUBSCRIPTION_DATES, decimals="mrr", drop=KEYLESS),
        "dim_users_catalog": " UNION ALL ".join(
            f"SELECT {place} AS place, '{name}' AS column_name, '{kind}' AS data_type, {_text(comment)} AS comment, "
            f"false AS is_personal, (SELECT count({filled}) FROM dim_users) AS filled_rows"
            for place, (name, kind, comment, filled) in enumerate(USER_COLUMNS, 1)
        ),
        "view_sink": """
            SELECT status, payment_month, count(*) AS payments, CAST(sum(amount) AS DOUBLE) AS amount
            FROM stg_payments GROUP BY ALL""",
        "ordered_mrr_arr": """
            SELECT mrr_month, CAST(sum(mrr) AS DOUBLE) AS total_mrr, CAST(sum(mrr) * 12 AS DOUBLE) AS arr,
                   row_number() OVER (ORDER BY mrr_month) AS place
            FROM live GROUP BY mrr_month""",
        "ordered_cancel_reasons": """
            SELECT cancel_reason, plan_name, n AS churned_subscriptions,
                   round(100.0 * n / sum(n) OVER (), 1) AS pct_of_all_churned,
                   round(100.0 * n / sum(n) OVER (PARTITION BY cancel_reason), 1) AS pct_within_reason,
                   row_number() OVER (ORDER BY n DESC, cancel_reason, plan_name) AS place
            FROM (SELECT cancel_reason, plan_name, count(*) AS n
                  FROM fct_subscriptions JOIN dim_plans USING (sk_plan_id) WHERE is_churned GROUP BY ALL)""",
        "milestone_quantiles": """
            SELECT period, milestone, count(days) AS users, quantile_disc(days, 0.5) AS p50, quantile_disc(days, 0.9) AS p90
            FROM (SELECT unnest([left(signup_month, 4), 'all']) AS period, days_to_email_verified, days_to_activation, days_to_conversion
                  FROM fct_user_funnel),
              LATERAL (VALUES ('email_verified', days_to_email_verified), ('activation', days_to_activation),
                              ('conversion', days_to_conversion)) AS m(milestone, days)
            GROUP BY ALL HAVING count(days) > 0""",
        "upsert_subscriptions": _flat(
            f"""(SELECT * EXCLUDE (sk_user_id) REPLACE (CASE WHEN is_active OR trial_start_date >= {recent}
                   OR subscription_end_date >= {recent} THEN status ELSE 'as loaded first' END AS status)
                 FROM fct_subscriptions)""",
            dates=SUBSCRIPTION_DATES,
            decimals="mrr",
        ),
        "freshness": """
            SELECT 'events' AS source, age AS age_seconds,
                   CASE WHEN age <= 86400 THEN 'pass' WHEN age <= 7 * 86400 THEN 'warn' ELSE 'error' END AS status
            FROM (SELECT CAST(epoch(TIMESTAMP '2024-02-01') - floor(epoch(max(event_at))) AS BIGINT) AS age FROM raw_events)""",
        "stream_churn_monitor": """
            SELECT CAST(event_date AS VARCHAR) AS event_date, churn_reason, acquisition_channel, count(*) AS cancellations
            FROM stg_events LEFT JOIN dim_users USING (user_id)
            WHERE is_churn GROUP BY ALL""",
    }


def _check_sql(check: Check) -> str:
    column = check.columns[0]
    if check.kind == "not_null":
        failures = f"SELECT count(*) FROM {check.table} WHERE {column} IS NULL"
    elif check.kind == "accepted_values":
        failures = f"SELECT count(*) FROM {check.table} WHERE {column} NOT IN ({_quoted(check.values)})"
    elif check.kind == "email":
        failures = f"SELECT count(*) FROM {check.table} WHERE NOT regexp_matches({column}, '{EMAIL_PATTERN}')"
    elif check.kind == "expression":
        failures = f"SELECT count(*) FROM {check.table} WHERE NOT ({column} {check.detail})"
    elif check.kind == "relationships":
        failures = (
            f"SELECT count(*) FROM {check.table} AS c WHERE {column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {check.parent} AS p WHERE p.{check.parent_column} = c.{column})"
        )
    else:
        known = f"WHERE {column} IS NOT NULL" if check.kind == "unique" else ""
        failures = (
            f"SELECT count(*) FROM (SELECT 1 FROM {check.table} {known} GROUP BY {check.column_name} HAVING count(*) > 1)"
        )
    bad = "warn" if check.severity == "warn" else "fail"
    return (
        f"SELECT '{check.table}' AS table_name, '{check.kind}' AS check_type, '{check.column_name}' AS column_name, "
        f"'{check.detail}' AS detail, '{check.severity}' AS severity, failures, "
        f"CASE failures WHEN 0 THEN 'pass' ELSE '{bad}' END AS status FROM ({failures}) AS t(failures)"
    )


def _contract_sql() -> str:
    rules = []
    for name, contract in CONTRACTS.items():
        for column in contract.required:
            # DuckDB has no load timestamp, which is never NULL.
            found = "0::BIGINT" if column == "_stg_loaded_at" else f"(SELECT count(*) FROM {name} WHERE {column} IS NULL)"
            rules.append(f"SELECT '{name}' AS table_name, 'not_null' AS rule, '{column}' AS column_name, {found} AS violations")
        if key := contract.primary_key:
            rules.append(
                f"SELECT '{name}', 'primary_key', '{key}', (SELECT count(*) FROM "
                f"(SELECT {key} FROM {name} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1))"
            )
    return " UNION ALL ".join(rules)


def oracle_queries() -> dict[str, str]:
    ctes = _ctes(SAMPLE_CONTEXT)
    queries = {name: _with(ctes, final) for name, final in _finals(SAMPLE_CONTEXT).items()}
    queries["revenue_by_segment"] = _with(
        _ctes(LATE_CONTEXT),
        """
        SELECT acquisition_channel, company_size, plan_name, CAST(sum(mrr) AS DOUBLE) AS total_mrr,
               count(DISTINCT live.user_id) AS active_subscribers
        FROM live JOIN dim_users USING (sk_user_id) JOIN dim_plans USING (sk_plan_id)
        WHERE mrr_month = (SELECT max(mrr_month) FROM fct_mrr) GROUP BY ALL""",
    )
    for kind in (*ROW_KINDS, "unique", "relationships", "unique_combo"):
        final = " UNION ALL ".join(_check_sql(c) for c in declared_checks({kind}))
        queries[f"dq_{kind}"] = _with(ctes, final, materialized=True)
    queries["build_checks"] = _with(ctes, " UNION ALL ".join(_check_sql(c) for c in declared_checks()), materialized=True)
    queries["enforce_contract"] = _with(ctes, _contract_sql(), materialized=True)
    return queries
