"""Every operator and report as a query over the parquet tables of one folder.

Money and rates leave as double and dates as ISO text, so the results can be
compared with another engine value by value; the load timestamp is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType

from ledgerlight.operators import checks, contracts, facts, mrr, retention, staging, tables, user_bitmaps
from ledgerlight.operators.funnel_state import FunnelState
from ledgerlight.operators.mrr_carry import CarriedState
from ledgerlight.operators.retention_state import RetentionState
from ledgerlight.plans import billing, product, revenue
from ledgerlight.plans.build import STORED_MARTS, build_marts, check_build, mart_table
from ledgerlight.plans.check_list import declared_checks
from ledgerlight.plans.marts import Marts
from ledgerlight.session import scratch_folder
from ledgerlight.sources.sample_feed import SAMPLE_CONTEXT, TEST_SCHEMAS, SampleTables, events_from_events
from ledgerlight.streaming.events import churn_counts, churn_monitor, durable_state, stream_events, stream_late_events
from ledgerlight.streaming.freshness import freshness

Query = Callable[[SparkSession, str], DataFrame]

# Late enough that the latest month of the MRR fact still has live subscriptions.
LATE_CONTEXT = replace(SAMPLE_CONTEXT, as_of=date(2003, 3, 31))

# Incremental runs: rows up to these days count as loaded before.
EVENTS_LOADED = date(2024, 1, 20)
PAYMENTS_LOADED = date(2001, 6, 30)


def sample_marts(spark: SparkSession, sf_dir: str, late: bool = False) -> Marts:
    return Marts(SampleTables(spark, sf_dir), LATE_CONTEXT if late else SAMPLE_CONTEXT)


def comparable(rows: DataFrame) -> DataFrame:
    columns = []
    for f in rows.schema.fields:
        if f.name == "_stg_loaded_at":
            continue
        column = F.col(f.name)
        if isinstance(f.dataType, DecimalType):
            column = column.cast("double").alias(f.name)
        elif isinstance(f.dataType, DateType):
            column = column.cast("string").alias(f.name)
        columns.append(column)
    return rows.select(columns)


def _layer_tables(m: Marts) -> dict[str, DataFrame]:
    return {
        "raw_events": m.raw.events,
        "raw_payments": m.raw.payments,
        "raw_subscriptions": m.raw.subscriptions,
        "raw_users": m.raw.users,
        "stg_events": m.staged_events,
        "stg_payments": m.staged_payments,
        "stg_plans": m.staged_plans,
        "stg_subscriptions": m.staged_subscriptions,
        "stg_users": m.staged_users,
        "int_cohort_retention": retention.cohort_retention_asof(m.staged_subscriptions, m.staged_events, m.ctx),
        "dim_plans": m.plans,
        "dim_users": m.users,
        "fct_cohort_retention": m.cohort_retention,
        "fct_events": m.events,
        "fct_mrr": m.mrr,
        "fct_payments": m.payments,
        "fct_subscriptions": m.subscriptions,
        "fct_user_funnel": m.funnel,
    }


def _check_query(*kinds: str) -> Callable[[Marts], DataFrame]:
    return lambda m: checks.run_checks(_layer_tables(m), declared_checks(set(kinds)))


def _failed_emails(m: Marts) -> DataFrame:
    (check,) = declared_checks({"email"})
    return checks.failing_rows(check, _layer_tables(m)).select("user_id", "email")


def _contract_report(m: Marts) -> DataFrame:
    return contracts.contract_report({
        "dim_plans": m.plans,
        "dim_users": m.users,
        "fct_cohort_retention": m.cohort_retention,
        "fct_events": m.events,
        "fct_mrr": m.mrr,
        "fct_payments": m.payments,
        "fct_subscriptions": m.subscriptions,
        "fct_user_funnel": m.funnel,
    })


def _segment_query(m: Marts) -> DataFrame:
    latest = mrr.latest_month(m.keyless_subscriptions, m.ctx)
    # The user key is joined to the latest month's rows only.
    month = mrr.active_in_month(mrr.paid_spans(m.keyless_subscriptions, m.ctx), latest.scalar())
    return revenue.revenue_by_segment(facts.with_user_key(month, m.users), m.users, m.plans, latest)


def _stored_upsert(m: Marts, stored: DataFrame, batch: DataFrame, name: str) -> DataFrame:
    """Load a stored mart, merge a batch into it, and read it back."""
    table = mart_table(m.raw.spark, scratch_folder(m.raw.spark, "upsert"), name)
    table.replace(stored)
    table.upsert(batch)
    return table.read()


def _upsert_events(m: Marts) -> DataFrame:
    """A stored month of events meets a later delivery of the same events and new ones."""
    stored = m.keyless_events.where(F.col("event_date") <= F.lit(EVENTS_LOADED)).withColumn(
        "raw_properties", F.lit("as loaded first")
    )
    batch = tables.since_last_load(m.keyless_events, stored, "event_date", m.ctx)
    return _stored_upsert(m, stored, batch, "fct_events")


def _upsert_payments(m: Marts) -> DataFrame:
    stored = m.keyless_payments.where(F.col("payment_date") <= F.lit(PAYMENTS_LOADED)).withColumn(
        "status", F.lit("as loaded first")
    )
    batch = tables.since_last_load(m.keyless_payments, stored, "payment_date", m.ctx)
    return _stored_upsert(m, stored, batch, "fct_payments")


def _upsert_with_directory(m: Marts) -> DataFrame:
    """The payments upsert again; rows that are first stored in another month are found through the directory of keys."""
    spark, loaded = m.raw.spark, F.col("payment_date") <= F.lit(PAYMENTS_LOADED)
    stored = m.keyless_payments.where(loaded).withColumn("status", F.lit("as loaded first"))
    batch = tables.since_last_load(m.keyless_payments, stored, "payment_date", m.ctx)
    floor = F.date_sub(F.lit(PAYMENTS_LOADED), m.ctx.lookback_days)
    # A part of what the batch brings again was booked a year earlier by mistake.
    wrong = (F.col("payment_date") >= floor) & (F.pmod(F.xxhash64("payment_id"), F.lit(3)) == 0)
    year = F.date_format(F.add_months("payment_date", -12), "yyyyMM")
    stored = stored.withColumn("payment_month", F.when(wrong, year).otherwise(F.col("payment_month")))
    key, month, _ = STORED_MARTS["fct_payments"]
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = tables.MonthTable(spark, scratch_folder(spark, "directory"), key, month, key_buckets=buckets)
    table.replace(stored)
    table.upsert(batch)
    return table.read()


def _upsert_subscriptions(m: Marts) -> DataFrame:
    stored = m.keyless_subscriptions.withColumn("status", F.lit("as loaded first"))
    batch = tables.changing_subscriptions(m.keyless_subscriptions, m.ctx)
    return _stored_upsert(m, stored, batch, "fct_subscriptions")


def _incremental_mrr(m: Marts) -> DataFrame:
    return mrr.fct_mrr(m.keyless_subscriptions, m.ctx, incremental=True, hot=m.hot_users)


def _carried_mrr(m: Marts) -> DataFrame:
    """The lookback months from the stored fact of a run two months earlier and the state read from it."""
    earlier = replace(m.ctx, as_of=(m.ctx.as_of.replace(day=1) - timedelta(days=40)))
    root = scratch_folder(m.raw.spark, "carried_mrr")
    table = mart_table(m.raw.spark, root, "fct_mrr")
    parts = mrr.write_parts(m.staged_subscriptions, earlier)
    table.replace(mrr.fct_mrr(m.keyless_subscriptions, earlier, hot=m.hot_users), cut_by="user_id", parts=parts)
    rows = CarriedState(m.raw.spark, root, table).rows(m.keyless_subscriptions, m.ctx, hot=m.hot_users)
    return rows.where(F.col("mrr_month") >= m.ctx.oldest_reloaded_month())


# Batches of the carried states: events and subscriptions up to these days, and the rest. Subscriptions that
# a later batch changes come into an earlier one as they were before.
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(9999, 12, 31)
BATCH_ENDS = ((date(2024, 1, 12), date(1997, 6, 30)), (date(2024, 1, 22), date(1999, 12, 31)), (LAST_DAY, LAST_DAY))


def _batches(m: Marts) -> Iterator[tuple[DataFrame, DataFrame, DataFrame]]:
    """Three batches as (events, subscriptions, all subscriptions known after it).

    Events of the last days before a batch are delivered again. A quarter of the subscriptions is in the first batch as an
    active one without an end, and in the last as it is.
    """
    events, subs = m.plain_events, m.keyless_subscriptions
    changing = F.pmod(F.xxhash64("subscription_id"), F.lit(4)) == 0
    begun = F.coalesce("trial_start_date", F.lit(FIRST_DAY + timedelta(days=1)))
    before = {"is_active": F.lit(True), "is_churned": F.lit(False), "mrr": (F.col("mrr") + 1).cast("decimal(10,2)"), "cancel_reason": F.lit("as known first")}
    # One scan for both kinds: the changing ones are marked, not read apart.
    early = subs.withColumns({name: F.when(changing, value).otherwise(F.col(name)) for name, value in before.items()})
    floor = (FIRST_DAY, FIRST_DAY)
    for number, (day, start) in enumerate(BATCH_ENDS):
        last = start == LAST_DAY
        rows = subs if last else early
        known = rows.where(changing | (begun <= F.lit(start)))
        fresh = ~changing & (begun > F.lit(floor[1])) & (begun <= F.lit(start))
        batch = rows.where(fresh if 0 < number and not last else changing | fresh)
        repeated = floor[0] - timedelta(days=3) if number else FIRST_DAY
        yield events.where((F.col("event_date") > F.lit(repeated)) & (F.col("event_date") <= F.lit(day))), batch, known
        floor = (day, start)


def _carried_funnel(m: Marts) -> DataFrame:
    """The funnel after three batches, from state alone."""
    state = FunnelState(m.raw.spark, scratch_folder(m.raw.spark, "funnel"))
    for events, subscriptions, known in _batches(m):
        state.update(events, subscriptions, known, m.ctx)
    return state.funnel(m.users)


def _carried_retention(m: Marts) -> DataFrame:
    """Both forms of cohort retention after three batches, from the histogram alone."""
    state = RetentionState(m.raw.spark, scratch_folder(m.raw.spark, "retention"))
    for events, subscriptions, known in _batches(m):
        state.update(events, subscriptions, known)
    forms = {"asof": state.asof(m.ctx), "triangle": state.triangle(m.ctx)}
    asof, triangle = (retention.fct_cohort_retention(rows).withColumn("form", F.lit(name)) for name, rows in forms.items())
    return asof.unionByName(triangle)


def _user_bitmaps(m: Marts) -> DataFrame:
    """Live users per month and plan as stored bitmaps, merged from two halves of the subscriptions."""
    spans = mrr.paid_spans(m.keyless_subscriptions, m.ctx)
    early = spans.where(F.col("subscription_start_date") <= F.lit(PAYMENTS_LOADED))
    spark, root = m.raw.spark, scratch_folder(m.raw.spark, "user_bitmaps")

    def stored(rows: DataFrame, name: str) -> DataFrame:
        tables.replace_table(rows, f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    numbers = stored(user_bitmaps.numbered_users(early), "numbers-0")
    first = stored(user_bitmaps.user_months(early, numbers, ["plan_id"]), "bitmaps-0")
    numbers = stored(user_bitmaps.numbered_users(spans, numbers), "numbers-1")
    late = spans.where(F.col("subscription_start_date") > F.lit(PAYMENTS_LOADED))
    return stored(user_bitmaps.merged(first, user_bitmaps.user_months(late, numbers, ["plan_id"])), "bitmaps-1")


def _users_by_span(m: Marts) -> DataFrame:
    """Distinct users per month, quarter and year, by plan and over all plans, from the same bitmaps."""
    bitmaps = _user_bitmaps(m)
    year, month = F.substring("mrr_month", 1, 4), F.substring("mrr_month", 5, 2).cast("int")
    spans = {"month": F.col("mrr_month"), "quarter": F.concat(year, F.lit("Q"), F.ceil(month / 3)), "year": year}
    parts = []
    for kind, span in spans.items():
        for plan in (F.col("plan_id"), F.lit("all plans")):
            counted = user_bitmaps.distinct_users(bitmaps, span.alias("span"), plan.alias("plan"))
            parts.append(counted.withColumn("kind", F.lit(kind)))
    return reduce(DataFrame.unionByName, parts)


def _rolling_users(m: Marts) -> DataFrame:
    """Distinct users of the last twelve months, month by month."""
    return user_bitmaps.rolling_users(_user_bitmaps(m), 12)


def _in_order(rows: DataFrame) -> DataFrame:
    """A sorted report with the place at which each row comes out."""
    return rows.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


def _full_refresh(m: Marts) -> DataFrame:
    """A stored fact with outdated and foreign rows is loaded anew."""
    table = mart_table(m.raw.spark, scratch_folder(m.raw.spark, "refresh"), "fct_subscriptions")
    subs = m.keyless_subscriptions
    outdated = subs.withColumns({"status": F.lit("outdated"), "cohort_month": F.lit("190001")})
    table.replace(subs.unionByName(outdated.withColumn("sk_subscription_id", F.concat(F.lit("x"), "sk_subscription_id"))))
    table.replace(subs)
    return table.read()


def _appended_columns(m: Marts) -> DataFrame:
    """Payments stored without a column that a later batch brings."""
    stored = m.keyless_payments.where(F.col("payment_date") <= F.lit(PAYMENTS_LOADED)).drop("days_in_period")
    batch = tables.since_last_load(m.keyless_payments, stored, "payment_date", m.ctx)
    return _stored_upsert(m, stored, batch, "fct_payments")


def _user_catalog(m: Marts) -> DataFrame:
    """The columns of the stored user dimension with the comments that went with it."""
    table = mart_table(m.raw.spark, scratch_folder(m.raw.spark, "catalog"), "dim_users")
    table.replace(contracts.enforce(m.users, contracts.CONTRACTS["dim_users"]))
    return contracts.described(table.read())


def _from_view(m: Marts) -> DataFrame:
    """A staged layer as a view, read by SQL."""
    tables.as_view(m.staged_payments, "staged_payments")
    return m.raw.spark.sql(
        "SELECT status, payment_month, count(*) AS payments, sum(amount) AS amount FROM staged_payments GROUP BY ALL"
    )


def _milestone_quantiles(m: Marts) -> DataFrame:
    """Medians and ninth deciles per signup year and over all, from stored monthly sketches."""
    path = scratch_folder(m.raw.spark, "milestones")
    tables.replace_table(product.milestone_sketches(m.funnel), path)
    stored = m.raw.spark.read.parquet(path)
    years = product.milestone_quantiles(stored, F.substring("signup_month", 1, 4).alias("period"))
    return years.unionByName(product.milestone_quantiles(stored, F.lit("all").alias("period")))


def _rejected_payments(m: Marts) -> DataFrame:
    """Payments with an amount too large for five digits before the point."""
    return staging.rejected_rows(m.raw.payments, {"amount": "decimal(7,2)"}).select(
        "payment_id", "amount", F.array_join("rejected_columns", ",").alias("rejected_columns")
    )


def _event_freshness(m: Marts) -> DataFrame:
    return freshness(
        m.raw.events, "events", "event_at", datetime(2024, 2, 1), timedelta(days=1), timedelta(days=7)
    )


BATCH_QUERIES: dict[str, Callable[[Marts], DataFrame]] = {
    # Staging
    "stg_events": lambda m: m.staged_events,
    "stg_events_single_pass_json": lambda m: staging.stg_events(m.raw.events, single_pass_json=True),
    "stg_events_field_wise_json": lambda m: staging.stg_events(m.raw.events, single_pass_json=False),
    "stg_payments": lambda m: m.staged_payments,
    "stg_subscriptions": lambda m: m.staged_subscriptions,
    "stg_users": lambda m: m.staged_users,
    "rejected_payments": _rejected_payments,
    # Dimensions and facts
    "dim_users": lambda m: m.users,
    "fct_events": lambda m: m.events,
    "fct_payments": lambda m: m.payments,
    "fct_subscriptions": lambda m: m.subscriptions,
    "fct_mrr": lambda m: m.mrr,
    "fct_mrr_full_reactivation": lambda m: mrr.fct_mrr(
        m.keyless_subscriptions, m.ctx, reactivation_delta="full", hot=m.hot_users
    ),
    "fct_cohort_retention": lambda m: m.cohort_retention,
    "fct_user_funnel": lambda m: m.funnel,
    "cohort_retention_asof": lambda m: retention.cohort_retention_asof(
        m.staged_subscriptions, m.staged_events, m.ctx
    ),
    "cohort_retention_triangle": lambda m: m.cohort_triangle,
    # Revenue reports
    "mrr_arr": lambda m: revenue.mrr_arr(m.live_month_totals),
    "mrr_waterfall": lambda m: revenue.mrr_waterfall(m.keyless_mrr),
    "revenue_churn_nrr": lambda m: revenue.revenue_churn_nrr(m.keyless_mrr),
    "nrr_standard": lambda m: revenue.nrr_standard(m.keyless_mrr),
    "arpu_by_plan": lambda m: revenue.arpu_by_plan(m.live_months, m.plans),
    "ltv_by_plan": lambda m: revenue.ltv_by_plan(m.keyless_subscriptions, m.plans),
    "seasonality": lambda m: revenue.seasonality(m.live_month_totals),
    "seasonality_avg": lambda m: revenue.seasonality_avg(m.live_month_totals),
    "waterfall_wide": lambda m: revenue.waterfall_wide(m.keyless_mrr),
    "churn_rate_beginning": lambda m: revenue.churn_rate_beginning(m.keyless_mrr),
    "ltv_per_user": lambda m: revenue.ltv_per_user(m.live_months),
    "ltv_by_cohort": lambda m: revenue.ltv_by_cohort(m.live_months),
    "mrr_yoy": lambda m: revenue.mrr_yoy(m.live_month_totals),
    # Product reports
    "funnel_conversion": lambda m: product.funnel_conversion(m.funnel),
    "funnel_dropoff": lambda m: product.funnel_dropoff(m.funnel),
    "time_to_milestones": lambda m: product.time_to_milestones(m.funnel),
    "activation_retention": lambda m: product.activation_retention(m.cohort_retention),
    "activation_retention_triangle": lambda m: product.activation_retention(m.cohort_triangle),
    "converter_profile": lambda m: product.converter_profile(m.funnel),
    "retention_heatmap": lambda m: product.retention_heatmap(m.cohort_retention),
    "retention_heatmap_triangle": lambda m: product.retention_heatmap(m.cohort_triangle),
    "channel_conversion": lambda m: product.channel_conversion(m.funnel),
    "funnel_stage_users": lambda m: product.funnel_stage_users(m.plain_events),
    "activation_latency": lambda m: product.activation_latency(m.plain_events, m.users),
    "feature_conversion_pivot": lambda m: product.feature_conversion_pivot(m.keyless_events),
    "activation_conversion": lambda m: product.activation_conversion(m.funnel),
    "stage_conversion": lambda m: product.stage_conversion(m.funnel),
    # Subscription and payment reports
    "cancel_reasons": lambda m: billing.cancel_reasons(m.keyless_subscriptions, m.plans),
    "payment_success": lambda m: billing.payment_success(m.keyless_payments, m.plans),
    "revenue_by_month": lambda m: billing.revenue_by_month(m.keyless_payments),
    "revenue_by_segment_payments": lambda m: billing.revenue_by_segment_payments(m.keyless_payments, m.users),
    "revenue_yoy": lambda m: billing.revenue_yoy(m.keyless_payments),
    "arpu_payments": lambda m: billing.arpu_payments(m.keyless_payments),
    "subscription_churn_rate": lambda m: billing.subscription_churn_rate(m.keyless_subscriptions),
    "ltv_duration": lambda m: billing.ltv_duration(m.keyless_subscriptions),
    "longest_segments": lambda m: billing.longest_segments(m.keyless_subscriptions, m.users),
    # Checks and contracts
    "dq_unique": _check_query("unique"),
    "dq_not_null": _check_query("not_null"),
    "dq_accepted_values": _check_query("accepted_values"),
    "dq_relationships": _check_query("relationships"),
    "dq_expression": _check_query("expression"),
    "dq_email": _check_query("email"),
    "dq_unique_combo": _check_query("unique_combo"),
    "dq_failed_emails": _failed_emails,
    "enforce_contract": _contract_report,
    # Incremental runs
    "upsert_events": _upsert_events,
    "upsert_payments": _upsert_payments,
    "upsert_subscriptions": _upsert_subscriptions,
    "upsert_payments_directory": _upsert_with_directory,
    "incremental_mrr": _incremental_mrr,
    "incremental_mrr_carried": _carried_mrr,
    "full_refresh_subscriptions": _full_refresh,
    "append_columns": _appended_columns,
    "view_sink": _from_view,
    "dim_users_catalog": _user_catalog,
    "ordered_mrr_arr": lambda m: _in_order(revenue.mrr_arr(m.live_month_totals)),
    "ordered_cancel_reasons": lambda m: _in_order(billing.cancel_reasons(m.keyless_subscriptions, m.plans)),
    "milestone_quantiles": _milestone_quantiles,
    "users_by_span": _users_by_span,
    "users_rolling_year": _rolling_users,
    "funnel_from_batches": _carried_funnel,
    "retention_from_batches": _carried_retention,
    "freshness": _event_freshness,
}


def _build_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored build of all marts, and every declared check over it."""
    m = sample_marts(spark, sf_dir)
    root = scratch_folder(spark, "build")
    marts = build_marts(spark, m.raw, m.ctx, root)
    return check_build(spark, m.raw, m.ctx, root, marts, f"{root}/failures")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = (
        spark.readStream.schema(TEST_SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    return events_from_events(source)


def _streamed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = sample_marts(spark, sf_dir)
    root = scratch_folder(spark, "stream_events")
    table = mart_table(spark, root, "fct_events")
    # The feed up to a day first, then the whole feed again: the second run merges into stored days.
    feed = _event_stream(spark, sf_dir)
    for run, part in enumerate((feed.where(F.col("event_at") < F.lit(EVENTS_LOADED)), feed)):
        stream_events(part, m.users, table, f"{root}/checkpoint-{run}", m.ctx).awaitTermination()
    return comparable(table.read())


def _streamed_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of three deliveries with a restart between them; the last two bring events that are weeks late, and known ones again."""
    m = sample_marts(spark, sf_dir)
    root = scratch_folder(spark, "stream_late")
    table = mart_table(spark, root, "fct_events")
    early = F.col("event_at") < F.lit(EVENTS_LOADED)
    part = F.pmod(F.xxhash64("event_id"), F.lit(10))
    deliveries = (early & (part > 1), ~early | (part == 0), (part == 1) | (part == 5))
    for rows in deliveries:
        m.raw.events.where(rows).write.mode("append").parquet(f"{root}/feed")
        for run, name in ((stream_events, "checkpoint"), (stream_late_events, "late")):
            feed = spark.readStream.schema(m.raw.events.schema).parquet(f"{root}/feed")
            with durable_state(spark):
                run(feed, m.users, table, f"{root}/{name}", m.ctx).awaitTermination()
    return comparable(table.read())


def _streamed_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = sample_marts(spark, sf_dir)
    root = scratch_folder(spark, "stream_churn_monitor")
    table = tables.MonthTable(spark, f"{root}/cancellations", "sk_event_id", "event_month")
    churn_monitor(_event_stream(spark, sf_dir), m.users, table, f"{root}/checkpoint", m.ctx).awaitTermination()
    return comparable(churn_counts(table.read()))


def _batch(build: Callable[[Marts], DataFrame], late: bool = False) -> Query:
    return lambda spark, sf_dir: comparable(build(sample_marts(spark, sf_dir, late)))


def registered_queries() -> dict[str, Query]:
    queries = {name: _batch(build) for name, build in BATCH_QUERIES.items()}
    queries["revenue_by_segment"] = _batch(_segment_query, late=True)
    queries["build_checks"] = _build_checks
    queries["stream_events"] = _streamed_events
    queries["stream_late_events"] = _streamed_late_events
    queries["stream_churn_monitor"] = _streamed_churn
    return queries
