"""A scheduled run: write the marts, facts incrementally where they already exist, then check them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlight.context import RunContext
from ledgerlight.operators import checks, contracts, dimensions, facts, funnel, mrr, retention, staging
from ledgerlight.operators.contracts import CONTRACTS
from ledgerlight.operators.mrr_carry import CarriedState
from ledgerlight.operators.tables import MonthTable, changing_subscriptions, replace_table
from ledgerlight.plans.check_list import declared_checks
from ledgerlight.session import shuffle_files_dropped
from ledgerlight.sources.readers import RawTables

# Marts of large feeds that deliver the last days again: stored by the days of this column. Payments
# come once a month per subscription, so their days would be many small files.
DAY_COLUMNS = {"fct_events": "event_date"}

# Mart -> (unique key, month column, whether the key contains the month).
STORED_MARTS = {
    "dim_users": ("sk_user_id", "signup_month", False),
    "fct_events": ("sk_event_id", "event_month", False),
    "fct_payments": ("sk_payment_id", "payment_month", False),
    "fct_subscriptions": ("sk_subscription_id", "cohort_month", False),
    "fct_mrr": ("sk_mrr_id", "mrr_month", True),
    "fct_cohort_retention": ("cohort_month", "cohort_month", True),
    "fct_user_funnel": ("sk_user_id", "signup_month", False),
}


def mart_table(spark: SparkSession, root: str, name: str) -> MonthTable:
    key, month, month_in_key = STORED_MARTS[name]
    return MonthTable(
        spark, f"{root}/{name}", key, month, month_in_key=month_in_key, day=DAY_COLUMNS.get(name),
        month_comment=contracts.COMMENTS[month],
    )


def _audited(name: str) -> contracts.WriteAudit:
    return contracts.WriteAudit(CONTRACTS[name])


def _replace(spark: SparkSession, root: str, name: str, rows: DataFrame) -> DataFrame:
    table = mart_table(spark, root, name)
    table.replace(contracts.enforce(rows, CONTRACTS[name]), audit=_audited(name))
    return table.read()


def _replace_plans(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """The plan catalogue: a handful of rows without a month."""
    shaped = contracts.enforce(rows, CONTRACTS["dim_plans"])
    contracts.audit(shaped, CONTRACTS["dim_plans"])
    replace_table(shaped, f"{root}/dim_plans")
    return spark.read.parquet(f"{root}/dim_plans")


def _recent(raw: DataFrame, column: str, table: MonthTable, day: str, ctx: RunContext) -> DataFrame:
    """Raw rows from the lookback on, as a literal filter the raw scan can prune with."""
    newest = table.newest_day(day)
    if newest is None:
        return raw
    return raw.where(F.col(column) >= F.lit(newest - timedelta(days=ctx.lookback_days)))


def build_marts(
    spark: SparkSession,
    raw: RawTables,
    ctx: RunContext,
    root: str,
    *,
    full_refresh: bool = False,
    replace_months: bool = False,
    failures: str | None = None,
    by_table: bool = False,
) -> dict[str, DataFrame]:
    """Write all marts below ``root`` and return them as stored.

    Events and payments take the lookback days again, subscriptions the ones that
    can still change, MRR the lookback months, compared with each user's last stored row before these (``CarriedState``). ``full_refresh`` rebuilds all.
    Written rows are audited against their contract before they become visible.
    ``replace_months=True`` drops the stored MRR of the months that are taken again, so
    months that a subscription lost vanish. With ``failures`` all declared checks run after the
    build, rows that fail go below that folder (``by_table``: in one scan per table, see ``check_tables``), and a failed check of severity ``error`` ends the run.
    """
    users = _replace(spark, root, "dim_users", dimensions.dim_users(staging.stg_users(raw.users)))
    plans = _replace_plans(spark, root, dimensions.dim_plans(staging.stg_plans(raw.plans)))

    def load(name: str, rows: Callable[[MonthTable, bool], DataFrame]) -> DataFrame:
        table = mart_table(spark, root, name)
        incremental = table.exists() and not full_refresh
        shaped = contracts.enforce(rows(table, incremental), CONTRACTS[name])
        if incremental:
            table.upsert(shaped, replace_months=replace_months and name == "fct_mrr", audit=_audited(name))
        elif name == "fct_mrr":
            table.replace(shaped, audit=_audited(name), cut_by="user_id", parts=mrr.write_parts(marts["fct_subscriptions"], ctx))
        else:
            table.replace(shaped, audit=_audited(name))
        return table.read()

    def events(table: MonthTable, incremental: bool) -> DataFrame:
        source = _recent(raw.events, "event_at", table, "event_date", ctx) if incremental else raw.events
        return facts.fct_events(staging.stg_events(source), users)

    def payments(table: MonthTable, incremental: bool) -> DataFrame:
        source = _recent(raw.payments, "payment_date", table, "payment_date", ctx) if incremental else raw.payments
        return facts.fct_payments(staging.stg_payments(source), users, plans)

    def subscriptions(table: MonthTable, incremental: bool) -> DataFrame:
        staged = staging.stg_subscriptions(raw.subscriptions, ctx)
        return facts.fct_subscriptions(changing_subscriptions(staged, ctx) if incremental else staged, users, plans)

    marts = {"dim_users": users, "dim_plans": plans}
    marts["fct_events"] = load("fct_events", events)
    marts["fct_payments"] = load("fct_payments", payments)
    marts["fct_subscriptions"] = load("fct_subscriptions", subscriptions)
    hot = mrr.find_hot_users(marts["fct_subscriptions"], ctx)

    def months(table: MonthTable, incremental: bool) -> DataFrame:
        if incremental:
            return CarriedState(spark, root, table).rows(marts["fct_subscriptions"], ctx, hot=hot)
        return mrr.fct_mrr(marts["fct_subscriptions"], ctx, hot=hot)

    marts["fct_mrr"] = load("fct_mrr", months)
    counts = retention.cohort_retention_asof(marts["fct_subscriptions"], marts["fct_events"], ctx)
    marts["fct_cohort_retention"] = _replace(
        spark, root, "fct_cohort_retention", retention.fct_cohort_retention(counts)
    )
    # The stage count is NOT NULL by contract, so users without funnel events get 0 here.
    marts["fct_user_funnel"] = _replace(
        spark,
        root,
        "fct_user_funnel",
        funnel.fct_user_funnel(marts["fct_events"], marts["fct_subscriptions"], users, ctx, zero_stages=True),
    )
    if failures is not None:
        checks.require(check_build(spark, raw, ctx, root, marts, failures, by_table=by_table))
    return marts


def check_build(
    spark: SparkSession, raw: RawTables, ctx: RunContext, root: str, marts: Mapping[str, DataFrame], failures: str,
    *, by_table: bool = False,
) -> DataFrame:
    """Run all declared checks over a finished build: raw tables, staging, intermediate results and marts.

    Staging is written once below ``root``, so that no check derives it again.
    """
    layers = {
        "stg_events": staging.stg_events(raw.events),
        "stg_payments": staging.stg_payments(raw.payments),
        "stg_plans": staging.stg_plans(raw.plans),
        "stg_subscriptions": staging.stg_subscriptions(raw.subscriptions, ctx),
        "stg_users": staging.stg_users(raw.users),
    }
    tables = {"raw_events": raw.events, "raw_payments": raw.payments, "raw_subscriptions": raw.subscriptions, "raw_users": raw.users}
    for name, rows in layers.items():
        replace_table(rows, f"{root}/staging/{name}")
        tables[name] = spark.read.parquet(f"{root}/staging/{name}")
    asof = retention.cohort_retention_asof(tables["stg_subscriptions"], tables["stg_events"], ctx)
    return check_tables(spark, tables | {"int_cohort_retention": asof} | dict(marts), failures, by_table=by_table)


def check_tables(spark: SparkSession, tables: Mapping[str, DataFrame], failures: str, *, by_table: bool = False) -> DataFrame:
    """Run every declared check the given tables allow; failing rows go below ``failures``.

    With ``by_table`` the rows that break any row-level check of a table are written in one scan (``store_failing_rows``);
    otherwise each failed check has a folder and a job of its own. The result has one row per check. Pass it to ``checks.require`` to end a run
    on errors; warnings only show.
    """
    chosen = [c for c in declared_checks() if c.table in tables and (not c.parent or c.parent in tables)]
    with shuffle_files_dropped(spark):
        results = checks.run_checks(tables, chosen, counted=True)
        # One row per check, kept so that the checks run once.
        found = results.collect()
    failed = {(r.table_name, r.check_type, r.column_name, r.detail) for r in found if r.failures}
    broken = {c.table for c in chosen if (c.table, c.kind, c.column_name, c.detail) in failed and c.kind in checks.ROW_KINDS}
    if by_table:
        for table in dict.fromkeys(c.table for c in chosen):
            # A table that breaks nothing has no rows to write, only those of an earlier run to take away.
            rows = tables if table in broken else {**tables, table: tables[table].limit(0)}
            checks.store_failing_rows(table, rows, chosen, failures)
    for check in chosen:
        if by_table and check.kind in checks.ROW_KINDS:
            continue
        if (check.table, check.kind, check.column_name, check.detail) in failed:
            checks.store_failures(check, tables, failures)
        else:
            checks.clear_failures(check, spark, failures)
    return spark.createDataFrame(found, results.schema)
