"""The marts over one set of raw tables, each built on first use.

Every attribute is a lazy DataFrame: a report that touches two columns of a
mart scans, parses and shuffles only what those columns need. For a scheduled
run, write the marts once (``operators.tables``) and pass the stored tables to
the reports instead.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from ledgerlight.context import RunContext
from ledgerlight.operators import dimensions, facts, funnel, mrr, retention, staging
from ledgerlight.sources.readers import RawTables


class Marts:
    def __init__(self, raw: RawTables, ctx: RunContext) -> None:
        self.raw = raw
        self.ctx = ctx

    @cached_property
    def staged_events(self) -> DataFrame:
        return staging.stg_events(self.raw.events)

    @cached_property
    def staged_payments(self) -> DataFrame:
        return staging.stg_payments(self.raw.payments)

    @cached_property
    def staged_plans(self) -> DataFrame:
        return staging.stg_plans(self.raw.plans)

    @cached_property
    def staged_subscriptions(self) -> DataFrame:
        return staging.stg_subscriptions(self.raw.subscriptions, self.ctx)

    @cached_property
    def staged_users(self) -> DataFrame:
        return staging.stg_users(self.raw.users)

    @cached_property
    def users(self) -> DataFrame:
        return dimensions.dim_users(self.staged_users)

    @cached_property
    def plans(self) -> DataFrame:
        return dimensions.dim_plans(self.staged_plans)

    @cached_property
    def events(self) -> DataFrame:
        return facts.fct_events(self.staged_events, self.users)

    @cached_property
    def payments(self) -> DataFrame:
        return facts.fct_payments(self.staged_payments, self.users, self.plans)

    @cached_property
    def subscriptions(self) -> DataFrame:
        return facts.fct_subscriptions(self.staged_subscriptions, self.users, self.plans)

    @cached_property
    def hot_users(self) -> DataFrame | None:
        """Looked up once per set of raw tables; the only step here that runs a job."""
        return mrr.find_hot_users(self.staged_subscriptions, self.ctx)

    @cached_property
    def mrr(self) -> DataFrame:
        return mrr.fct_mrr(self.subscriptions, self.ctx, hot=self.hot_users)

    @cached_property
    def cohort_retention(self) -> DataFrame:
        counts = retention.cohort_retention_asof(self.staged_subscriptions, self.staged_events, self.ctx)
        return retention.fct_cohort_retention(counts)

    @cached_property
    def cohort_triangle(self) -> DataFrame:
        counts = retention.cohort_retention_triangle(self.staged_subscriptions, self.staged_events, self.ctx)
        return retention.fct_cohort_retention(counts)

    @cached_property
    def funnel(self) -> DataFrame:
        return funnel.fct_user_funnel(self.plain_events, self.keyless_subscriptions, self.users, self.ctx)

    # The same facts for reports that do not read the user key: no join with the users.

    @cached_property
    def keyless_events(self) -> DataFrame:
        return facts.fct_events(self.staged_events, None)

    @cached_property
    def plain_events(self) -> DataFrame:
        """The same rows for reports that read no JSON field: field by field, what is not read is not parsed."""
        return facts.fct_events(staging.stg_events(self.raw.events, single_pass_json=False), None)

    @cached_property
    def keyless_payments(self) -> DataFrame:
        return facts.fct_payments(self.staged_payments, None, self.plans)

    @cached_property
    def keyless_subscriptions(self) -> DataFrame:
        return facts.fct_subscriptions(self.staged_subscriptions, None, self.plans)

    @cached_property
    def keyless_mrr(self) -> DataFrame:
        return mrr.fct_mrr(self.keyless_subscriptions, self.ctx, hot=self.hot_users)

    @cached_property
    def live_months(self) -> DataFrame:
        """The live rows of the MRR fact without movement class.

        Partitioned by user before the explode, so that counting distinct users
        needs no shuffle of month rows; not so if a user is too large for a task.
        """
        spans = mrr.paid_spans(self.keyless_subscriptions, self.ctx)
        return mrr.active_months(spans if self.hot_users is not None else mrr.by_user(spans))

    @cached_property
    def live_month_totals(self) -> DataFrame:
        return mrr.active_mrr_by_month(self.keyless_subscriptions, self.ctx)
