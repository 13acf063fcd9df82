"""Revenue reports over the MRR fact.

``live`` arguments are MRR fact rows without churn rows (``live_rows(fct_mrr)``),
or any rows that add up to the same totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlight.functions.dates import month_number_of_text
from ledgerlight.functions.ratios import percent

MOVEMENTS = ["new", "expansion", "contraction", "reactivation", "retained", "churned"]


def _sum_when(condition: Column, value: str) -> Column:
    return F.sum(F.when(condition, F.col(value)).otherwise(0))


def mrr_arr(live: DataFrame) -> DataFrame:
    """MRR and its yearly run rate per month."""
    totals = live.groupBy("mrr_month").agg(F.sum("mrr").alias("total_mrr"))
    return totals.withColumn("arr", F.col("total_mrr") * 12).orderBy("mrr_month")


def mrr_waterfall(mrr: DataFrame) -> DataFrame:
    """Signed MRR change and distinct users per month and movement."""
    return (
        mrr.groupBy("mrr_month", "mrr_movement_type")
        .agg(F.sum("mrr_delta").alias("mrr_impact"), F.count_distinct("user_id").alias("subscriber_count"))
        .orderBy("mrr_month", "mrr_movement_type")
    )


def _monthly_movements(mrr: DataFrame) -> DataFrame:
    movement = F.col("mrr_movement_type")
    return mrr.groupBy("mrr_month").agg(
        _sum_when(movement != "churned", "mrr").alias("active_mrr"),
        F.abs(_sum_when(movement == "churned", "mrr_delta")).alias("churned_mrr"),
        _sum_when(movement == "new", "mrr_delta").alias("new_mrr"),
        _sum_when(movement == "expansion", "mrr_delta").alias("expansion_mrr"),
        _sum_when(movement == "contraction", "mrr_delta").alias("contraction_mrr"),
    )


def revenue_churn_nrr(mrr: DataFrame) -> DataFrame:
    """Churned share of live MRR, and net retention as (new + expansion - churned) / live MRR."""
    active = F.col("active_mrr")
    kept = F.col("new_mrr") + F.col("expansion_mrr") - F.col("churned_mrr")
    return (
        _monthly_movements(mrr)
        .select(
            "mrr_month",
            "active_mrr",
            "churned_mrr",
            "new_mrr",
            "expansion_mrr",
            percent(F.col("churned_mrr"), active, 2).alias("revenue_churn_rate_pct"),
            percent(kept, active, 2).alias("net_revenue_retention_pct"),
        )
        .orderBy("mrr_month")
    )


def _months_ago(column: str, months: int) -> Column:
    """The value exactly so many calendar months before; NULL if that month has no row.

    The input holds one row per calendar month, so one ordered series stays small.
    """
    series = Window.partitionBy().orderBy(month_number_of_text(F.col("mrr_month")))
    return F.max(column).over(series.rangeBetween(-months, -months))


def nrr_standard(mrr: DataFrame) -> DataFrame:
    """Net retention on the month's beginning MRR: (beginning + expansion + contraction - churned) / beginning."""
    kept = F.col("beginning_mrr") + F.col("expansion_mrr") + F.col("contraction_mrr") - F.col("churned_mrr")
    return (
        _monthly_movements(mrr)
        .withColumn("beginning_mrr", _months_ago("active_mrr", 1))
        .select(
            "mrr_month",
            "beginning_mrr",
            "expansion_mrr",
            "contraction_mrr",
            "churned_mrr",
            percent(kept, F.col("beginning_mrr"), 2).alias("nrr_pct"),
        )
        .orderBy("mrr_month")
    )


def revenue_by_segment(mrr: DataFrame, users: DataFrame, plans: DataFrame, latest: DataFrame) -> DataFrame:
    """Live MRR and users of the latest month by channel, company size and plan.

    ``latest`` is a one-row table with the month; it becomes a scalar subquery
    and so a partition filter on a fact stored by month.
    """
    snapshot = mrr.where(F.col("mrr_month") == latest.select("mrr_month").scalar())
    per_user = snapshot.groupBy("sk_user_id", "sk_plan_id", "user_id").agg(F.sum("mrr").alias("mrr"))
    return (
        per_user.join(users.select("sk_user_id", "acquisition_channel", "company_size"), "sk_user_id")
        .join(plans.select("sk_plan_id", "plan_name"), "sk_plan_id")
        .groupBy("acquisition_channel", "company_size", "plan_name")
        .agg(F.sum("mrr").alias("total_mrr"), F.count_distinct("user_id").alias("active_subscribers"))
        .orderBy(F.desc("total_mrr"), "acquisition_channel", "company_size", "plan_name")
    )


def arpu_by_plan(live: DataFrame, plans: DataFrame) -> DataFrame:
    """MRR per distinct user, by plan and month."""
    arpu = F.try_divide(F.sum("mrr"), F.count_distinct("user_id"))
    return (
        live.join(plans.select("sk_plan_id", "plan_name"), "sk_plan_id")
        .groupBy("plan_name", "mrr_month")
        .agg(F.round(arpu, 2).alias("arpu"))
        .orderBy("mrr_month", "plan_name")
    )


def ltv_by_plan(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Mean MRR, churned share of all subscriptions, and their ratio, per plan.

    ``monthly_churn_rate_pct`` is the lifetime churned share; the name is kept for
    compatibility.
    """
    churn_rate = F.count_if("is_churned").cast("decimal(18,4)") / F.count("*")
    stats = (
        subscriptions.join(plans.select("sk_plan_id", "plan_name"), "sk_plan_id")
        .groupBy("plan_name")
        .agg(F.avg("mrr").alias("mean_mrr"), churn_rate.alias("churn_rate"))
    )
    return stats.select(
        "plan_name",
        F.round("mean_mrr", 2).alias("avg_mrr"),
        F.round(F.col("churn_rate") * 100, 2).alias("monthly_churn_rate_pct"),
        F.round(F.try_divide(F.col("mean_mrr"), F.col("churn_rate")), 2).alias("ltv"),
    ).orderBy(F.desc("ltv"), "plan_name")


def seasonality(live: DataFrame) -> DataFrame:
    """Live MRR by year and month of year."""
    totals = live.groupBy("mrr_month").agg(F.sum("mrr").alias("monthly_mrr"))
    return totals.select(
        F.substring("mrr_month", 1, 4).alias("revenue_year"),
        F.substring("mrr_month", 5, 2).alias("month_of_year"),
        "monthly_mrr",
    ).orderBy("revenue_year", "month_of_year")


def seasonality_avg(live: DataFrame) -> DataFrame:
    """Mean monthly MRR over the years, by month of year."""
    return (
        seasonality(live)
        .groupBy("month_of_year")
        .agg(F.round(F.avg("monthly_mrr"), 2).alias("avg_mrr_for_month"))
        .orderBy("month_of_year")
    )


def waterfall_wide(mrr: DataFrame) -> DataFrame:
    """One row per month with a column per movement; new and churned count MRR, the others the change."""
    movement = F.col("mrr_movement_type")
    value = F.when(movement.isin("new", "churned"), F.col("mrr")).otherwise(F.col("mrr_delta"))
    shown = ["new", "expansion", "contraction", "churned"]
    wide = mrr.select("mrr_month", "mrr_movement_type", value.alias("amount")).groupBy("mrr_month")
    pivoted = wide.pivot("mrr_movement_type", shown).agg(F.sum("amount"))
    return pivoted.select(
        "mrr_month", *[F.coalesce(F.col(m), F.lit(0)).cast("decimal(20,2)").alias(f"{m}_mrr") for m in shown]
    ).orderBy("mrr_month")


def churn_rate_beginning(mrr: DataFrame) -> DataFrame:
    """Churned MRR of a month in percent of the live MRR of the month before."""
    return (
        _monthly_movements(mrr)
        .withColumn("beginning_mrr", _months_ago("active_mrr", 1))
        .select(
            "mrr_month",
            "beginning_mrr",
            "churned_mrr",
            percent(F.col("churned_mrr"), F.col("beginning_mrr"), 2).alias("churn_rate_pct"),
        )
        .orderBy("mrr_month")
    )


def ltv_per_user(live: DataFrame) -> DataFrame:
    """MRR of a user summed over all active months."""
    return live.groupBy("user_id").agg(
        F.sum("mrr").alias("lifetime_mrr"), F.count_distinct("mrr_month").alias("active_months")
    )


def ltv_by_cohort(live: DataFrame) -> DataFrame:
    """The same per trial-start cohort, with the mean per user."""
    totals = live.groupBy("cohort_month").agg(
        F.sum("mrr").alias("lifetime_mrr"), F.count_distinct("user_id").alias("users")
    )
    return totals.withColumn(
        "mrr_per_user", F.round(F.try_divide(F.col("lifetime_mrr"), F.col("users")), 2)
    ).orderBy("cohort_month")


def mrr_yoy(live: DataFrame) -> DataFrame:
    """Live MRR of a month against the same month one year before."""
    monthly = live.groupBy("mrr_month").agg(F.sum("mrr").alias("total_mrr"))
    growth = percent(F.col("total_mrr") - F.col("mrr_last_year"), F.col("mrr_last_year"), 2)
    return (
        monthly.withColumn("mrr_last_year", _months_ago("total_mrr", 12))
        .select("mrr_month", "total_mrr", "mrr_last_year", growth.alias("yoy_growth_pct"))
        .orderBy("mrr_month")
    )
