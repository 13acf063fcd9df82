"""Cohort retention by trial-start month, split by activation.

Users are folded to one row per (cohort, user) before the activation join, so a
user with many subscriptions crosses the network once. What is kept of a user
is the number of months survived; the cohort tables are then counts over a few
hundred rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.context import RunContext
from ledgerlight.functions.dates import month_number, month_number_of_text

HORIZON = 12
RATE = "decimal(10,4)"

# Expected retention from month 0, 1-3, 4-6 and 7-12, and cohort size classes.
BENCHMARKS = [((0, 0), "1.00"), ((1, 3), "0.70"), ((4, 6), "0.50"), ((7, 12), "0.40")]
SIZE_BUCKETS = [(10, "xs (< 10)"), (50, "small (10–49)"), (200, "medium (50–199)")]
LARGEST_BUCKET = "large (200+)"


def _cohort_users(subscriptions: DataFrame, events: DataFrame, ctx: RunContext) -> DataFrame:
    """One row per cohort, age and user: months survived and whether the user ever activated."""
    born = month_number_of_text(F.col("cohort_month"))
    age = (month_number(ctx.today()) - born).cast("bigint")
    # The last k for which the end date still reaches cohort start + k months.
    survived = month_number(F.col("effective_end_date")) - born
    users = (
        subscriptions.where(F.col("cohort_month").isNotNull())
        .withColumns({"age": age, "survived": survived})
        .groupBy("cohort_month", "age", "user_id")
        .agg(F.max("survived").alias("survived"))
    )
    activated = events.where("is_activation_event").select("user_id").distinct().withColumn("has_activated", F.lit(True))
    return users.join(activated, "user_id", "left").withColumn("has_activated", F.col("has_activated").isNotNull())


def _rate(kept: str, total: str) -> Column:
    kept_col, total_col = F.col(kept).cast("decimal(18,0)"), F.col(total).cast("decimal(18,0)")
    return F.round(F.try_divide(kept_col, total_col), 4).cast(RATE)


def with_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns({
        "retention_rate": _rate("retained_users", "total_users"),
        "activated_retention_rate": _rate("activated_retained_users", "activated_total_users"),
        "non_activated_retention_rate": _rate("non_activated_retained_users", "non_activated_total_users"),
    })


def cohort_retention_asof(subscriptions: DataFrame, events: DataFrame, ctx: RunContext) -> DataFrame:
    """One row per cohort: its active subscriptions observed at ``as_of``, up to 12 months of age."""
    users = _cohort_users(subscriptions.where("is_active"), events, ctx).where(F.col("age") <= HORIZON)
    # A NULL user forms no user, but its cohort keeps its row.
    known, kept, activated = F.col("user_id").isNotNull(), F.col("survived") >= F.col("age"), F.col("has_activated")
    counts = (
        users.groupBy("cohort_month", F.col("age").alias("months_since_cohort"))
        .agg(
            F.count_if(known).alias("total_users"),
            F.count_if(known & kept).alias("retained_users"),
            F.count_if(known & activated).alias("activated_total_users"),
            F.count_if(known & activated & kept).alias("activated_retained_users"),
            F.count_if(known & ~activated).alias("non_activated_total_users"),
            F.count_if(known & ~activated & kept).alias("non_activated_retained_users"),
        )
    )
    return with_rates(counts)


def cohort_retention_triangle(subscriptions: DataFrame, events: DataFrame, ctx: RunContext) -> DataFrame:
    """One row per cohort and offset 0..min(12, age), over every started subscription.

    Users are first counted per (cohort, activated, months survived); only that
    small table is spread over the offsets.
    """
    started = subscriptions.where(F.col("subscription_start_date").isNotNull())
    users = _cohort_users(started, events, ctx).where(F.col("user_id").isNotNull() & (F.col("age") >= 0))
    survivors = users.groupBy(
        "cohort_month", "age", "has_activated", F.least(F.col("survived"), F.lit(HORIZON)).alias("survived")
    ).agg(F.count("*").alias("users"))
    offsets = survivors.withColumn(
        "months_since_cohort", F.explode(F.sequence(F.lit(0), F.least(F.col("age").cast("int"), F.lit(HORIZON))))
    )

    def counted(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("users")).otherwise(0))

    kept, activated = F.col("survived") >= F.col("months_since_cohort"), F.col("has_activated")
    counts = offsets.groupBy("cohort_month", F.col("months_since_cohort").cast("bigint").alias("months_since_cohort")).agg(
        F.sum("users").alias("total_users"),
        counted(kept).alias("retained_users"),
        counted(activated).alias("activated_total_users"),
        counted(activated & kept).alias("activated_retained_users"),
        counted(~activated).alias("non_activated_total_users"),
        counted(~activated & kept).alias("non_activated_retained_users"),
    )
    return with_rates(counts)


def fct_cohort_retention(retention: DataFrame) -> DataFrame:
    """Retention rows with cohort size, lift, labels and the gap to the benchmark.

    Every row of a cohort counts the same users, so the cohort size is the row's
    own total and needs no self join.
    """
    offset, size = F.col("months_since_cohort"), F.col("total_users")
    benchmark = F.lit(None).cast("decimal(10,2)")
    for (low, high), expected in reversed(BENCHMARKS):
        benchmark = F.when(offset.between(low, high), F.lit(expected).cast("decimal(10,2)")).otherwise(benchmark)
    bucket = F.lit(LARGEST_BUCKET)
    for below, label in reversed(SIZE_BUCKETS):
        bucket = F.when(size < below, label).otherwise(bucket)
    label = F.when(offset == 0, "Month 0 (start)").otherwise(F.concat(F.lit("Month "), offset.cast("string")))
    lift = F.round(F.col("activated_retention_rate") - F.col("non_activated_retention_rate"), 4)
    return retention.select(
        "cohort_month",
        size.alias("cohort_size"),
        "months_since_cohort",
        "total_users",
        "retained_users",
        "retention_rate",
        "activated_total_users",
        "activated_retained_users",
        "activated_retention_rate",
        "non_activated_total_users",
        "non_activated_retained_users",
        "non_activated_retention_rate",
        lift.cast(RATE).alias("activation_retention_lift"),
        label.alias("period_label"),
        bucket.alias("cohort_size_bucket"),
        benchmark.alias("retention_benchmark"),
        F.round(F.col("retention_rate") - benchmark, 4).cast(RATE).alias("retention_vs_benchmark"),
    )
