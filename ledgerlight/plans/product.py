"""Product reports over the funnel, event and retention facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlight.functions.ratios import percent


def funnel_conversion(funnel: DataFrame) -> DataFrame:
    """Users at four milestones and their share of all users, as doubles."""
    counts = funnel.agg(
        F.count("*").alias("total_users"),
        F.count_if("has_verified_email").alias("email_verified"),
        F.count_if("has_started_trial").alias("trial_started"),
        F.count_if("has_activated").alias("activated"),
        F.count_if("has_converted").alias("converted"),
    )
    shares = {
        "email_verified_pct": "email_verified",
        "trial_started_pct": "trial_started",
        "activation_rate_pct": "activated",
        "conversion_rate_pct": "converted",
    }
    return counts.withColumns({
        name: F.round(F.try_divide(F.col(count), F.col("total_users")) * 100, 1) for name, count in shares.items()
    })


def funnel_dropoff(funnel: DataFrame) -> DataFrame:
    """Users per deepest stage and their share of all users."""
    stages = funnel.groupBy(
        F.col("highest_funnel_stage_order").alias("stage_order"),
        F.col("highest_funnel_stage_name").alias("stage_name"),
    ).agg(F.count("*").alias("users_stopped_here"))
    # At most one row per stage at this point, so a window over all of them stays small.
    everyone = F.sum("users_stopped_here").over(Window.partitionBy())
    return stages.withColumn("pct_of_all_users", percent(F.col("users_stopped_here"), everyone)).orderBy("stage_order")


def time_to_milestones(funnel: DataFrame, *, approximate: bool = False) -> DataFrame:
    """Median and mean days from signup to three milestones.

    The exact median keeps one counter per distinct number of days, a small map
    at any number of users.
    """
    spans = ["days_to_email_verified", "days_to_activation", "days_to_conversion"]
    median = F.percentile_approx if approximate else F.percentile
    return funnel.agg(
        *[median(span, 0.5).cast("double").alias(f"p50_{span}") for span in spans],
        *[F.avg(span).alias(f"avg_{span}") for span in spans],
    )


MILESTONE_SPANS = {"email_verified": "days_to_email_verified", "activation": "days_to_activation", "conversion": "days_to_conversion"}


def milestone_sketches(funnel: DataFrame, k: int = 4096) -> DataFrame:
    """Quantile sketches of the days to three milestones per signup month; a few kilobytes each, to be stored and merged.

    Up to ``k`` values a sketch is exact. Beyond that a quantile's rank is off by about 3.3 / k ** 0.9 (0.2 % for 4,096), with
    a confidence of 99 %, however many sketches were merged.
    """
    sketches = [F.kll_sketch_agg_bigint(F.col(days).cast("bigint"), F.lit(k)).alias(name) for name, days in MILESTONE_SPANS.items()]
    return funnel.groupBy("signup_month").agg(*sketches)


def milestone_quantiles(sketches: DataFrame, *by: Column | str, quantiles: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """Quantiles of the days to each milestone over the months that share ``by``: ``milestone``, ``users``, ``p50`` ...

    Only sketches are read. A milestone that nobody reached has no row.
    """
    grouped = sketches.select(*by, *MILESTONE_SPANS)
    keys = [c for c in grouped.columns if c not in MILESTONE_SPANS]
    merged = grouped.groupBy(*keys).agg(*[F.kll_merge_agg_bigint(name).alias(name) for name in MILESTONE_SPANS])
    rows = merged.select(*keys, F.inline(F.array(*[F.struct(F.lit(name).alias("milestone"), F.col(name).alias("sketch")) for name in MILESTONE_SPANS])))
    known = rows.withColumn("users", F.kll_sketch_get_n_bigint("sketch")).where("users > 0")
    shown = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(f"p{round(q * 100)}") for q in quantiles]
    return known.select(*keys, "milestone", "users", *shown)


def activation_retention(retention: DataFrame) -> DataFrame:
    """Mean retention per offset, activated against not activated users."""

    def mean_percent(rate: str):
        return F.round(F.avg(rate) * 100, 1)

    # A rate is NULL exactly where its group is empty, and avg skips NULLs.
    return (
        retention.groupBy("months_since_cohort")
        .agg(
            mean_percent("activated_retention_rate").alias("activated_retention_pct"),
            mean_percent("non_activated_retention_rate").alias("non_activated_retention_pct"),
            mean_percent("activation_retention_lift").alias("avg_retention_lift_pct"),
        )
        .orderBy("months_since_cohort")
    )


def converter_profile(funnel: DataFrame) -> DataFrame:
    """Users, speed and activation by converted or not, channel and company size."""
    return (
        funnel.groupBy("has_converted", "acquisition_channel", "company_size")
        .agg(
            F.count("*").alias("total_users"),
            F.round(F.avg("days_to_activation"), 1).alias("avg_days_to_activation"),
            F.round(F.avg("days_to_conversion"), 1).alias("avg_days_to_conversion"),
            percent(F.count_if("has_activated"), F.count("*")).alias("activation_rate_pct"),
        )
        .orderBy(F.desc("has_converted"), F.desc("total_users"), "acquisition_channel", "company_size")
    )


def retention_heatmap(retention: DataFrame) -> DataFrame:
    """Retention against the benchmark per cohort and offset, in percent."""
    return retention.select(
        "cohort_month",
        "months_since_cohort",
        "cohort_size",
        "retained_users",
        F.round(F.col("retention_rate") * 100, 1).alias("retention_pct"),
        F.round(F.col("retention_benchmark") * 100, 1).alias("benchmark_pct"),
        F.round(F.col("retention_vs_benchmark") * 100, 1).alias("vs_benchmark_pct"),
    ).orderBy("cohort_month", "months_since_cohort")


def channel_conversion(funnel: DataFrame) -> DataFrame:
    """Conversion and activation rate by channel and company size."""
    return (
        funnel.where(F.col("acquisition_channel").isNotNull())
        .groupBy("acquisition_channel", "company_size")
        .agg(
            F.count("*").alias("total_users"),
            percent(F.count_if("has_converted"), F.count("*")).alias("conversion_rate_pct"),
            percent(F.count_if("has_activated"), F.count("*")).alias("activation_rate_pct"),
            F.round(F.avg("days_to_activation"), 1).alias("avg_days_to_activation"),
        )
        .orderBy(F.desc("conversion_rate_pct"), "acquisition_channel", "company_size")
    )


def funnel_stage_users(events: DataFrame) -> DataFrame:
    """Distinct users per funnel stage and the change to the stage before."""
    stages = (
        events.where("is_funnel_event")
        .groupBy("funnel_stage_order", "event_name")
        .agg(F.count_distinct("user_id").alias("users"))
    )
    # One row per funnel stage.
    before = F.lag("users").over(Window.partitionBy().orderBy("funnel_stage_order"))
    return stages.withColumn("users_stage_before", before).withColumns({
        "drop_off": F.col("users_stage_before") - F.col("users"),
        "step_conversion_pct": percent(F.col("users"), F.col("users_stage_before")),
    }).orderBy("funnel_stage_order")


def activation_latency(events: DataFrame, users: DataFrame) -> DataFrame:
    """Days from signup to the first activation, one row per activated user."""
    first = events.where("is_activation_event").groupBy("user_id").agg(F.min("event_date").alias("first_activation_date"))
    return users.select("user_id", "signed_up_at").join(first, "user_id").withColumn(
        "days_to_activation", F.date_diff("first_activation_date", "signed_up_at")
    )


def feature_conversion_pivot(events: DataFrame) -> DataFrame:
    """Users of each feature, split by whether they ever converted.

    Both sides of the join are distinct, so a user with many events meets it
    with one row per feature.
    """
    used = events.where(F.col("feature_used").isNotNull()).select("user_id", "feature_used").distinct()
    converted = events.where("is_conversion_event").select("user_id").distinct().withColumn("converted", F.lit("converted"))
    labelled = used.join(converted, "user_id", "left").fillna("not_converted", ["converted"])
    return (
        labelled.groupBy("feature_used")
        .pivot("converted", ["converted", "not_converted"])
        .agg(F.count("user_id"))
        .fillna(0, ["converted", "not_converted"])
        .withColumn(
            "conversion_pct", percent(F.col("converted"), F.col("converted") + F.col("not_converted"))
        )
        .orderBy("feature_used")
    )


def activation_conversion(funnel: DataFrame) -> DataFrame:
    """Conversion by activated or not."""
    return (
        funnel.groupBy("has_activated")
        .agg(
            F.count("*").alias("total_users"),
            F.avg(F.col("has_converted").cast("int")).alias("conversion_rate"),
            F.avg("days_to_conversion").alias("avg_days_to_conversion"),
        )
        .orderBy("has_activated")
    )


def stage_conversion(funnel: DataFrame) -> DataFrame:
    """Users and converted users per deepest stage."""
    return (
        funnel.groupBy("highest_funnel_stage_order", "highest_funnel_stage_name")
        .agg(F.count("*").alias("users_reached"), F.count_if("has_converted").alias("converted"))
        .orderBy("highest_funnel_stage_order")
    )
