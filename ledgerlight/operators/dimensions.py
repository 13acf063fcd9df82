"""User and plan dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

USER_COLUMNS = [
    "sk_user_id",
    "user_id",
    "company_name",
    "company_size",
    "company_size_order",
    "industry",
    "acquisition_channel",
    "country",
    "is_deleted",
    "signed_up_at",
    "signup_month",
    "_stg_loaded_at",
]


def dim_users(staged_users: DataFrame) -> DataFrame:
    """One row per user. The email (personal data) and the raw size stay in staging."""
    return staged_users.select(USER_COLUMNS)


def dim_plans(staged_plans: DataFrame) -> DataFrame:
    """One row per plan, with the monthly price of an annual contract and its discount."""
    twelve_months = F.col("monthly_price") * 12
    discount = (1 - F.try_divide(F.col("annual_price"), twelve_months)) * 100
    return staged_plans.select(
        "sk_plan_id",
        "plan_id",
        "plan_name",
        "tier",
        "max_seats",
        "features",
        "_stg_loaded_at",
        "monthly_price",
        "annual_price",
        F.round(F.col("annual_price") / 12, 2).cast("decimal(10,2)").alias("annual_monthly_equivalent"),
        F.round(discount, 1).cast("decimal(10,1)").alias("annual_discount_pct"),
    )
