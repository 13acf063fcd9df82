"""Readers for the raw tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlight.sources.schemas import PLAN_SEED, RAW_PLAN_COLUMNS, RAW_SCHEMAS


@dataclass(frozen=True)
class RawTables:
    """The five inputs of the pipeline."""

    events: DataFrame
    payments: DataFrame
    subscriptions: DataFrame
    users: DataFrame
    plans: DataFrame


def read_parquet_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One raw table from ``root/name`` with its declared schema (no inference pass)."""
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{root}/{name}")


def read_catalog_table(spark: SparkSession, schema: str, name: str) -> DataFrame:
    """One raw table from the session catalog."""
    return spark.table(f"{schema}.{name}")


def read_csv_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A raw table kept as CSV with a header line and quoted commas."""
    return spark.read.schema(RAW_SCHEMAS[name]).option("header", True).option("enforceSchema", False).csv(path)


def plan_seed(spark: SparkSession) -> DataFrame:
    """The four-row plan catalogue."""
    rows = ", ".join(str(row) for row in PLAN_SEED)
    return spark.sql(f"SELECT * FROM VALUES {rows}").toDF(*RAW_PLAN_COLUMNS)


def read_raw(spark: SparkSession, root: str, plans_csv: str | None = None) -> RawTables:
    """All raw tables below ``root``; the plan catalogue from CSV if given, else the seed."""
    plans = read_csv_table(spark, plans_csv, "plans") if plans_csv else plan_seed(spark)
    return RawTables(
        events=read_parquet_table(spark, root, "events"),
        payments=read_parquet_table(spark, root, "payments"),
        subscriptions=read_parquet_table(spark, root, "subscriptions"),
        users=read_parquet_table(spark, root, "users"),
        plans=plans,
    )
