"""The shape of the physical plans, and the registry against its SQL."""

import re
from glob import glob
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from oracle import oracle_queries
from ledgerlight.operators import facts, funnel, mrr
from ledgerlight.plans.registry import BATCH_QUERIES, comparable, registered_queries, sample_marts


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_no_query_compares_every_row_with_every_row(spark, sf_dir):
    marts = sample_marts(spark, sf_dir)
    for name in BATCH_QUERIES:
        if not name.startswith("dq_"):
            plan = plan_of(BATCH_QUERIES[name](marts))
            assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, name


def test_no_query_leaves_the_jvm(spark, sf_dir):
    marts = sample_marts(spark, sf_dir)
    for name in ("fct_events", "fct_mrr", "fct_user_funnel", "cohort_retention_triangle"):
        plan = plan_of(BATCH_QUERIES[name](marts))
        assert not re.search("Python|Pandas|Arrow", plan), name


def test_scans_read_only_the_columns_in_use(spark, sf_dir):
    plan = plan_of(BATCH_QUERIES["payment_success"](sample_marts(spark, sf_dir)))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan
    assert "customer.parquet" not in plan


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("cast(id as string) payment_id", "date'2024-01-01' payment_date").write.parquet(
        str(tmp_path / "p")
    )
    rows = spark.read.parquet(str(tmp_path / "p")).where(F.col("payment_date") >= F.lit("2024-01-02").cast("date"))
    assert "GreaterThanOrEqual(payment_date,2024-01-02)" in plan_of(rows)


def test_mrr_shuffles_subscriptions_and_not_months(spark, sf_dir):
    plan = plan_of(sample_marts(spark, sf_dir).keyless_mrr)
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Scan parquet") == 1
    # Plans read bottom up: the shuffle lies below the explode.
    assert plan.index("Generate posexplode") < plan.index("Exchange hashpartitioning")


def test_distinct_users_reuse_the_partitioning_by_user(spark, sf_dir):
    plan = plan_of(BATCH_QUERIES["arpu_by_plan"](sample_marts(spark, sf_dir)))
    shuffled = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(shuffled) == 2 and not any("user_id" in keys and "mrr_month" in keys for keys in shuffled)


def test_split_lane_is_cut_by_month_and_start(spark, sf_dir):
    marts = sample_marts(spark, sf_dir)
    hot = mrr.find_hot_users(marts.keyless_subscriptions, marts.ctx, min_rows=1)
    counted = mrr.counted_subscriptions(marts.keyless_subscriptions, marts.ctx)
    rows = mrr.fct_mrr(marts.keyless_subscriptions, marts.ctx, hot=hot)
    assert hot.count() > 0
    assert "id_block" in plan_of(mrr.months_with_previous(counted, hot))
    assert comparable(rows).exceptAll(comparable(marts.keyless_mrr)).count() == 0
    assert rows.count() == marts.keyless_mrr.count()


def test_a_user_with_a_third_of_all_payments_is_split(spark):
    payments = spark.range(300_000).selectExpr(
        "cast(id as string) payment_id", "if(id % 3 = 0, 'hot', cast(id as string)) user_id",
        "'plan_starter' plan_id", "repeat('x', 100) currency",
    )
    users = spark.range(300_000).selectExpr("if(id = 0, 'hot', cast(id as string)) user_id", "uuid() sk_user_id")
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in options}
    try:
        for name, value in options.items():
            spark.conf.set(name, value)
        joined = facts.with_user_key(payments, users)
        rows = joined.collect()
        final = plan_of(joined)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert len(rows) == 300_000
    assert "skew=true" in final or "(skew" in final.lower()


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["mrr_month", "mrr_movement_type", "mrr_impact", "subscriber_count"]
    assert not rows.isEmpty()


def test_every_query_has_its_sql():
    assert set(registered_queries()) == set(oracle_queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for path in glob(f"{sf_dir}/*.parquet"):
        connection.sql(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return connection


def plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        tuple(f"{row[i]:.6f}" if isinstance(row[i], float) else str(row[i]) for i in order) for row in rows
    )


@pytest.mark.parametrize("name", [
    "mrr_waterfall", "arpu_by_plan", "revenue_by_segment", "fct_user_funnel", "retention_heatmap_triangle",
    "cancel_reasons", "payment_success", "upsert_events",
])
def test_results_equal_the_sql(spark, sf_dir, database, name):
    mine = queries()[name](spark, sf_dir)
    theirs = database.sql(oracle_sql()[name])
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert plain(mine.columns, [tuple(r) for r in mine.collect()]) == plain(theirs.columns, theirs.fetchall())


def test_milestones_are_not_sorted(spark, sf_dir):
    milestones = funnel.user_milestones(sample_marts(spark, sf_dir).staged_events)
    assert "SortAggregate" not in plan_of(milestones)


def test_every_source_row_becomes_an_event(spark, sf_dir):
    events = sample_marts(spark, sf_dir).raw.events
    assert events.count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert events.where("event_name IS NULL").count() == 0
