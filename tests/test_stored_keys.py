"""Stored files without derived keys, and loads in parts."""

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlight.operators import contracts, mrr, staging, tables
from ledgerlight.operators.tables import MonthTable
from ledgerlight.sources.sample_feed import SAMPLE_CONTEXT, subscriptions_from_orders


MRR_ROWS = "sk_mrr_id string, subscription_id string, mrr_month string, user_id string, sk_user_id string"


def mrr_rows(spark, *values):
    rows = [(md5(f"{s}-{m}"), s, m, u, sk) for s, m, u, sk in values]
    return spark.createDataFrame(rows, MRR_ROWS)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_files_leave_out_keys_that_their_columns_give_again(spark, tmp_path):
    rows = mrr_rows(spark, ("s1", "202401", "u1", md5("u1")), ("s2", "202402", "u2", None), ("s3", "202402", None, "=x"))
    odd = spark.createDataFrame([("own", "s4", "202402", "u4", ""), (md5("s5-"), "s5", "", "u5", md5("u5"))], MRR_ROWS)
    noted = rows.unionByName(odd).withColumn("sk_user_id", F.col("sk_user_id").alias("sk_user_id", metadata={"comment": "the user"}))
    table = MonthTable(spark, str(tmp_path / "t"), "sk_mrr_id", "mrr_month", month_in_key=True)
    table.replace(noted)
    assert table.read().schema["sk_user_id"].metadata == {"comment": "the user"}
    expected = {tuple(r)[:2] + (r.mrr_month or None,) + tuple(r)[3:] for r in noted.collect()}
    assert {tuple(r) for r in table.read().select(noted.columns).collect()} == expected
    files = spark.read.parquet(str(tmp_path / "t" / "version=1"))
    held = {r.subscription_id: (r.sk_mrr_id, r.sk_user_id) for r in files.collect()}
    assert held == {"s1": (None, None), "s2": (None, ""), "s3": (None, "==x"), "s4": ("=own", "="), "s5": (f"={md5('s5-')}", None)}


def test_files_that_hold_their_keys_are_read_beside_those_that_do_not(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "t"), "sk_mrr_id", "mrr_month", month_in_key=True)
    old = mrr_rows(spark, ("s1", "202401", "u1", md5("u1")), ("s2", "202401", "u2", None), ("s3", "202402", "u3", "=x"))
    table.replace(old)
    for path in (tmp_path / "t" / "version=1").glob("mrr_month=*"):  # as they were written before
        old.where(F.col("mrr_month") == path.name[-6:]).drop("mrr_month").write.mode("overwrite").parquet(str(path))
    assert {tuple(r) for r in table.read().select(old.columns).collect()} == {tuple(r) for r in old.collect()}
    new = mrr_rows(spark, ("s3", "202402", "u3", md5("u3")), ("s4", "202402", "u4", None))
    table.upsert(new)
    expected = {tuple(r) for r in new.unionByName(old.where("subscription_id < 's3'")).collect()}
    assert {tuple(r) for r in table.read().select(old.columns).collect()} == expected

    # A key that a later batch appends is NULL in older rows, though their columns would give it.
    table = MonthTable(spark, str(tmp_path / "later"), "sk_mrr_id", "mrr_month", month_in_key=True)
    table.replace(old.drop("sk_user_id"))
    table.upsert(mrr_rows(spark, ("s9", "202403", "u9", md5("u9"))))
    assert {r.subscription_id: r.sk_user_id for r in table.read().collect()} == {"s1": None, "s2": None, "s3": None, "s9": md5("u9")}


def test_a_load_in_parts_publishes_all_rows_at_once(spark, tmp_path, monkeypatch):
    values = [(f"s{i}", f"2024{1 + i % 3:02d}", f"u{i % 7}" if i % 5 else None, None if i % 4 else md5("u")) for i in range(60)]
    rows = mrr_rows(spark, *values)
    table = MonthTable(spark, str(tmp_path / "t"), "sk_mrr_id", "mrr_month", month_in_key=True)
    contract = contracts.Contract("t", StructType().add("sk_mrr_id", "string", False).add("sk_user_id", "string", False), "sk_mrr_id", "row")
    for parts in (2, 20):  # of 20, some are empty
        with pytest.raises(contracts.ContractBroken, match="sk_user_id not_null: 45"):
            table.replace(rows, audit=contracts.WriteAudit(contract), cut_by="user_id", parts=parts)
    assert not table.exists()
    sizes, write = [], tables.write_files
    monkeypatch.setattr(tables, "write_files", lambda rows, *rest, **options: (sizes.append(rows.count()), write(rows, *rest, **options)))
    table.replace(rows, cut_by="user_id", parts=4)
    assert len(sizes) == 4 and sum(sizes) == 60 and max(sizes) < 60
    assert sorted(map(str, table.read().select(rows.columns).collect())) == sorted(map(str, rows.collect()))


def test_parts_of_the_fact_follow_its_rows_and_are_cut_below_its_windows(spark, monkeypatch):
    orders = [(i, i % 40, "FOP"[i % 3], 1000.0 + i, date(1996 + i % 4, 1 + i % 12, 1), "1-URGENT") for i in range(300)]
    raw = subscriptions_from_orders(spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"))
    subs = staging.stg_subscriptions(raw, SAMPLE_CONTEXT)
    rows = mrr.fct_mrr(subs.withColumn("sk_subscription_id", F.lit("")).withColumn("sk_plan_id", F.lit("")), SAMPLE_CONTEXT)
    assert mrr.write_parts(subs, SAMPLE_CONTEXT) == 1
    monkeypatch.setattr(mrr, "PART_ROWS", rows.count() // 3 + 1)
    assert mrr.write_parts(subs, SAMPLE_CONTEXT) == 3
    plan = rows.where(F.pmod(F.xxhash64("user_id"), F.lit(3)) == 1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("xxhash64") > plan.index("Window") and plan.index("xxhash64") > plan.index("Generate")
