from datetime import date
from decimal import Decimal

import pytest
from fixtures import event, subscription, table
from pyspark.errors import PySparkException

from ledgerlight.context import RunContext
from ledgerlight.operators import dimensions, staging
from ledgerlight.sources.readers import plan_seed, read_catalog_table, read_csv_table, read_raw

CTX = RunContext(as_of=date(2024, 3, 15))


def test_event_names_stages_and_flags(spark):
    raw = table(spark, "events", [
        event("1", "u", " Activated_", "2024-01-31 23:59:59"),
        event("2", "u", "feature_Core_used", "2024-01-01"),
        event("3", "u", "invited_team_member", "2024-01-01"),
        event("4", "u", "something else", "2024-01-01"),
        event("5", "u", None, "2024-01-01"),
    ])
    rows = {r.event_id: r for r in staging.stg_events(raw).collect()}
    assert (rows["1"].event_name, rows["1"].funnel_stage_order) == ("activated", 6)
    assert rows["1"].is_activation_event and rows["1"].is_funnel_event
    assert (rows["1"].event_date, rows["1"].event_month) == (date(2024, 1, 31), "202401")
    assert rows["2"].funnel_stage_order == 7
    assert rows["3"].funnel_stage_order == 9 and not rows["3"].is_funnel_event
    assert rows["4"].funnel_stage_order == staging.UNKNOWN_CODE
    assert rows["5"].funnel_stage_order == staging.UNKNOWN_CODE and rows["5"].is_funnel_event is None


def test_ids_are_trimmed_kept_if_empty_and_dropped_if_null(spark):
    raw = table(spark, "events", [event(" e1", "u", "x", "2024-01-01"), event("e1", "u", "x", "2024-01-01"),
                                  event("", "u", "x", "2024-01-01"), event(None, "u", "x", "2024-01-01")])
    rows = staging.stg_events(raw).collect()
    assert sorted(r.event_id for r in rows) == ["", "e1", "e1"]
    # The key hashes the id as delivered, so the two spellings differ.
    assert len({r.sk_event_id for r in rows}) == 3


def test_json_fields_by_either_parse(spark):
    good = '{"source":"web","action":"a","feature":7,"from_plan":null,"reason":{"code":1}}'
    raw = table(spark, "events", [
        event("1", "u", "x", "2024-01-01", properties=good),
        event("2", "u", "x", "2024-01-01", properties="{bad json"),
        event("3", "u", "x", "2024-01-01"),
    ])
    for single_pass in (False, True):
        rows = {r.event_id: r for r in staging.stg_events(raw, single_pass_json=single_pass).collect()}
        first = rows["1"]
        assert (first.event_source, first.activation_action, first.feature_used) == ("web", "a", "7")
        assert first.upgraded_from_plan is None and first.churn_reason == '{"code":1}'
        for event_id in ("2", "3"):
            assert all(rows[event_id][c] is None for c in staging.JSON_FIELDS)


def test_repeated_json_keys_by_either_parse(spark):
    texts = ['{"source":"a","source":"b","reason":"r"}', '{"so\\u0075rce":"a","source":"b"}', '{"reason":"source","action":"\\"x"}']
    raw = table(spark, "events", [event(str(i), "u", "x", "2024-01-01", properties=t) for i, t in enumerate(texts)])
    found = [
        {r.event_id: tuple(r[c] for c in staging.JSON_FIELDS) for r in staging.stg_events(raw, single_pass_json=s).collect()}
        for s in (False, True)
    ]
    assert found[0] == found[1]
    assert found[0]["0"][0] == "a"


def test_payment_monthly_share(spark):
    base = {"user_id": "u", "status": "Succeeded", "payment_date": "2024-01-31", "period_start": "2024-01-31",
            "period_end": "2024-02-29", "currency": " gbp"}
    raw = table(spark, "payments", [
        {**base, "payment_id": "a", "billing_cycle": " Annual ", "amount": "1238"},
        {**base, "payment_id": "m", "billing_cycle": "monthly", "amount": "129"},
        {**base, "payment_id": "x", "billing_cycle": "weekly", "amount": "7"},
    ])
    rows = {r.payment_id: r for r in staging.stg_payments(raw).collect()}
    assert rows["a"].mrr_contribution == Decimal("103.17")
    assert rows["m"].mrr_contribution == Decimal("129.00")
    assert rows["x"].mrr_contribution == Decimal("7.00")
    assert rows["a"].currency == "GBP" and rows["a"].is_revenue_recognised and rows["a"].days_in_period == 29


def test_subscription_flags_and_dates(spark):
    raw = table(spark, "subscriptions", [
        subscription("in", "u", "2023-01-05", "2023-12-30", 49, "cancelled", cancel_reason="too_Expensive"),
        subscription("out", "u", "2023-01-05", "2023-12-31", 49, "cancelled"),
        subscription("nodate", "u", "2023-01-05", None, 49, "cancelled"),
        subscription("open", "u", "2024-03-01", None, 49, " Active"),
        subscription("trial", "u", None, None, 49, "trial_expired"),
    ])
    rows = {r.subscription_id: r for r in staging.stg_subscriptions(raw, CTX).collect()}
    assert [rows[i].is_spike_churn for i in ("in", "out", "nodate", "open")] == [True, False, None, False]
    assert rows["in"].cancel_reason == "too expensive" and rows["open"].cancel_reason == "not cancelled"
    assert rows["open"].effective_end_date == date(2099, 12, 31)
    assert rows["open"].subscription_duration_days == 14 and rows["in"].subscription_duration_days == 359
    assert rows["trial"].subscription_duration_days is None
    # The underscore stays, so the flag does not match unless asked for.
    assert not rows["trial"].is_trial_expired
    spaced = staging.stg_subscriptions(raw, CTX, spaced_status=True).where("subscription_id = 'trial'").first()
    assert spaced.is_trial_expired


def test_user_defaults_and_buckets(spark):
    raw = table(spark, "users", [
        {"user_id": "1", "company_size": " 6-20", "is_deleted": "True", "acquisition_channel": "Paid Ads",
         "email": " A@B.com", "created_at": "2024-02-29"},
        {"user_id": "2", "company_size": "500+", "is_deleted": None, "created_at": "2024-02-29"},
    ])
    first, second = staging.stg_users(raw).orderBy("user_id").collect()
    assert (first.company_size, first.company_size_order, first.is_deleted) == ("small", 2, 1)
    assert (first.acquisition_channel, first.email, first.signup_month) == ("paid_ads", "a@b.com", "202402")
    assert (second.company_size, second.company_size_order, second.is_deleted) == ("unknown", 0, 999999)
    assert second.industry == second.acquisition_channel == "unknown"
    assert "email" not in dimensions.dim_users(staging.stg_users(raw)).columns


def test_plan_prices(spark):
    rows = {r.plan_id: r for r in dimensions.dim_plans(staging.stg_plans(plan_seed(spark))).collect()}
    assert rows["plan_growth"].annual_monthly_equivalent == Decimal("103.17")
    assert rows["plan_growth"].annual_discount_pct == Decimal("20.0")
    assert rows["plan_enterprise"].features == "all+dedicated_csm"


def test_plans_from_csv(spark, tmp_path):
    path = tmp_path / "plans.csv"
    path.write_text('plan_id,plan_name,monthly_price,annual_price,tier,max_seats,features\nplan_x,X,5,50,1,3,"a,b"\n')
    (row,) = read_csv_table(spark, str(path), "plans").collect()
    assert row.features == "a,b" and row.monthly_price == Decimal("5.00")


def test_raw_tables_from_files_and_catalog(spark, tmp_path):
    for name in ("events", "payments", "subscriptions", "users"):
        table(spark, name, []).write.parquet(str(tmp_path / name))
    table(spark, "users", [{"user_id": "1"}]).write.mode("overwrite").parquet(str(tmp_path / "users"))
    raw = read_raw(spark, str(tmp_path))
    assert raw.users.count() == 1 and raw.plans.count() == 4 and raw.events.columns[0] == "event_id"
    raw.users.write.mode("overwrite").saveAsTable("raw_users_test")
    assert read_catalog_table(spark, "default", "raw_users_test").first().user_id == "1"


def test_values_that_do_not_fit(spark):
    raw = spark.createDataFrame(
        [("1", "12.5", "2024-01-01"), ("2", "abc", "2024-01-01"), ("3", None, "01/02/2024")],
        "payment_id string, amount string, payment_date string",
    )
    for missing in ("subscription_id", "user_id", "plan_id", "billing_cycle", "currency", "status", "period_start",
                    "period_end"):
        raw = raw.selectExpr("*", f"cast(null as string) {missing}")
    with pytest.raises(PySparkException):
        staging.stg_payments(raw).collect()
    rows = {r.payment_id: r for r in staging.stg_payments(raw, lenient=True).collect()}
    assert rows["2"].amount is None and rows["3"].payment_date is None
    rejected = staging.rejected_rows(raw, staging.RAW_CASTS["payments"])
    assert {r.payment_id: r.rejected_columns for r in rejected.collect()} == {"2": ["amount"], "3": ["payment_date"]}
