from collections import Counter
from datetime import date

import pytest

from pyspark.sql import functions as F

from ledgerlight.operators import checks, contracts
from ledgerlight.operators.contracts import CONTRACTS
from ledgerlight.operators.tables import MonthTable
from ledgerlight.plans.build import check_tables
from ledgerlight.plans.check_list import declared_checks
from ledgerlight.plans.registry import _layer_tables, sample_marts
from ledgerlight.sources.schemas import RAW_PII


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(
        [(1, "a", "a@b.co", 5, "p1"), (2, "b", "bad", -1, "p9"), (2, "b", None, None, "p9"), (None, "z", "x@y.org", 3, None)],
        "id int, kind string, email string, amount int, parent string",
    )
    parent = spark.createDataFrame([("p1",), ("p2",)], "id string")
    return {"child": child, "parent": parent}


@pytest.mark.parametrize(("check", "failures"), [
    (checks.unique("child", "id"), 1),
    (checks.not_null("child", "id"), 1),
    (checks.accepted_values("child", "kind", ["a", "b"]), 1),
    (checks.email("child", "email"), 1),
    (checks.expression("child", "amount", ">= 0"), 1),
    (checks.expression("child", "amount", ">= 4", where="id is not null"), 1),
    (checks.relationships("child", "parent", "parent", "id"), 2),
    (checks.unique_combination("child", ["id", "kind"]), 1),
    (checks.unique("child", "email"), 0),
    (checks.not_null("child", "kind"), 0),
])
def test_each_check_reports_exactly_the_bad_rows(tables, check, failures):
    (result,) = checks.run_checks(tables, [check]).collect()
    assert (result.failures, result.status) == (failures, "fail" if failures else "pass")


def test_warnings_do_not_fail_a_run(tables):
    warn = checks.accepted_values("child", "kind", ["a"], severity="warn")
    results = checks.run_checks(tables, [warn, checks.not_null("child", "kind")])
    assert {r.status for r in results.collect()} == {"warn", "pass"}
    checks.require(results)
    with pytest.raises(checks.ChecksFailed, match="child.id unique: 1"):
        checks.require(checks.run_checks(tables, [checks.unique("child", "id")]))


def test_failing_rows_are_stored(spark, tables, tmp_path):
    path = checks.store_failures(checks.email("child", "email"), tables, str(tmp_path))
    assert [r.email for r in spark.read.parquet(path).collect()] == ["bad"]
    path = checks.store_failures(checks.relationships("child", "parent", "parent", "id"), tables, str(tmp_path))
    assert [(r.parent, r.n_records) for r in spark.read.parquet(path).collect()] == [("p9", 2)]


def test_the_declared_checks():
    kinds = Counter(c.kind for c in declared_checks())
    assert kinds == {"unique": 27, "not_null": 61, "accepted_values": 9, "relationships": 7, "expression": 14,
                     "email": 1, "unique_combo": 2}
    assert sum(c.severity == "warn" for c in declared_checks()) == 3


def test_checks_on_the_sample_marts(spark, sf_dir):
    kinds = {"accepted_values", "email", "expression", "unique_combo"}
    results = checks.run_checks(_layer_tables(sample_marts(spark, sf_dir)), declared_checks(kinds)).collect()
    failed = {(r.table_name, r.column_name) for r in results if r.status == "fail"}
    # The sample holds unknown event names, bad emails and activations before the signup event on purpose.
    assert {("stg_events", "event_name"), ("stg_users", "email")} <= failed
    assert failed <= {("stg_events", "event_name"), ("stg_users", "email"), ("fct_user_funnel", "days_to_activation"),
                      ("fct_user_funnel", "days_to_email_verified"), ("fct_user_funnel", "days_to_conversion")}


def test_a_checked_run_stores_what_failed(spark, sf_dir, tmp_path):
    marts = sample_marts(spark, sf_dir)
    chosen = {"stg_users": marts.staged_users, "dim_users": marts.users, "dim_plans": marts.plans}
    results = check_tables(spark, chosen, str(tmp_path))
    assert [(r.table_name, r.check_type, r.failures) for r in results.where("status != 'pass'").collect()] == [
        ("stg_users", "email", 3)
    ]
    assert spark.read.parquet(str(tmp_path / "stg_users" / "email__email")).count() == 3
    with pytest.raises(checks.ChecksFailed, match="stg_users.email email: 3"):
        checks.require(results)


def test_contract_counts():
    assert sum(len(c.required) for c in CONTRACTS.values()) == 82
    assert sum(c.primary_key is not None for c in CONTRACTS.values()) == 7


def test_contract_shape_and_types(spark, sf_dir):
    marts = sample_marts(spark, sf_dir)
    shaped = contracts.enforce(marts.mrr, CONTRACTS["fct_mrr"])
    assert [(f.name, f.dataType) for f in shaped.schema] == [(f.name, f.dataType) for f in CONTRACTS["fct_mrr"].schema]
    assert shaped.schema["sk_mrr_id"].metadata["grain"] == "subscription and month"
    with pytest.raises(contracts.ContractBroken, match="missing .'mrr'., unexpected .'extra'."):
        contracts.enforce(marts.mrr.withColumnRenamed("mrr", "extra"), CONTRACTS["fct_mrr"])


def test_contract_violations_are_named(spark):
    rows = spark.createDataFrame(
        [("k", "p", "n", 1, 1, None, 1, 1, 1, None, date(2024, 1, 1))] * 2,
        "sk_plan_id string, plan_id string, plan_name string, tier int, max_seats int, features string, "
        "monthly_price int, annual_price int, annual_monthly_equivalent int, annual_discount_pct int, _stg_loaded_at date",
    ).selectExpr("* except (plan_name)", "nullif(plan_name, 'n') plan_name")
    shaped = contracts.enforce(rows, CONTRACTS["dim_plans"])
    with pytest.raises(contracts.ContractBroken) as broken:
        contracts.audit(shaped, CONTRACTS["dim_plans"])
    assert "plan_name not_null: 2" in str(broken.value) and "sk_plan_id primary_key: 1" in str(broken.value)


def test_personal_data_stays_out_of_the_marts():
    for contract in CONTRACTS.values():
        assert not set(RAW_PII["users"]) & set(contract.schema.names)
    assert contracts.pii_columns("stg_users") == ("email",)


def test_rows_that_break_several_checks_are_written_in_one_scan(spark, tables, tmp_path):
    declared = [
        checks.not_null("child", "id"), checks.email("child", "email"), checks.expression("child", "amount", ">= 0"),
        checks.accepted_values("child", "kind", ["a", "b"]), checks.unique("child", "id"),
    ]
    for given in (tables, {**tables, "child": tables["child"].where("id = 1")}):
        stored = checks.store_failing_rows("child", given, declared, str(tmp_path))
        found = sorted((r.failed_check, r.kind, r.email) for r in stored.collect())
        expected = sorted(
            (f"{c.kind}__{c.column_name}", r.kind, r.email)
            for c in declared[:4] for r in given["child"].where(checks.row_failure(c)).collect()
        )
        assert found == expected and (found == [] or len(found) == 4)
    assert checks.store_failing_rows("parent", tables, declared, str(tmp_path)) is None


def test_one_pass_equals_the_single_checks(spark):
    rows = spark.range(500).selectExpr(
        "id % 400 a", "if(id % 7 = 0, null, id) b", "cast(id % 3 as string) c", "if(id < 3, null, 'k') d", "cast(id as string) e"
    )
    parents = spark.createDataFrame([("0",), ("1",), (None,)], "p string")
    tables = {"t": rows, "empty": rows.where("false"), "parent": parents}
    declared = [f(t, c) for t in ("t", "empty") for f in (checks.unique, checks.not_null) for c in "abcde"]
    declared += [checks.unique_combination("t", ["a", "c"]), checks.unique_combination("t", ["d", "c"]), checks.unique_combination("t", ["b", "e"])]
    declared += [checks.relationships(t, c, "parent", "p") for t in ("t", "empty") for c in "ce"]
    declared += [checks.expression("t", "a", f"<> {k}") for k in range(70)]  # more than one mask holds
    found = {(r.table_name, r.check_type, r.column_name, r.detail): r.failures for r in checks.run_checks(tables, declared).collect()}
    assert len(found) == len(declared)
    for c in declared:
        bad = checks.failing_rows(c, tables)
        many = bad.agg({"n_records": "sum"}).first()[0] or 0 if c.kind == "relationships" else bad.count()
        assert found[c.table, c.kind, c.column_name, c.detail] == many, c


def test_no_job_holds_the_hashes_of_all_keys_where_rows_are_counted(spark, monkeypatch):
    rows = spark.range(600).selectExpr("id a", "id % 590 b", "if(id % 7 = 0, null, id) c", "if(id = 9, null, 'k') d")
    few = spark.range(20).selectExpr("id % 19 a", "id b")
    tables = {"t": rows, "few": few, "other": few, "plain": rows.limit(30)}
    declared = [checks.unique("t", c) for c in "abc"] + [checks.unique_combination("t", ["a", "d"]), checks.unique_combination("t", ["b", "d"])]
    declared += [checks.unique(t, c) for t in ("few", "other") for c in "ab"] + [checks.not_null(t, "d") for t in ("t", "plain")]
    declared += [checks.expression("t", "a", f"<> {k}") for k in range(65)]
    expected = sorted(map(tuple, checks.run_checks(tables, declared).collect()))
    assert {r[-2] for r in expected} >= {0, 1, 10}
    made, make = [], checks._jobs

    def seen_jobs(*given):
        made.append([sum(m.where("part >= 0").count() for m in job) for job in make(*given)])
        return make(*given)

    monkeypatch.setattr(checks, "_jobs", seen_jobs)
    assert sorted(map(tuple, checks.run_checks(tables, declared, counted=True).collect())) == expected
    monkeypatch.setattr(checks, "JOB_ROWS", 400)
    monkeypatch.setattr(checks, "SLICE_ROWS", 250)
    assert sorted(map(tuple, checks.run_checks(tables, declared, counted=True).collect())) == expected
    whole, cut = made
    assert len(whole) == 1 and len(cut) > 6 and max(cut) < 480 and sum(cut) == sum(whole)  # slices are about even


def test_a_table_is_scanned_once_for_all_its_checks(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id as string) k", "id % 5 v").write.parquet(str(tmp_path / "t"))
    seen = spark.sparkContext.accumulator(0)
    table = spark.read.parquet(str(tmp_path / "t"))

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = table.mapInArrow(count, table.schema)
    declared = [checks.unique("t", "id"), checks.unique("t", "k"), checks.not_null("t", "id"), checks.expression("t", "v", "< 5")]
    results = checks.run_checks({"t": watched}, declared).collect()
    assert {r.status for r in results} == {"pass"} and seen.value == 100


def test_nulls_are_counted_by_the_write(spark, tmp_path):
    contract = CONTRACTS["dim_users"]
    good = spark.range(3).selectExpr(*[f"cast(id as {f.dataType.simpleString()}) {f.name}" if f.dataType.simpleString() in ("string", "int", "timestamp")
                                       else f"cast('2024-01-01' as {f.dataType.simpleString()}) {f.name}" for f in contract.schema])
    table = MonthTable(spark, str(tmp_path / "users"), "sk_user_id", "signup_month")
    table.replace(good, audit=contracts.WriteAudit(contract))
    bad = good.withColumn("signup_month", F.expr("if(sk_user_id = '1', null, signup_month)"))
    for write in (table.replace, table.upsert):
        with pytest.raises(contracts.ContractBroken, match="dim_users.signup_month not_null: 1"):
            write(bad, audit=contracts.WriteAudit(contract))
    with pytest.raises(contracts.ContractBroken, match="sk_user_id primary_key: 1"):
        table.replace(good.withColumn("sk_user_id", F.expr("least(sk_user_id, '1')")), audit=contracts.WriteAudit(contract))
    assert table.read().count() == 3 and table.read().where("signup_month IS NULL").isEmpty()
