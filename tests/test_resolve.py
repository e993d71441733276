import datetime as dt
import random

import pytest

from recordloom.config import EMPLOYEE_SCHEMA
from recordloom.operators import clean, resolve

D = dt.datetime


def payroll_frame(spark, rows):
    return spark.createDataFrame(
        rows, "employee_id string, company_origin string, source_system string, payroll_effective_date timestamp_ntz, "
        "salary_usd_annual double, currency string")


def test_payroll_takes_latest_known_value_per_column(spark, rules):
    got = resolve.aggregate_payroll(payroll_frame(spark, [
        ("GT-000001", "GlobalTech", "payroll", D(2023, 1, 1), 60000.0, "USD"),
        ("GT-000001", "GlobalTech", "payroll", D(2024, 1, 1), 75000.0, None),
        ("GT-000001", "GlobalTech", "payroll", None, 1.0, "EUR"),
        (None, "GlobalTech", "payroll", None, 1.0, "EUR"),
    ]), rules).collect()
    assert len(got) == 1
    assert (got[0].salary_usd_annual, got[0].currency, got[0].payroll_effective_date) == (75000.0, "USD", D(2024, 1, 1))


def benefits_frame(spark, rows):
    return spark.createDataFrame(
        rows, "employee_id string, company_origin string, source_system string, benefits_enrolled boolean, "
        "benefit_plans string, benefit_coverage_level string, benefit_enrollment_date timestamp_ntz, "
        "premium_employee decimal(18,2), premium_employer decimal(18,2)")


def test_benefits_profile(spark):
    from decimal import Decimal as M

    row = lambda i, p, l, d, a, b: (i, "GlobalTech", "benefits", True, p, l, d, a, b)
    got = {r.employee_id: r for r in resolve.aggregate_benefits(benefits_frame(spark, [
        row("a", "Vision", "Family", D(2024, 2, 1), M("20"), M("60")),
        row("a", "Dental", "Individual", D(2024, 1, 1), M("10"), M("50")),
        row("b", None, " ", None, None, None),
        row("b", "Z", "L", D(2024, 1, 1), M("1"), M("1")),
        row("b", "Z", "L", D(2024, 1, 1), M("1"), M("1")),
        row(None, "Z", "L", D(2024, 1, 1), M("1"), M("1")),
    ])).collect()}
    assert set(got) == {"a", "b"}
    a, b = got["a"], got["b"]
    assert (a.benefit_plans, a.benefit_coverage_level, a.benefit_plan_count) == ("Dental,Vision", "Individual,Family", 2)
    assert (a.premium_employee, a.premium_employer, a.benefit_enrollment_date) == (30, 110, D(2024, 1, 1))
    assert (b.benefit_plans, b.benefit_coverage_level, b.benefit_plan_count, b.premium_employee) == ("Z,Z,N/A", "L,L,N/A", 2, 2)


def test_collapse_prefers_plain_id(spark, rules):
    df = spark.createDataFrame(
        [("AC-000001", "ACQ_DUP_00001", "Duplicate", "x", "acquiredco_hris"), ("AC-000001", "ACQ_00001", "Canonical", None, "acquiredco_hris"),
         ("GT-000001", "1", "One", None, "globaltech_hris"), (None, "x", "Lost", None, "globaltech_hris")],
        "employee_id string, employee_id_raw string, first_name string, email string, source_system string")
    got = {r.employee_id: r for r in resolve.collapse_by_id(df, rules).collect()}
    assert set(got) == {"AC-000001", "GT-000001"}
    assert (got["AC-000001"].first_name, got["AC-000001"].email, got["AC-000001"].dedup_method) == ("Canonical", "x", "exact_id")
    assert (got["GT-000001"].dedup_method, got["GT-000001"].source_systems) == ("single_source", "globaltech_hris")


def test_ghosts(spark):
    pay = spark.createDataFrame(
        [("GT-000001", "Known", "Person", 50000.0, D(2024, 1, 1), "GlobalTech"), ("GT-999999", "Ghost", "Employee", 60000.0, D(2023, 1, 1), "GlobalTech"),
         ("GT-999999", "Ghost", "Employee", 70000.0, D(2024, 1, 1), "GlobalTech"), (None, "Null", "Key", 1.0, None, "GlobalTech")],
        "employee_id string, first_name string, last_name string, salary_usd_annual double, payroll_effective_date timestamp_ntz, company_origin string")
    ids = spark.createDataFrame([("GT-000001",)], "employee_id string")
    got = resolve.detect_ghosts(pay, ids).collect()
    assert [(r.payroll_employee_id, r.name, r.salary_usd_annual, r.ghost_employee) for r in got] == [("GT-999999", "Ghost Employee", 70000.0, True)]
    assert resolve.detect_ghosts(pay.drop("first_name", "last_name"), ids).first().name is None


EMPLOYEE = "employee_id string, first_name string, last_name string, email string, company_origin string, source_system string, source_systems string, dedup_method string"


def test_email_merge(spark, rules):
    df = spark.createDataFrame([
        ("GT-000001", "Sam", "Lee", " SAM@EXAMPLE.COM ", "GlobalTech", "globaltech_hris", "globaltech_hris,payroll", "exact_id"),
        ("AC-000001", None, "Lea", "sam@example.com", "AcquiredCo", "acquiredco_hris", "acquiredco_hris", "single_source"),
        ("GT-000009", "Sid", "Lee", "sam@example.com", "GlobalTech", "globaltech_hris", "globaltech_hris,benefits", "exact_id"),
        ("GT-000002", "Other", "Person", "other@example.com", "GlobalTech", "globaltech_hris", "globaltech_hris", "single_source"),
        ("GT-000003", "Other", "Person", "other@example.com", "GlobalTech", "globaltech_hris", "globaltech_hris", "single_source"),
        ("GT-000004", "No", "Mail", None, "GlobalTech", "globaltech_hris", "globaltech_hris", "single_source"),
        ("AC-000004", "No", "Mail", " ", "AcquiredCo", "acquiredco_hris", "acquiredco_hris", "single_source"),
    ], EMPLOYEE)
    got = {r.employee_id: r for r in resolve.merge_by_email(df, rules).collect()}
    assert set(got) == {"AC-000001", "GT-000002", "GT-000003", "GT-000004", "AC-000004"}
    m = got["AC-000001"]
    assert (m.first_name, m.last_name, m.dedup_method, m.company_origin) == ("Sam", "Lea", "email_match", "AcquiredCo")
    assert m.source_systems == "acquiredco_hris,globaltech_hris,payroll,benefits"
    assert got["GT-000004"].email is None


def test_email_merge_spreads_a_hot_address(spark, rules):
    hot = [(f"GT-{i:06d}", None if i else "First", "L", "all@x.com", "GlobalTech" if i % 3 else "AcquiredCo", "globaltech_hris", "globaltech_hris", "single_source")
           for i in range(300)]
    got = resolve.merge_by_email(spark.createDataFrame(hot, EMPLOYEE), rules).collect()
    assert len(got) == 1 and got[0].first_name == "First" and got[0].employee_id == "GT-000000"


def test_exact_match_enrichment(spark, rules):
    ddl = ", ".join(f"{n} {'timestamp_ntz' if n.endswith('_date') else k}" for n, k in EMPLOYEE_SCHEMA.items()) + ", employee_id_raw string"
    def frame(rows):
        base = dict.fromkeys([*EMPLOYEE_SCHEMA, "employee_id_raw"])
        return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], ddl)
    hris = frame([dict(employee_id=f"GT-00000{i}", company_origin="GlobalTech", source_system="globaltech_hris") for i in (1, 2, 3)])
    pay = frame([dict(employee_id="GT-000001", salary_usd_annual=5.0, source_system="payroll")])
    ben = frame([dict(employee_id=f"GT-00000{i}", benefit_plans="Dental", benefits_enrolled=True, source_system="benefits") for i in (1, 2)])
    got = {r.employee_id: r for r in resolve.match_exact_ids(hris, pay, ben, rules).collect()}
    assert [(r.source_systems, r.dedup_method, r.benefits_enrolled, r.benefit_plan_count) for _, r in sorted(got.items())] == [
        ("globaltech_hris,payroll,benefits", "exact_id", True, 1), ("globaltech_hris,benefits", "exact_id", True, 1),
        ("globaltech_hris", "single_source", False, 0)]
    assert got["GT-000001"].salary_usd_annual == 5.0
    none = resolve.match_exact_ids(hris, pay.limit(0), ben.limit(0), rules)
    assert none.where("dedup_method = 'single_source'").count() == 3
    assert [r.employee_id for r in resolve.multi_source(resolve.match_exact_ids(hris, pay, ben, rules)).orderBy("employee_id").collect()] == ["GT-000001", "GT-000002"]


def test_references(spark):
    df = spark.createDataFrame([("a", None), ("b", "a"), ("c", "a"), ("d", "gone"), (None, "gone")], "employee_id string, manager_id string")
    assert tuple(resolve.dangling_references(df, "manager_id", "employee_id").first()) == (4, 2)


def customers(spark, rows):
    return spark.createDataFrame(rows, "email string, first_name string, last_name string, phone string, region string, registration_date string, opt_out int, source string")


def test_customer_merge(spark, customer_rules):
    raw = customers(spark, [
        ("A@example.com", "web", "One", "555-123-4567", "us", "2020-01-01", 1, "website"),
        ("a@example.com ", "crm", None, None, None, None, 0, "crm"),
        ("a@example.com", "new", "Two", "5559999999", "eu", "2019-01-01", 0, "partner"),
        ("bad", "erp", "X", None, None, "2020-01-01", None, "erp"),
    ])
    got = {r.email: r for r in resolve.merge_customers(clean.clean_customers(raw, customer_rules), customer_rules).collect()}
    a = got["a@example.com"]
    assert (a.first_name, a.last_name, a.phone, a.region, a.source, a.opt_out) == ("Crm", "One", "5551234567", "US", "crm", True)
    assert (a.sources, a.source_count, a.source_priority, a.email_raw) == ("crm,website,partner", 3, 1, "a@example.com ")
    assert a.registration_date == D(2020, 1, 1)
    assert (got["bad"].sources, got["bad"].opt_out, got["bad"].email_valid) == (None, False, False)


def test_results_do_not_depend_on_order_or_partitions(spark, customer_rules):
    rnd = random.Random(5)
    rows = [(f"u{rnd.randint(0, 15)}@x.com", rnd.choice(["ann", None]), rnd.choice(["b", "c", None]), rnd.choice([None, f"555{rnd.randint(1000000, 9999999)}"]),
             rnd.choice(["us", "eu", None]), None, rnd.randint(0, 1), rnd.choice(["crm", "website", "erp"])) for _ in range(200)]
    seen = set()
    for parts in (1, 4, 64):
        rnd.shuffle(rows)
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        out = resolve.merge_customers(clean.clean_customers(customers(spark, rows).repartition(parts), customer_rules), customer_rules)
        seen.add(tuple(sorted(map(str, out.collect()))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(seen) == 1


def test_inferred_regions(spark, customer_rules):
    df = spark.createDataFrame([(1, "US"), (2, None), (3, None), (4, None)], "id int, region string")
    guess = spark.createDataFrame([(1, "EU"), (2, "EU"), (3, "UNKNOWN")], "id int, region string")
    got = clean.apply_inferred_regions(df, guess, "id", customer_rules).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "US", False), (2, "EU", True), (3, None, False), (4, None, False)]


def test_missing_source_frame():
    with pytest.raises(KeyError, match="payroll"):
        resolve.source_frames({"globaltech_hris": None, "acquiredco_hris": None, "benefits": None})


def test_unknown_employment_types(spark, rules):
    df = spark.createDataFrame([("temp",), ("temp",), ("FT",), (" ",), (None,)], "employment_type string")
    assert sorted(tuple(r) for r in clean.unknown_employment_types(df, rules).collect()) == [(" ", 1), ("temp", 2)]


def test_enrolment_lists_of_many_copies(spark):
    from recordloom.operators import resolve

    one = (
        "'1' AS employee_id", "'A' AS company_origin", "timestamp_ntz'2024-01-01' AS benefit_enrollment_date",
        "'Dental' AS benefit_plans", "CAST(NULL AS STRING) AS benefit_coverage_level", "true AS benefits_enrolled",
        "CAST(1 AS DECIMAL(18,2)) AS premium_employee", "CAST(1 AS DECIMAL(18,2)) AS premium_employer",
    )
    many = spark.range(200_000).selectExpr(*one)
    row = resolve.aggregate_benefits(many).first()
    assert row.benefit_plan_count == 200_000 and row.benefit_plans == ",".join(["Dental"] * 200_000)
    assert row.benefit_coverage_level == ",".join(["N/A"] * 200_000)
    old, resolve.LONGEST_LIST = resolve.LONGEST_LIST, 1000
    try:
        with pytest.raises(Exception, match="list of employee 1 would have 1400000 bytes"):
            resolve.aggregate_benefits(many).collect()
    finally:
        resolve.LONGEST_LIST = old


def test_consumed_ids_lead_to_the_row_that_stays(spark, rules, monkeypatch):
    monkeypatch.setattr(resolve, "_ROWS_PER_TASK", 3)
    rows = [(f"AC-{i:06d}", "AcquiredCo", "acquiredco_hris", "hot@x.com") for i in range(40)]
    rows += [("GT-000001", "GlobalTech", "globaltech_hris", " Hot@X.com"), ("GT-000002", "GlobalTech", "globaltech_hris", "own@x.com"),
             ("GT-000003", "GlobalTech", "globaltech_hris", "own@x.com"), ("GT-000004", "GlobalTech", "globaltech_hris", None), (None, "GlobalTech", "globaltech_hris", "hot@x.com")]
    df = spark.createDataFrame(rows, "employee_id string, company_origin string, source_system string, email string").repartition(5)
    got = {tuple(r) for r in resolve.consumed_ids(df, rules).collect()}
    assert got == {(f"AC-{i:06d}", "AC-000000") for i in range(1, 40)} | {("GT-000001", "AC-000000")}
    people = spark.createDataFrame([("AC-000000", "GT-000001"), ("GT-000002", "GT-999999"), ("GT-000003", None)], "employee_id string, manager_id string")
    aliases = resolve.consumed_ids(df, rules)
    assert tuple(resolve.dangling_references(people, "manager_id", "employee_id").first()) == (2, 2)
    assert tuple(resolve.dangling_references(people, "manager_id", "employee_id", aliases).first()) == (2, 1)
