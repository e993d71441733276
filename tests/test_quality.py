import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordloom.operators import quality as q

D = dt.datetime


def report(df, *checks, threshold=0.95):
    return q.quality_report(df, checks, threshold).collect()


def test_unique_email_ignores_case_and_blanks(spark):
    df = spark.createDataFrame([(" Ann@Example.com ",), ("ann@example.com",), (None,)], "email string")
    assert report(df, q.unique("email", ""))[0][2:5] == (2, 1, 1)
    assert report(df, q.unique("email", "", fold_email=False))[0][2:5] == (2, 2, 0)


def test_ranges(spark):
    df = spark.createDataFrame([(14000.0, D(1969, 1, 1)), (50000.0, D(2020, 1, 1)), (2100000.0, None), (None, None)], "s double, d timestamp_ntz")
    a, b = report(df, q.numeric_range(df, "s", 15000, 2000000, ""), q.date_range("d", "1970-01-01", dt.date(2026, 1, 1), ""))
    assert (a.total, a.failed) == (3, 2) and (b.total, b.failed) == (2, 1)


def test_numeric_range_on_text(spark):
    df = spark.createDataFrame([("5",), ("1d",), ("x",), ("-1",), ("1e1",)], "s string")
    assert report(df, q.numeric_range(df, "s", 0, 9, ""))[0][2:5] == (3, 1, 2)


def test_date_upper_bound_is_midnight(spark):
    df = spark.createDataFrame([(D(2026, 1, 1),), (D(2026, 1, 1, 0, 0, 1),)], "d timestamp_ntz")
    assert report(df, q.date_range("d", "1970-01-01", dt.date(2026, 1, 1), ""))[0].failed == 1


def test_reference_keys(spark):
    df = spark.createDataFrame([("a", None), ("b", "gone")], "employee_id string, manager_id string")
    row = report(df, q.referential_integrity("manager_id", "employee_id", ""))[0]
    assert (row.check, row.total, row.failed) == ("REFERENTIAL INTEGRITY: manager_id -> employee_id", 1, 1)


def test_regex_is_anchored_and_blank_is_not_null(spark):
    df = spark.createDataFrame([("xab",), ("ab",), ("",), (None,)], "c string")
    a, b = report(df, q.regex("c", "ab", ""), q.not_null("c", ""))
    assert (a.total, a.failed) == (3, 2) and (b.total, b.failed) == (4, 1)


def test_threshold_is_compared_unrounded(spark):
    df = spark.range(100000).select(F.when(F.col("id") >= 5001, F.lit("x")).alias("c"))
    row = report(df, q.not_null("c", ""))[0]
    assert row.pass_rate == 0.95 and row.status == "FAIL"
    assert report(df.limit(0), q.not_null("c", ""))[0][2:] == (0, 0, 0, 1.0, "PASS")


def test_custom_check(spark):
    df = spark.range(10)
    assert report(df, q.custom("even", "", F.col("id") % 2 == 1))[0].failed == 5


VALID = [
    ("GT-000001", "Ada", "L", "ada@example.com", "Engineering", D(2020, 1, 1), "US", "Full-Time", None, "USD", 80000.0),
    ("AC-000001", "Bob", "M", "bob@example.com", "Sales", D(2021, 1, 1), "DE", "Part-Time", "GT-000001", "EUR", 76300.0),
]
DDL = ("employee_id string, first_name string, last_name string, email string, department string, hire_date timestamp_ntz, country string, "
       "employment_type string, manager_id string, currency string, salary_usd_annual double")


def test_employee_suite(spark, rules):
    rep = q.employee_report(spark.createDataFrame(VALID, DDL), rules)
    rows = rep.collect()
    assert len(rows) == 15 and all(r.status == "PASS" for r in rows)
    assert rep.columns == list(q.REPORT_COLUMNS)
    assert tuple(q.report_summary(rep).first()) == (15, 15, 0, True)


def test_row_checks_read_the_data_once(spark, rules, tmp_path):
    spark.createDataFrame(VALID, DDL).write.parquet(str(tmp_path / "e"))
    df = spark.read.parquet(str(tmp_path / "e"))
    checks = [c for c in q.employee_checks(df, rules) if c.reference is None]
    plan = q.quality_report(df, checks, 0.95)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_customer_suite(spark, customer_rules):
    df = spark.createDataFrame(
        [("a@x.com", "A", "US", D(2020, 1, 1)), ("a@x.com", None, "XX", D(2009, 1, 1)), (None, None, None, None)],
        "email string, first_name string, region string, registration_date timestamp_ntz")
    rows = q.customer_report(df, customer_rules).collect()
    assert [(r.total, r.failed) for r in rows] == [(3, 1), (3, 2), (3, 1), (2, 1), (2, 0), (2, 1), (2, 1)]


def test_gate(spark):
    rep = lambda n: spark.createDataFrame([(f"c{i}", "FAIL" if i < n else "PASS") for i in range(5)], "check string, status string")
    q.enforce_gate(rep(2), 2)
    with pytest.raises(q.QualityGateError, match="3 checks failed.*c0, c1, c2"):
        q.enforce_gate(rep(3), 2)
