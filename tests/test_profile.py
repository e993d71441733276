import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.operators import profile as p
from recordloom.operators.quantiles import exact_quantiles, value_counts_of

D = dt.datetime


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_equal_numpy(spark, seed):
    rnd = np.random.default_rng(seed)
    groups = {"a": rnd.normal(0, 1e6, 500).round(2), "b": rnd.integers(-3, 3, 400) * 1.0, "c": np.array([7.0]), "d": np.append(rnd.random(50), 1e12)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None)]
    counts = value_counts_of(spark.createDataFrame(rows, "g string, v double"), "g", "v")
    got = {r.g: r for r in exact_quantiles(counts, "g", {"x": 0.25, "y": 0.5, "z": 0.9}).collect()}
    for g, vs in groups.items():
        assert np.allclose([got[g].x, got[g].y, got[g].z], np.quantile(vs, [0.25, 0.5, 0.9]), rtol=1e-12)


def test_salary_distribution(spark, rules):
    rows = [("Part-Time", float(v)) for v in (10, 20, 30, 40, 1000)] + [(None, 5.0), ("Full-Time", 9e9), ("Full-Time", None), ("Odd", 1.0)]
    got = p.salary_distribution(spark.createDataFrame(rows, "employment_type string, salary_usd_annual double"), rules).collect()
    assert [r.employment_type for r in got] == ["Full-Time", "Part-Time", "(Unknown)", "Odd"]
    assert tuple(got[0])[1:] == (1, 2e6, 2e6, 2e6, 2e6, 2e6)
    assert tuple(got[1])[1:] == (5, 20.0, 30.0, 40.0, 10.0, 40.0)


def test_tenure(spark, rules):
    days = [0, 1, 365, 3652, 3652, 7305]
    rows = [(D(2026, 1, 1) - dt.timedelta(days=n),) for n in days] + [(None,), (D(2027, 1, 1),)]
    df = spark.createDataFrame(rows, "hire_date timestamp_ntz")
    years = np.array(days + [0]) / 365.25
    got = p.tenure_histogram(df, rules.as_of).collect()
    assert [r.employees for r in got] == np.histogram(years, bins=20)[0].tolist()
    assert p.tenure_median(df, rules.as_of).first()[0] == round(float(np.median(years)), 2)
    one = p.tenure_histogram(df.limit(1), rules.as_of).collect()
    assert [r.employees for r in one] == np.histogram([0.0], bins=20)[0].tolist()
    assert p.tenure_histogram(df.limit(0), rules.as_of).collect() == []


def test_counts_and_rates(spark):
    rows = [("A", "US", True), ("A", "US", None), ("B", None, True), (None, "DE", False)]
    df = spark.createDataFrame(rows, "department string, country string, benefits_enrolled boolean")
    assert [tuple(r) for r in p.headcount_by_department(df).collect()] == [("(Unknown)", 1), ("B", 1), ("A", 2)]
    assert [tuple(r) for r in p.headcount_by_country(df, 2).collect()] == [("US", 2), ("(Unknown)", 1)]
    assert [tuple(r) for r in p.enrolment_rate_by_department(df).collect()] == [("B", 100.0), ("A", 50.0), ("(Unknown)", 0.0)]
    assert sorted(tuple(r) for r in p.value_counts(df, "country").collect()) == [("DE", 1), ("US", 2)]
    assert (None, 1) in [tuple(r) for r in p.value_counts(df, "country", keep_null=True).collect()]


def test_customer_tables(spark):
    rows = [("a", "x", None, "US", D(2020, 1, 31), True, True, "crm,erp"), (None, "y", None, "EU", D(2020, 3, 1), False, False, None),
            ("c", None, None, None, None, True, None, "crm"), ("d", "z", "1", "US", D(2020, 3, 31), False, True, "web")]
    df = spark.createDataFrame(rows, "email string, first_name string, phone string, region string, registration_date timestamp_ntz, opt_out boolean, email_valid boolean, sources string").withColumn("last_name", F.col("first_name"))
    assert [tuple(r) for r in p.monthly_registrations(df).collect()] == [(dt.date(2020, 1, 31), 1), (dt.date(2020, 2, 29), 0), (dt.date(2020, 3, 31), 2)]
    assert [tuple(r) for r in p.contribution_by_source(df).collect()] == [("crm", 2), ("erp", 1), ("web", 1)]
    assert tuple(p.field_completeness(df).first()) == ("phone", 0.25)
    assert [tuple(r) for r in p.email_validity(df).collect()] == [("Valid", 2), ("Invalid", 2)]
    assert [tuple(r) for r in p.opt_out_rate_by_region(df).collect()] == [("EU", 0.0), ("US", 0.5)]


def test_salary_statistics(spark):
    rows = [("USD", "Annual", 1.0), ("USD", "Annual", 2.0), ("USD", "Annual", 4.0), ("EUR", "Monthly", None), (None, "Annual", 9.0)]
    got = p.salary_statistics(spark.createDataFrame(rows, "currency string, pay_frequency string, salary_usd_annual double")).orderBy("currency").collect()
    assert [tuple(r) for r in got] == [("EUR", "Monthly", 0, None, None, None, None), ("USD", "Annual", 3, 1.0, 2.0, 2.33, 4.0)]


def test_column_profile(spark):
    df = spark.createDataFrame([("b", "x" * 90, D(2020, 1, 2), None), ("a", None, D(2021, 1, 2), None)], "id string, t string, d timestamp_ntz, n int")
    got = {r.column_name: r for r in p.column_profile(df, {"id": "Key"}, "id").collect()}
    assert (got["id"].description, got["id"].example_value) == ("Key", "a")
    assert got["t"].example_value == "x" * 77 + "..." and got["d"].example_value == "2021-01-02T00:00:00" and got["n"].example_value == ""


def test_dead_letter_summary(spark):
    df = spark.createDataFrame([("payroll", "2024", "old"), ("payroll", "2025", "new"), ("hris", "2024", "x")], "source_system string, rejected_at_utc string, reason string")
    assert sorted(tuple(r) for r in p.dead_letter_summary(df).collect()) == [("hris", 1, "x"), ("payroll", 2, "new")]
