import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordloom.functions import dates, identity, money, similarity, text
from recordloom.sources.align import normalize_headers


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.select(fn(F.col("c")).alias("r"), "i").orderBy("i").select("r").collect()]


def test_normalize_text(spark):
    got = apply(spark, text.normalize_text, ["  ﬁrst  Ａ ", " \t ", None, "plain", "é"])
    assert got == ["first A", None, None, "plain", "é"]


def test_person_name(spark):
    got = apply(spark, text.person_name, ["  josé  ", "anne-mARIE", "o'BRIEN", None, "van  der berg", "3d é x"])
    assert got == ["José", "Anne-Marie", "O'Brien", None, "Van Der Berg", "3D É X"]


def test_customer_name(spark):
    got = apply(spark, text.customer_name, ["  mary   JANE ", "josé", "nan", "none", "", None])
    assert got == ["Mary Jane", "José", None, None, None, None]


def test_customer_email_and_validity(spark, customer_rules):
    got = apply(spark, text.customer_email, ["  Alice@Example.COM ", "a b@c.d", "NaN", "", None])
    assert got == ["alice@example.com", "ab@c.d", None, None, None]
    valid = lambda c: text.matches(c, customer_rules.email_pattern)
    assert apply(spark, valid, ["ok@gmail.com", "not-an-email", "missing@", None]) == [True, False, False, False]


def test_phone(spark):
    got = apply(spark, text.phone_digits, ["+1 (555) 123-4567", "555.123.4567", "invalid-phone", "123", None])
    assert got == ["+15551234567", "5551234567", None, None, None]


def test_region(spark, customer_rules):
    got = apply(spark, lambda c: text.region_code(c, customer_rules.regions), ["usa", " EMEA", "Asia Pacific", "N/A", "NA", None])
    assert got == ["US", "EU", "APAC", None, "US", None]


def test_opt_out(spark):
    got = apply(spark, text.opt_out_flag, ["1", "0", "2.5", "true", "nan", "1d", None, " 1 "])
    assert got == [True, False, True, False, False, False, False, True]


def test_full_and_split_name(spark):
    df = spark.createDataFrame([(" Ann ", None), (None, None), ("A  B", "C")], "a string, b string")
    assert [r[0] for r in df.select(text.full_name(F.col("a"), F.col("b"))).collect()] == ["Ann", "", "A B C"]
    parts = lambda c: F.struct(*(p.alias(n) for p, n in zip(text.split_full_name(c), "fl")))
    assert [tuple(r) if r else r for r in apply(spark, parts, [" Ann  van  Berg", "Solo", None])] == [
        ("Ann", "van  Berg"), ("Solo", None), (None, None)]


def test_ids(spark, rules):
    rows = [("42", "9", "GlobalTech"), ("ACQ_00007", "ACQ_00002", " acquiredco "), ("1234567", None, "GlobalTech"),
            ("none", "5", "GlobalTech"), ("8", "8", "Other"), ("99999999999999999999999", "0", "GlobalTech")]
    df = spark.createDataFrame(rows, "employee_id string, manager_id string, company_origin string")
    got = identity.with_ids(df, rules).select("employee_id", "manager_id", "employee_id_raw").collect()
    assert [tuple(r) for r in got] == [
        ("GT-000042", "GT-000009", "42"), ("AC-000007", "AC-000002", "ACQ_00007"), (None, None, "1234567"),
        (None, "GT-000005", "none"), (None, None, "8"), (None, "GT-000000", "99999999999999999999999")]


def test_employment_type(spark, rules):
    fn = lambda c: text.map_taxonomy(c, rules.employment_types)
    assert apply(spark, fn, ["FT", "pt", "CONTRACTOR", "temporary", " full  time ", None]) == [
        "Full-Time", "Part-Time", "Contractor", None, "Full-Time", None]


def test_department(spark, rules):
    df = spark.createDataFrame([("ENG-01",), ("Sales",), ("Mystery Team",), (None,)], "department string")
    got = text.with_department(df, rules.departments)
    assert [tuple(r) for r in got.select("department", "department_original", "department_unmapped").collect()] == [
        ("Engineering", "ENG-01", False), ("Sales", "Sales", False), (None, "Mystery Team", True), (None, None, False)]


def test_parse_money(spark):
    got = apply(spark, money.parse_money, ["$85,000", "(1,000)", "(-5)", "-", "1-2", "", None, "£ 1.50 "])
    assert got == [85000.0, -1000.0, 5.0, None, None, None, None, 1.5]


def test_annualize(spark, rules):
    rows = [("$10,000", "usd", "Monthly"), ("€1,000", "EUR", "Annual"), ("£2,000", "gbp", "Bi-Weekly"),
            ("5", "JPY", "annual"), ("x", "USD", "weekly")]
    df = spark.createDataFrame(rows, "base_salary string, currency string, pay_frequency string")
    got = [tuple(r) for r in money.annualize(df, rules).collect()]
    assert got == [("$10,000", "USD", "Monthly", 120000.0), ("€1,000", "EUR", "Annual", 1090.0),
                   ("£2,000", "GBP", "Bi-Weekly", 66040.0), ("5", "JPY", "Annual", None), ("x", "USD", None, None)]
    assert tuple(money.salary_issues(df, rules).first()) == (1, 1, 1, "JPY")


def test_half_even_rounding(spark):
    assert apply(spark, money.two_places, [0.125, 0.375, 2.5], "double") == [0.12, 0.38, 2.5]


def test_dates(spark, rules):
    values = ["2020-01-02", "03/04/2021", "05-May-2022", "not-a-date", "1960-01-01", None, "2020", "2026-01-01T00:00:01",
              "2020-01-02T03:04:05Z", "2020-01-02 03:04:05", "2020-01-02T03:04:05.5+02:00"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, hire_date string")
    got = dates.with_dates(df, rules.as_of, rules.earliest_date).orderBy("i").collect()
    assert [r.hire_date for r in got] == [
        dt.datetime(2020, 1, 2), dt.datetime(2021, 3, 4), dt.datetime(2022, 5, 5), None, dt.datetime(1960, 1, 1), None,
        None, dt.datetime(2026, 1, 1, 0, 0, 1), dt.datetime(2020, 1, 2, 3, 4, 5), dt.datetime(2020, 1, 2, 3, 4, 5),
        dt.datetime(2020, 1, 2, 1, 4, 5, 500000)]
    assert [r.hire_date_invalid for r in got] == [False, False, False, True, True, False, True, True, False, False, False]


def test_dates_do_not_depend_on_session_zone(spark, rules):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = apply(spark, lambda c: dates.mixed_timestamp(c).cast("string"), ["2020-07-02T03:04:05+02:00", "03/04/2021"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2020-07-02 01:04:05", "2021-03-04 00:00:00"]


def test_tenure(spark, rules):
    fn = lambda c: dates.tenure_days(c, rules.as_of)
    got = apply(spark, fn, [dt.datetime(2025, 12, 31, 12), dt.datetime(2025, 1, 1), dt.datetime(2027, 1, 1), None], "timestamp_ntz")
    assert got == [0, 365, 0, None]


def test_clip_keeps_null(spark):
    assert apply(spark, lambda c: money.clip_upper(c, 2.0), [1.0, 3.0, None], "double") == [1.0, 2.0, None]


def test_provenance(spark, rules):
    df = spark.createDataFrame([(["payroll", " benefits", "globaltech_hris", "acquiredco_hris", "payroll", "", None],)], "s array<string>")
    assert df.select(identity.provenance(F.col("s"), rules.source_priority)).first()[0] == (
        "acquiredco_hris,globaltech_hris,payroll,benefits")


def test_ensure_provenance(spark):
    rows = [("a", None, None), ("a", "a,b", "single_source"), ("a", "a,b", "email_match")]
    df = spark.createDataFrame(rows, "source_system string, source_systems string, dedup_method string")
    got = identity.ensure_provenance(df).select("source_systems", "dedup_method").collect()
    assert [tuple(r) for r in got] == [("a", "single_source"), ("a,b", "exact_id"), ("a,b", "email_match")]


def test_headers():
    assert normalize_headers([" CustomerEmail ", "First Name", "Registration--Date", "_X_"]) == [
        "customeremail", "first_name", "registration_date", "x"]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs_lengths():
    import random

    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("abcé ") for _ in range(n))
    a = [word(rnd.randint(0, 130)) for _ in range(200)] + [word(64), ""]
    b = [word(rnd.randint(0, 130)) for _ in range(200)] + [word(70), "x"]
    assert similarity.lcs_lengths(a, b).tolist() == [_lcs(x, y) for x, y in zip(a, b)]


@pytest.mark.parametrize("a,b,score", [("John Smith", "Smith John", 100.0), ("Jon Smith", "John Smith", 94.74), ("John Smith", "john smith", 80.0)])
def test_score(spark, a, b, score):
    df = spark.createDataFrame([(a, b)], "a string, b string").select(*(similarity.sorted_tokens(F.col(c)).alias(c) for c in "ab"))
    got = df.select(similarity.score_of(similarity.lcs_length("a", "b"), F.length("a"), F.length("b")))
    assert got.first()[0] == score
