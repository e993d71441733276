import dataclasses
import datetime as dt
import random
import re

import pytest

from recordloom.operators import fuzzy
from recordloom.operators.skew import grid_join
from test_functions import _lcs

DDL = "employee_id string, first_name string, last_name string, hire_date timestamp_ntz, company_origin string"


def brute_force(rows, threshold, window):
    rank = lambda c: {"GlobalTech": 1, "AcquiredCo": 2}.get(c, 3)
    ready = []
    for i, first, last, hired, company in rows:
        name = re.sub(r"\s+", " ", f"{first or ''} {last or ''}").strip()
        if name:
            ready.append(((hired, rank(company), i), i, name, " ".join(sorted(name.split())), company, hired))
    out = set()
    for x in ready:
        for y in ready:
            near = x[0] < y[0] and (y[5] - x[5]).days <= window
            if near and x[1] != y[1] and (x[4] is None or x[4] != y[4]):
                common, total = _lcs(x[3], y[3]), len(x[3]) + len(y[3])
                if 200 * common >= threshold * total:
                    out.add((x[1], y[1], round(round(common * 20000 / total) / 100, 2), (y[5] - x[5]).days, x[2], y[2], x[4], y[4]))
    return out


def found(spark, rows, rules):
    got = fuzzy.probable_matches(spark.createDataFrame(rows, DDL), rules).select(
        "record_1_id", "record_2_id", "similarity_score", "hire_date_diff_days", "record_1_name", "record_2_name",
        "record_1_company", "record_2_company").collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def people(seed, n):
    rnd = random.Random(seed)
    first = ["John", "Jon", "Johan", "Maria", "Mari", "José", "Ann", "Anne", "Al"]
    last = ["Smith", "Smyth", "Garcia", "Garcla", "Lee", "Li", "van der Berg", "O'Brien", "Montgomery-Featherstone"]

    def edit(text):
        chars = list(text)
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randint(0, len(chars))
            if rnd.random() < 0.5:
                chars.insert(at, rnd.choice("aeion "))
            elif at < len(chars):
                del chars[at]
        return "".join(chars)

    base = dt.datetime(2020, 1, 1)
    return [(
        f"id{i:04d}" if i % 50 else "same",
        edit(rnd.choice(first)),
        edit(rnd.choice(last)) if i % 17 else None,
        base + dt.timedelta(seconds=rnd.randint(-200 * 86400, 200 * 86400)) if i % 13 else base + dt.timedelta(days=rnd.choice([0, 30, 31])),
        rnd.choice(["GlobalTech", "AcquiredCo", "GlobalTech", "AcquiredCo", "Third", "Fourth", None]),
    ) for i in range(n)]


@pytest.mark.parametrize("threshold,window", [(88, 30), (70, 5), (100, 30)])
def test_equal_to_brute_force(spark, rules, threshold, window):
    rows = people(7, 400)
    expected = brute_force(rows, threshold, window)
    assert expected
    assert found(spark, rows, dataclasses.replace(rules, fuzzy_threshold=threshold, fuzzy_window_days=window)) == expected


def test_hot_segments_on_a_grid(spark, rules, monkeypatch):
    monkeypatch.setattr(fuzzy, "_CELLS_PER_TASK", 3)
    rows = people(8, 300)
    assert found(spark, rows, rules) == brute_force(rows, 88, 30)


def test_a_third_of_all_rows_with_one_name_and_day(spark, rules):
    day = dt.datetime(2021, 5, 5)
    hot = [(f"h{i:03d}", "John", "Smith", day, "GlobalTech" if i % 2 else "AcquiredCo") for i in range(60)]
    rows = hot + people(9, 120)
    assert found(spark, rows, rules) == brute_force(rows, 88, 30)


def test_review_pair(spark, rules):
    rows = [("GT-000001", "John", "Smith", dt.datetime(2020, 1, 1), "GlobalTech"), ("AC-000001", "John", "Smith", dt.datetime(2020, 1, 10), "AcquiredCo"),
            ("GT-000002", "Unrelated", "Person", dt.datetime(2020, 1, 5), "GlobalTech")]
    got = fuzzy.probable_matches(spark.createDataFrame(rows, DDL), rules).collect()
    assert [(r.record_1_id, r.record_2_id, r.similarity_score, r.hire_date_diff_days, r.recommended_action, r.dedup_method) for r in got] == [
        ("GT-000001", "AC-000001", 100.0, 9, "review", "fuzzy_name")]


def test_window_counts_whole_days(spark, rules):
    at = dt.datetime(2020, 1, 1, 12)
    rows = [("a", "J", "Smith", at, "GlobalTech"), ("b", "J", "Smith", at + dt.timedelta(days=30, hours=23), "AcquiredCo"),
            ("c", "J", "Smith", at + dt.timedelta(days=31), "AcquiredCo")]
    assert {r[:2] + (r[3],) for r in found(spark, rows, rules)} == {("a", "b", 30)}


def test_whole_days_do_not_depend_on_session_zone(spark, rules):
    at = dt.datetime(2020, 2, 20, 12)
    rows = [("a", "J", "Smith", at, "GlobalTech"), ("b", "J", "Smith", at + dt.timedelta(days=31), "AcquiredCo")]
    near = [*rows, ("c", "J", "Smith", at + dt.timedelta(days=30), "AcquiredCo")]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert found(spark, rows, rules) == set()
        assert {r[:2] + (r[3],) for r in found(spark, near, rules)} == {("a", "c", 30)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_plan_has_no_nested_loop(spark, rules):
    df = fuzzy.probable_matches(spark.createDataFrame(people(1, 20), DDL), rules)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_grid_join_is_a_plain_join(spark):
    rnd = random.Random(2)
    left = spark.createDataFrame([(rnd.choice([1, 1, 1, 2, 3, 4]), i) for i in range(200)], "k int, a int")
    right = spark.createDataFrame([(rnd.choice([1, 1, 3, 5]), i) for i in range(100)], "k int, b int")
    plain = sorted(tuple(r) for r in left.join(right, "k").collect())
    assert sorted(tuple(r) for r in grid_join(left, right, "k", 10).collect()) == plain
