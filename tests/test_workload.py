"""Every registered query is well formed and runs on the smallest data."""

import __spark_entry__ as entry_points
import pytest

SF = "/root/testdata/sf0.001"


def test_every_oracle_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", ["f_ids", "a_payroll", "a_customers", "s_paged", "e_salary_statistics"])
def test_query_runs(spark, name):
    assert not entry_points.queries()[name](spark, SF).isEmpty()


def test_entry(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) >= 35 and df.count() > 0
