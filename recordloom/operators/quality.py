"""Data-quality checks, their report and the publish gate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from recordloom.config import CustomerRules, EmployeeRules
from recordloom.functions.dates import midnight
from recordloom.functions.text import email_key, matches, number_or_null
from recordloom.operators.resolve import dangling_references

REPORT_COLUMNS = ("check", "description", "total", "passed", "failed", "pass_rate", "status")


class QualityGateError(RuntimeError):
    """More checks failed than the gate allows."""


@dataclass(frozen=True)
class Check:
    """One line of the report: which rows count, and which of them fail.

    ``counted`` and ``failing`` are boolean columns. ``distinct`` is set instead of
    ``failing`` for uniqueness, ``reference`` for foreign keys.
    """

    name: str
    description: str
    counted: Column | None = None
    failing: Column | None = None
    distinct: Column | None = None
    reference: tuple[str, str] | None = None


def not_null(column: str, description: str) -> Check:
    """Null fails, blank text passes (Q1)."""
    return Check(f"NOT NULL: {column}", description, F.lit(True), F.col(column).isNull())


def unique(column: str, description: str, fold_email: bool = True) -> Check:
    """Rows beyond the first of each value fail; e-mails compare by their key (Q2)."""
    c = F.col(column)
    # a blank address is a value of its own here, so its key is not turned into null
    key = F.coalesce(email_key(c), F.lit("")) if column == "email" and fold_email else c
    return Check(
        f"UNIQUE: {column}", description, c.isNotNull(), distinct=F.when(c.isNotNull(), key)
    )


def regex(column: str, pattern: str, description: str) -> Check:
    """Text that does not match from its start fails (Q3)."""
    c = F.col(column).cast("string")
    return Check(f"REGEX: {column}", description, c.isNotNull(), ~matches(c, pattern))


def values_in_set(column: str, values: Sequence[object], description: str) -> Check:
    """A value outside the set fails (Q4)."""
    c = F.col(column)
    return Check(f"VALUES IN SET: {column}", description, c.isNotNull(), ~c.isin(*values))


def numeric_range(
    df: DataFrame, column: str, low: float, high: float, description: str
) -> Check:
    """Numbers, or text that reads as one, outside the closed range fail (Q5)."""
    c = F.col(column)
    is_number = isinstance(df.schema[column].dataType, NumericType)
    number = F.nullif(c.cast("double"), F.lit(float("nan"))) if is_number else number_or_null(c)
    return Check(
        f"NUMERIC RANGE: {column}", description, number.isNotNull(), ~number.between(low, high)
    )


def date_range(column: str, low: str, as_of: dt.date, description: str) -> Check:
    """Dates outside the closed range from ``low`` to the start of ``as_of`` fail (Q6)."""
    c = F.col(column)
    inside = c.between(F.lit(low).cast("timestamp_ntz"), midnight(as_of))
    return Check(f"DATE RANGE: {column}", description, c.isNotNull(), ~inside)


def referential_integrity(foreign: str, primary: str, description: str) -> Check:
    """Foreign keys without a primary key in the same table fail (Q7)."""
    return Check(
        f"REFERENTIAL INTEGRITY: {foreign} -> {primary}", description, reference=(foreign, primary)
    )


def custom(name: str, description: str, failing: Column, counted: Column | None = None) -> Check:
    """A check of one's own: any boolean column."""
    return Check(name, description, F.lit(True) if counted is None else counted, failing)


def _counts(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """(ordinal, total, failed) of the row-level checks, from one aggregate over the data."""
    cells = []
    for i, check in checks:
        cells.append(F.count_if(check.counted).alias(f"total_{i}"))
        if check.distinct is None:
            cells.append(F.count_if(check.counted & check.failing).alias(f"bad_{i}"))
        else:
            cells.append(F.count_distinct(check.distinct).alias(f"values_{i}"))
    lines = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.col(f"total_{i}").alias("total"),
            (
                F.col(f"bad_{i}")
                if check.distinct is None
                else F.col(f"total_{i}") - F.col(f"values_{i}")
            ).alias("failed"),
        )
        for i, check in checks
    ]
    return df.agg(*cells).select(F.inline(F.array(*lines)))


def _references(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> list[DataFrame]:
    return [
        dangling_references(df, *check.reference).select(
            F.lit(i).alias("ordinal"), "total", "failed"
        )
        for i, check in checks
    ]


def quality_report(df: DataFrame, checks: Sequence[Check], threshold: float) -> DataFrame:
    """One row per check in the given order (Q8).

    All row-level checks come from one pass over the data; each reference check adds one
    join of distinct keys. The pass rate is shown with four places but compared unrounded.
    """
    numbered = list(enumerate(checks, start=1))
    plain = [(i, c) for i, c in numbered if c.reference is None]
    parts = ([_counts(df, plain)] if plain else []) + _references(
        df, [(i, c) for i, c in numbered if c.reference is not None]
    )
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    name = F.element_at(F.array(*(F.lit(c.name) for c in checks)), F.col("ordinal"))
    text = F.element_at(F.array(*(F.lit(c.description) for c in checks)), F.col("ordinal"))
    rate = F.when(F.col("total") > 0, 1 - F.col("failed") / F.col("total")).otherwise(1.0)
    return (
        counts.withColumns({"check": name, "description": text, "rate": rate})
        .select(
            "ordinal",
            "check",
            "description",
            "total",
            (F.col("total") - F.col("failed")).alias("passed"),
            "failed",
            (F.rint(F.col("rate") * 10000) / 10000).alias("pass_rate"),
            F.when(F.col("rate") >= threshold, "PASS").otherwise("FAIL").alias("status"),
        )
        .orderBy("ordinal")
        .drop("ordinal")
    )


def report_summary(report: DataFrame) -> DataFrame:
    """Checks run, passed and failed, and whether all passed."""
    return report.agg(
        F.count("*").alias("checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
    ).withColumn("all_passed", F.col("failed") == 0)


def employee_checks(df: DataFrame, rules: EmployeeRules) -> list[Check]:
    """The 15 employee checks (Q9)."""
    low, high = rules.salary_range
    return [
        not_null("employee_id", "Every employee has a canonical id"),
        not_null("first_name", "Every employee has a first name"),
        not_null("last_name", "Every employee has a last name"),
        not_null("email", "Every employee has an e-mail address"),
        not_null("department", "Every employee has a department"),
        not_null("country", "Every employee has a country"),
        unique("email", "No two employees share an e-mail address"),
        unique("employee_id", "No two employees share an id"),
        values_in_set(
            "employment_type", rules.valid_employment_types, "Employment type is a standard one"
        ),
        values_in_set("currency", tuple(rules.usd_rates), "Currency has a known rate"),
        regex("email", rules.email_pattern, "E-mail addresses are well formed"),
        regex("employee_id", rules.id_pattern, "Ids carry a company prefix and six digits"),
        numeric_range(df, "salary_usd_annual", low, high, "Yearly salary in USD is plausible"),
        date_range(
            "hire_date", rules.earliest_date, rules.as_of, "Hire date is not before 1970 or ahead"
        ),
        referential_integrity("manager_id", "employee_id", "Every manager is an employee"),
    ]


def customer_checks(rules: CustomerRules) -> list[Check]:
    """The 7 customer checks (Q10)."""
    return [
        not_null("email", "Every customer has an e-mail address"),
        not_null("first_name", "Every customer has a first name"),
        not_null("region", "Every customer has a region"),
        unique("email", "No two customers share an e-mail address", fold_email=False),
        regex("email", rules.email_pattern, "E-mail addresses are well formed"),
        values_in_set("region", rules.valid_regions, "Region is a standard one"),
        date_range(
            "registration_date", rules.earliest_date, rules.as_of,
            "Registration date is not before 2010 or ahead",
        ),
    ]


def employee_report(df: DataFrame, rules: EmployeeRules) -> DataFrame:
    return quality_report(df, employee_checks(df, rules), rules.pass_threshold)


def customer_report(df: DataFrame, rules: CustomerRules) -> DataFrame:
    return quality_report(df, customer_checks(rules), rules.pass_threshold)


def enforce_gate(report: DataFrame, max_failed: int) -> None:
    """Raise when more than ``max_failed`` checks fail, naming them (Q11).

    The report has one row per check, so collecting the failed ones is bounded.
    """
    failed = [r["check"] for r in report.where(F.col("status") == "FAIL").select("check").collect()]
    if len(failed) > max_failed:
        raise QualityGateError(
            f"{len(failed)} checks failed (limit {max_failed}): {', '.join(failed)}"
        )
