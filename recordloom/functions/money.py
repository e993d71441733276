"""Money parsing and annualisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.config import EmployeeRules
from recordloom.functions.text import lookup, normalize_text, strip


def two_places(c: Column) -> Column:
    """Round half to even on the scaled double."""
    return F.rint(c * 100) / 100


def parse_money(c: Column) -> Column:
    """Amount with symbols and separators removed; ``(x)`` is negated (F8)."""
    text = c.cast("string")
    amount = F.regexp_replace(text, r"[^\d.\-]", "").try_cast("double")
    return amount * F.when(strip(text).rlike(r"^\(.*\)$"), -1.0).otherwise(1.0)


def clip_upper(c: Column, limit: float) -> Column:
    """Cap at ``limit``; null stays null."""
    return F.when(c > limit, F.lit(limit).cast("double")).otherwise(c)


def pay_frequency_label(c: Column, rules: EmployeeRules) -> Column:
    labels = {label.lower(): label for label in rules.periods_per_year}
    return lookup(F.lower(normalize_text(c)), labels)


def annualize(df: DataFrame, rules: EmployeeRules) -> DataFrame:
    """``salary_usd_annual`` from amount, currency and pay frequency."""
    if not {"base_salary", "currency", "pay_frequency"} <= set(df.columns):
        return df
    currency = F.upper(strip(F.col("currency")))
    frequency = pay_frequency_label(F.col("pay_frequency"), rules)
    # the labels are worked out first so that amount, rate and periods read plain columns
    labelled = df.withColumns({"currency": currency, "pay_frequency": frequency})
    usd = (
        parse_money(F.col("base_salary"))
        * lookup(F.col("currency"), rules.usd_rates)
        * lookup(F.col("pay_frequency"), rules.periods_per_year)
    )
    return labelled.withColumn("salary_usd_annual", two_places(usd))


def salary_issues(df: DataFrame, rules: EmployeeRules) -> DataFrame:
    """One row: how many salaries cannot be annualised, and why.

    Takes raw or annualised rows: labels are fixed points of their own normalisation.
    """
    currency = F.upper(strip(F.col("currency")))
    frequency = pay_frequency_label(F.col("pay_frequency"), rules)
    rows = df.where(F.col("base_salary").isNotNull()).select(
        parse_money(F.col("base_salary")).isNull().alias("bad_salary"),
        lookup(currency, rules.usd_rates).isNull().alias("bad_currency"),
        frequency.isNull().alias("bad_frequency"),
        currency.alias("currency"),
    )
    # distinct unknown currencies are taken out of per-currency counts, so that the
    # shuffle carries one row per currency and task
    per_currency = rows.groupBy("currency", "bad_currency").agg(
        F.count_if("bad_salary").alias("invalid_salary"),
        F.count_if("bad_currency").alias("unknown_currency"),
        F.count_if("bad_frequency").alias("unknown_frequency"),
    )
    return per_currency.agg(
        F.coalesce(F.sum("invalid_salary"), F.lit(0)).alias("invalid_salary"),
        F.coalesce(F.sum("unknown_currency"), F.lit(0)).alias("unknown_currency"),
        F.coalesce(F.sum("unknown_frequency"), F.lit(0)).alias("unknown_frequency"),
        F.array_join(
            F.sort_array(F.collect_set(F.when(F.col("bad_currency"), F.col("currency")))), ","
        ).alias("unknown_currencies"),
    )
