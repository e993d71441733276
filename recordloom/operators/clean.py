"""Cleaning of whole sources (F13, F18, F30); no shuffle except the F30 join."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.config import CustomerRules, EmployeeRules
from recordloom.functions.dates import iso_timestamp, with_dates
from recordloom.functions.identity import with_ids
from recordloom.functions.money import annualize
from recordloom.functions.text import (
    customer_email,
    customer_name,
    map_taxonomy,
    matches,
    person_name,
    phone_digits,
    region_code,
    squeezed,
    with_department,
)


def clean_employees(df: DataFrame, rules: EmployeeRules) -> DataFrame:
    """Names, ids, employment type, salary, department and dates of one source."""
    named = df.withColumns(
        {n: person_name(F.col(n)) for n in ("first_name", "last_name") if n in df.columns}
    )
    keyed = with_ids(named, rules)
    if "employment_type" in keyed.columns:
        keyed = keyed.withColumn(
            "employment_type", map_taxonomy(F.col("employment_type"), rules.employment_types)
        )
    paid = annualize(keyed, rules)
    placed = with_department(paid, rules.departments)
    return with_dates(placed, rules.as_of, rules.earliest_date)


def clean_all_employees(
    frames: Mapping[str, DataFrame], rules: EmployeeRules
) -> dict[str, DataFrame]:
    return {name: clean_employees(df, rules) for name, df in frames.items()}


def unknown_employment_types(df: DataFrame, rules: EmployeeRules) -> DataFrame:
    """Texts the employment-type map does not know, with their number of rows."""
    mapped = map_taxonomy(F.col("employment_type"), rules.employment_types)
    return (
        df.where(F.col("employment_type").isNotNull() & mapped.isNull())
        .groupBy("employment_type")
        .agg(F.count("*").alias("record_count"))
    )


def clean_customers(df: DataFrame, rules: CustomerRules) -> DataFrame:
    """E-mail, names, phone, region and date of stacked customer rows."""
    dated = df.schema["registration_date"].dataType.typeName().startswith("timestamp")
    date = F.col("registration_date")
    # null texts are no valid addresses, so validity needs only the squeezed text; filters on
    # it are moved to the scan and should not carry more than that
    return df.withColumns(
        {
            "email_raw": F.col("email"),
            "email": customer_email(F.col("email")),
            "first_name": customer_name(F.col("first_name")),
            "last_name": customer_name(F.col("last_name")),
            "phone": phone_digits(F.col("phone")),
            "region": region_code(F.col("region"), rules.regions),
            "registration_date": date.cast("timestamp_ntz") if dated else iso_timestamp(date),
            "email_valid": matches(squeezed(F.col("email")), rules.email_pattern),
        }
    )


def apply_inferred_regions(
    df: DataFrame, inferred: DataFrame, key: str, rules: CustomerRules
) -> DataFrame:
    """Fill null regions from a table of inferred values, never overwriting one.

    ``inferred`` has ``key`` and ``region``; ``key`` must be unique there. Only rows without
    a region take part in the join, each under its own key, so rows that need nothing do not
    move.
    """
    valid = inferred.where(F.col("region").isin(*rules.valid_regions)).select(
        F.col(key), F.col("region").alias("_inferred")
    )
    known = df.where(F.col("region").isNotNull()).withColumn("region_inferred", F.lit(False))
    filled = (
        df.where(F.col("region").isNull())
        .join(valid, key, "left")
        .withColumns(
            {"region": F.col("_inferred"), "region_inferred": F.col("_inferred").isNotNull()}
        )
        .select(*known.columns)
    )
    return known.unionByName(filled)
