"""Splitting bad records off a source (P1-P4, P6, D2) and their dead-letter form (K1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.config import POSITION
from recordloom.functions.text import is_blank

REJECT_SCHEMA = "source_system string, reason string, raw_record string"


def as_rejects(df: DataFrame, source: str, reason: str | Column) -> DataFrame:
    """Rejected records as (source, reason, record as JSON with its nulls)."""
    record = [f"`{c}`" for c in df.columns if c != POSITION]
    text = F.to_json(F.struct(*record), {"ignoreNullFields": "false"})
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return df.select(
        F.lit(source).alias("source_system"), reason.alias("reason"), text.alias("raw_record")
    )


def no_rejects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REJECT_SCHEMA)


def split_off(
    df: DataFrame, bad: Column, source: str, reason: str
) -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejects). A condition that is null does not reject."""
    flag = F.coalesce(bad, F.lit(False))
    return df.where(~flag), as_rejects(df.where(flag), source, reason)


def reject_missing_identity(
    df: DataFrame, source: str, column: str
) -> tuple[DataFrame, DataFrame]:
    """Null or blank identity."""
    return split_off(
        df, is_blank(F.col(column)), source, f"Missing required identity field: {column}"
    )


def reject_unknown_origin(
    df: DataFrame, source: str, column: str, companies: tuple[str, ...]
) -> tuple[DataFrame, DataFrame]:
    """Origin that is not exactly a known company; null and padded texts fail too."""
    known = F.coalesce(F.col(column).isin(*companies), F.lit(False))
    return split_off(df, ~known, source, "Unknown payroll company source")


def reject_unformattable_ids(df: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose id could not be namespaced: they have no key to group by."""
    return split_off(df, F.col("employee_id").isNull(), source, "Unformattable employee id")


def drop_test_accounts(df: DataFrame, pattern: str, column: str = "email") -> DataFrame:
    """Without rows whose address matches; rows with no address stay."""
    return df.where(~F.coalesce(F.col(column).rlike(pattern), F.lit(False)))
