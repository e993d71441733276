"""Identifiers, priorities and provenance."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.config import UNKNOWN_PRIORITY, EmployeeRules
from recordloom.functions.text import lookup, strip


# the first digit run when it is at most 999999, without its leading zeros
_SIX_DIGITS = r"^\D*0*(\d{1,6})(?!\d)"


def namespaced_id(raw: Column, company: Column, prefixes: Mapping[str, str]) -> Column:
    """Company prefix and the first digit run, padded to six digits.

    Longer numbers must not reach ``lpad``, which would cut them.
    """
    digits = F.nullif(F.regexp_extract(raw.cast("string"), _SIX_DIGITS, 1), F.lit(""))
    prefix = lookup(F.lower(strip(company)), prefixes)
    return F.concat(prefix, F.lit("-"), F.lpad(digits, 6, "0"))


def unformattable(raw: Column, formatted: Column) -> Column:
    return raw.isNotNull() & formatted.isNull()


def with_ids(df: DataFrame, rules: EmployeeRules) -> DataFrame:
    """Namespaced employee and manager ids next to their raw texts."""
    if not {"employee_id", "company_origin"} <= set(df.columns):
        return df
    names = [n for n in ("employee_id", "manager_id") if n in df.columns]
    company = F.col("company_origin")
    raw = {f"{n}_raw": F.col(n) for n in names if f"{n}_raw" not in df.columns}
    ids = {n: namespaced_id(F.col(n), company, rules.id_prefixes) for n in names}
    return df.withColumns({**raw, **ids})


def source_priority(source: Column, priorities: Mapping[str, int]) -> Column:
    """Configured rank of a source; unknown and null come last."""
    return F.coalesce(lookup(source, priorities), F.lit(UNKNOWN_PRIORITY))


def duplicate_rank(raw_id: Column) -> Column:
    """1 for ids that carry a duplicate marker, which lose to plain ids."""
    return F.coalesce(raw_id.ilike("%dup%"), F.lit(False)).cast("int")


def provenance(sources: Column, priorities: Mapping[str, int]) -> Column:
    """Array of source names to a comma list in (priority, name) order."""
    names = F.array_distinct(F.transform(sources, lambda s: F.trim(s)))
    kept = F.filter(names, lambda s: s.isNotNull() & ~s.isin("", "nan", "<NA>"))
    ranked = F.sort_array(
        F.transform(kept, lambda s: F.struct(source_priority(s, priorities).alias("p"), s.alias("s")))
    )
    return F.array_join(F.transform(ranked, lambda r: r["s"]), ",")


def ensure_provenance(df: DataFrame) -> DataFrame:
    """Defaults for ``source_systems`` and ``dedup_method``."""
    systems = (
        F.coalesce("source_systems", "source_system")
        if "source_systems" in df.columns
        else F.col("source_system")
    )
    method = (
        F.coalesce(F.col("dedup_method"), F.lit("single_source"))
        if "dedup_method" in df.columns
        else F.lit("single_source")
    )
    filled = df.withColumns({"source_systems": systems, "dedup_method": method})
    promoted = F.col("source_systems").contains(",") & (F.col("dedup_method") == "single_source")
    return filled.withColumn(
        "dedup_method", F.when(promoted, F.lit("exact_id")).otherwise(F.col("dedup_method"))
    )
