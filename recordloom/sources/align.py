"""Schema alignment and stacking of sources."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recordloom.config import (
    COMPANY_OF_SOURCE,
    CUSTOMER_SCHEMA,
    EMPLOYEE_COLUMN_MAPS,
    EMPLOYEE_SCHEMA,
    POSITION,
)
from recordloom.functions.text import sql_literal, strip


def normalize_headers(names: Iterable[str]) -> list[str]:
    """Lower-case header names with one underscore per run of other characters."""
    lowered = (re.sub(r"\W", "_", name.strip().lower()) for name in names)
    return [re.sub(r"_+", "_", name).strip("_") for name in lowered]


def flatten_json(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested objects become ``parent_child`` columns; arrays stay as they are."""

    def leaves(schema: StructType, path: tuple[str, ...]) -> Iterable[Column]:
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, StructType) and f.name != POSITION:
                yield from leaves(f.dataType, here)
            else:
                quoted = ".".join(f"`{part}`" for part in here)
                yield F.col(quoted).alias(sep.join(here))

    return df.select(*leaves(df.schema, ()))


def _fit(df: DataFrame, schema: Mapping[str, str], fixed: Mapping[str, str]) -> DataFrame:
    """Exactly the columns of ``schema``, in order and typed; absent ones are null.

    ``fixed`` gives SQL expressions for columns that do not simply keep their value.
    """
    present = set(df.columns)

    def column(name: str, kind: str) -> str:
        value = fixed.get(name) or (f"try_cast(`{name}` AS {kind})" if name in present else f"CAST(NULL AS {kind})")
        return f"{value} AS `{name}`"

    lineage = [POSITION] if POSITION in present else []
    return df.selectExpr(*(column(n, k) for n, k in schema.items()), *lineage)


def align_employees(df: DataFrame, source: str) -> DataFrame:
    """One employee source in the 26-column standard schema."""
    if source not in EMPLOYEE_COLUMN_MAPS:
        raise ValueError(f"No column map for source {source!r}")
    renamed = df.withColumnsRenamed(dict(EMPLOYEE_COLUMN_MAPS[source]))
    fixed = {"source_system": sql_literal(source)}
    if source in COMPANY_OF_SOURCE:
        fixed["company_origin"] = sql_literal(COMPANY_OF_SOURCE[source])
    elif "company_origin" in renamed.columns:
        renamed = renamed.withColumn("company_origin", strip(F.col("company_origin").cast("string")))
    if source == "benefits":
        fixed["benefits_enrolled"] = "true"
        fixed["benefit_plan_count"] = "1L"
    return _fit(renamed, EMPLOYEE_SCHEMA, fixed)


def align_customers(df: DataFrame) -> DataFrame:
    """One customer source in the 8-column standard schema."""
    return _fit(df, CUSTOMER_SCHEMA, {})


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required columns that the frame lacks; reads the schema only."""
    return sorted(set(required) - set(df.columns))


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack frames by column name and keep duplicates."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
