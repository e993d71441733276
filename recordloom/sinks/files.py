"""Files that a run leaves behind.

All writers are Spark jobs. A report of a few rows goes to one file; anything that grows
with the data keeps its partitions.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.fuzzy import REVIEW_COLUMNS, review_order
from recordloom.sources.align import union_sources

_CSV = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}

# Columns of the review files
GHOST_COLUMNS = (
    "payroll_employee_id",
    "name",
    "salary_usd_annual",
    "ghost_flag_reason",
    "ghost_employee",
    "company_origin",
    "source_system",
)
UNMAPPED_COLUMNS = ("source_system", "company_origin", "department_original", "record_count")


def write_review_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Replace a review file; the header is there even when there are no rows (K2)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**_CSV).csv(path)
    return path


def stamp_dead_letters(rejects: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    moment = (at or dt.datetime.now(dt.timezone.utc)).isoformat()
    return rejects.select(
        F.lit(moment).alias("rejected_at_utc"), "source_system", "reason", "raw_record"
    )


def write_dead_letters(rejects: DataFrame, path: str) -> str:
    """Append rejected records, one folder per source; no rows leave no files (K1)."""
    stamped = stamp_dead_letters(rejects)
    stamped.write.mode("append").partitionBy("source_system").options(**_CSV).csv(path)
    return path


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    schema = "rejected_at_utc string, reason string, raw_record string, source_system string"
    return spark.read.schema(schema).options(**_CSV).csv(path, multiLine=True)


def unmapped_departments(frames: Iterable[DataFrame]) -> DataFrame:
    """Department texts that the map does not know, with their rows."""
    flagged = [
        df.where(F.col("department_unmapped")).select(*UNMAPPED_COLUMNS[:3])
        for df in frames
        if "department_unmapped" in df.columns
    ]
    return (
        union_sources(flagged)
        .groupBy(*UNMAPPED_COLUMNS[:3])
        .agg(F.count("*").alias("record_count"))
        .orderBy("source_system", "department_original", "company_origin")
    )


def write_unmapped(frames: Iterable[DataFrame], path: str) -> str:
    return write_review_csv(unmapped_departments(frames), path)


def write_ghosts(ghosts: DataFrame, path: str) -> str:
    """Payroll ids without an employee (K4)."""
    return write_review_csv(ghosts.select(*GHOST_COLUMNS), path)


def write_probable_matches(matches: DataFrame, path: str) -> str:
    """Pairs for review, best first (K5)."""
    kept = [c for c in REVIEW_COLUMNS if c in matches.columns]
    return write_review_csv(review_order(matches).select(*kept), path)


def write_quality_report(report: DataFrame, path: str) -> str:
    """The check table, one row per check (K6)."""
    return write_review_csv(report, path, single_file=True)


_VERSIONS = "number long, folder string"


def golden_versions(spark: SparkSession, path: str) -> DataFrame:
    """The complete versions of a golden table; empty where there is none yet."""
    try:
        return spark.read.schema(_VERSIONS).parquet(f"{path}/_versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _VERSIONS)


def current_version(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """Number and folder of the version that readers follow."""
    latest = golden_versions(spark, path).agg(F.max(F.struct("number", "folder")).alias("v")).first()["v"]
    return latest and (latest.number, latest.folder)


def write_golden(
    employees: DataFrame, path: str, partition: str = "company_origin"
) -> str:
    """Replace the golden table, one folder per company (K7).

    A version is written to a folder of its own; only when it is complete a line in
    ``_versions`` names it, by an append that Spark commits as a whole. A job that is killed
    while writing leaves the version before in place, for readers that are at work too.
    ``read_golden`` follows the last line. Older version folders can be deleted.
    """
    if partition not in employees.columns:
        raise KeyError(f"Golden table needs a {partition} column")
    spark = employees.sparkSession
    before = current_version(spark, path)
    number = before[0] + 1 if before else 1
    folder = f"version={number}-{uuid.uuid4().hex[:8]}"
    named = employees.fillna("Unknown", [partition])
    (
        named.write.mode("errorifexists")
        .option("compression", "snappy")
        .partitionBy(partition)
        .parquet(f"{path}/{folder}")
    )
    line = spark.createDataFrame([(number, folder)], _VERSIONS).coalesce(1)
    line.write.mode("append").parquet(f"{path}/_versions")
    return path


def write_golden_customers(customers: DataFrame, folder: str) -> dict[str, str]:
    """Golden customers as gzip Parquet and as CSV (K8)."""
    parquet, csv = f"{folder}/golden_customers.parquet", f"{folder}/golden_customers.csv"
    customers.write.mode("overwrite").option("compression", "gzip").parquet(parquet)
    write_review_csv(customers, csv)
    return {"parquet": parquet, "csv": csv}


def write_summary(spark: SparkSession, lines: Sequence[tuple[str, int]], path: str) -> str:
    """Numbers and warnings of a run, in their order."""
    table = spark.createDataFrame(list(lines), "metric string, value long")
    return write_review_csv(table, path, single_file=True)


def stringify(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as text, for sources whose column types differ from file to file (K9)."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})
