"""The customer job: three sources to one golden table, without a gate."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.config import CustomerRules
from recordloom.operators.clean import clean_customers
from recordloom.operators.profile import (
    contribution_by_source,
    email_validity,
    field_completeness,
    monthly_registrations,
    opt_out_rate_by_region,
    value_counts,
)
from recordloom.operators.quality import customer_report
from recordloom.operators.resolve import merge_customers
from recordloom.plans.staging import Counts, stage_folder, staged
from recordloom.sinks import files
from recordloom.sources.align import union_sources
from recordloom.sources.readers import ingest_customer_sources


def resolve_customers(raw: DataFrame, rules: CustomerRules) -> DataFrame:
    """Clean stacked customer rows and merge them by address."""
    return merge_customers(clean_customers(raw, rules), rules)


def profile_customers(customers: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the profile charts."""
    return {
        "customers_by_region": value_counts(customers, "region"),
        "monthly_registrations": monthly_registrations(customers),
        "contribution_by_source": contribution_by_source(customers),
        "field_completeness": field_completeness(customers),
        "email_validity": email_validity(customers),
        "opt_out_rate_by_region": opt_out_rate_by_region(customers),
    }


def integrate_customers(
    spark: SparkSession, paths: Mapping[str, str], output: str, rules: CustomerRules
) -> dict[str, str]:
    """Read, merge, check, profile and write; the merged table is written once and reread.

    Every source is parsed once. Over-long website lines are dead-lettered, as in the employee
    job, and the run summary has the rows of sources and results, the check outcomes and
    warnings; its numbers were counted while the tables were written.
    """
    stage = stage_folder(spark, f"{output}/_stage")
    counts = Counts()
    read = ingest_customer_sources(spark, paths, rules, stage)
    per_source = {n: F.count_if(F.col("source") == n) for n in read}
    stacked = union_sources(got.frame for got in read.values())
    raw = staged(counts.watch(stacked, "customer_records", per_source), stage, "stacked")
    merged = counts.watch(resolve_customers(raw, rules), "golden_customers")
    customers = staged(merged, stage, "customers")
    checks = staged(customer_report(customers, rules), stage, "report")
    report = files.write_quality_report(checks, f"{output}/quality_report")
    profiles = {
        name: files.write_review_csv(df, f"{output}/profile/{name}", single_file=True)
        for name, df in profile_customers(customers).items()
    }
    rejects = union_sources(got.rejects for got in read.values())
    letters = files.write_dead_letters(rejects, f"{output}/dead_letters")
    seen = counts.seen
    website = read["website"].seen
    lines = [(n, seen[n]) for n in (*read, "customer_records", "golden_customers")]
    lines += [("test_accounts_removed", website["test_accounts"])]
    outcomes = Counter(r.status for r in checks.select("status").collect())
    lines += [(f"checks:{status}", n) for status, n in sorted(outcomes.items())]
    lines += [(f"warning:empty source {n}", 0) for n in read if not seen[n]]
    malformed = website["rows_rejected"] - website["test_accounts"]
    lines += [("warning:malformed lines in website", malformed)] if malformed else []
    summary = files.write_summary(spark, lines, f"{output}/run_summary")
    reports = {"quality_report": report, "dead_letters": letters, "run_summary": summary}
    return {**reports, **files.write_golden_customers(customers, output), **profiles}
