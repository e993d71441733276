"""The employee job: four sources to one golden table."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.config import EmployeeRules
from recordloom.functions.identity import ensure_provenance, unformattable
from recordloom.operators.clean import clean_all_employees
from recordloom.operators.fuzzy import probable_matches
from recordloom.operators.profile import (
    check_outcomes,
    column_profile,
    enrolment_rate_by_department,
    headcount_by_country,
    headcount_by_department,
    run_summary,
    salary_distribution,
    tenure_histogram,
    tenure_median,
)
from recordloom.operators.quality import employee_report, enforce_gate
from recordloom.operators.quarantine import reject_unformattable_ids
from recordloom.operators.resolve import (
    collapse_by_id,
    consumed_ids,
    detect_ghosts,
    employee_ids,
    match_exact_ids,
    merge_by_email,
    source_frames,
)
from recordloom.plans.staging import Counts, stage_folder, staged
from recordloom.sinks import files
from recordloom.sinks.files import write_summary
from recordloom.sources.align import union_sources
from recordloom.sources.readers import Ingested, ingest_employees

COLUMN_DESCRIPTIONS: Mapping[str, str] = {
    "employee_id": "Company prefix and six digits; unique in this table",
    "first_name": "Given name in normal form and title case",
    "last_name": "Family name in normal form and title case",
    "email": "Work address; rows of two companies with one address are merged",
    "department": "Standard department name",
    "job_title": "Job title as the HR system has it",
    "hire_date": "Hire date",
    "country": "Country of the workplace",
    "employment_type": "Full-Time, Part-Time or Contractor",
    "employment_status": "Status, where the HR system has one",
    "manager_id": "Id of the manager in the same form as employee_id",
    "company_origin": "Company, and the partition of this table",
    "source_system": "HR system of the surviving record",
    "base_salary": "Salary text as payroll has it",
    "currency": "Currency of base_salary",
    "pay_frequency": "How often base_salary is paid",
    "bonus_target_pct": "Bonus target in percent",
    "payroll_effective_date": "Latest effective date among the payroll records",
    "salary_usd_annual": "Yearly salary in USD at the fixed rates",
    "benefits_enrolled": "Whether there is any benefit enrolment",
    "benefit_plans": "Plans of all enrolments in date order",
    "benefit_plan_count": "Number of enrolments that name a plan",
    "benefit_coverage_level": "Coverage levels of all enrolments in date order",
    "benefit_enrollment_date": "Date of the first enrolment",
    "premium_employee": "Sum of the employee's premiums",
    "premium_employer": "Sum of the employer's premiums",
    "employee_id_raw": "Employee id as the source has it",
    "manager_id_raw": "Manager id as the source has it",
    "department_original": "Department text before mapping",
    "department_unmapped": "Whether the department text is not in the map",
    "hire_date_invalid": "Whether the hire date is unreadable or out of range",
    "payroll_effective_date_invalid": "The same for the payroll date of the HR record",
    "benefit_enrollment_date_invalid": "The same for the enrolment date of the HR record",
    "source_systems": "All sources that contributed to the row",
    "dedup_method": "exact_id, email_match or single_source",
}


_RESOLVED_BY = (
    "employee_id", "email", "company_origin", "source_system", "source_systems", "dedup_method"
)
DEDUP_METHODS = ("exact_id", "email_match", "single_source")


@dataclass(frozen=True)
class Resolved:
    """Result of identity resolution; pairs for review only where they were asked for."""

    employees: DataFrame
    ghosts: DataFrame
    probable_matches: DataFrame | None = None
    crosswalk: DataFrame | None = None


def resolve_employees(
    frames: Mapping[str, DataFrame],
    rules: EmployeeRules,
    folder: str | None = None,
    counts: Counts | None = None,
    columns: Collection[str] = (),
) -> Resolved:
    """Exact ids, ghosts and e-mail merge (R2); pairs for review come from the employees.

    With a ``folder`` the employees are written after the exact-id and after the e-mail
    step, because both results are read several times; without one the plan stays lazy.
    Where ``columns`` are given only these, and those that resolution itself reads, are
    worked out and written.
    """
    source_frames(frames)
    keep = (lambda df, name: staged(df, folder, name)) if folder else (lambda df, name: df)
    hris = union_sources([frames["globaltech_hris"], frames["acquiredco_hris"]])
    matched = match_exact_ids(hris, frames["payroll"], frames["benefits"], rules)
    if columns:
        matched = matched.select(*(c for c in matched.columns if c in {*columns, *_RESOLVED_BY}))
    exact = keep(matched, "exact")
    # ids and addresses come from a written table, or else from the plan without enrichment
    spine = exact if folder else collapse_by_id(hris, rules)
    ghosts = detect_ghosts(frames["payroll"], employee_ids(spine))
    employees = ensure_provenance(merge_by_email(exact, rules, spine))
    if counts is not None and folder:
        methods = {f"method:{m}": F.count_if(F.col("dedup_method") == m) for m in DEDUP_METHODS}
        employees = counts.watch(employees, "golden_employees", methods)
    merged = keep(employees, "employees")
    return Resolved(merged, ghosts, crosswalk=consumed_ids(spine, rules))


def profile_employees(
    employees: DataFrame, report: DataFrame, rules: EmployeeRules
) -> dict[str, DataFrame]:
    """The tables behind the profile charts."""
    return {
        "headcount_by_department": headcount_by_department(employees),
        "headcount_by_country": headcount_by_country(employees),
        "salary_by_employment_type": salary_distribution(employees, rules),
        "tenure_histogram": tenure_histogram(employees, rules.as_of),
        "tenure_median": tenure_median(employees, rules.as_of),
        "enrolment_rate_by_department": enrolment_rate_by_department(employees),
        "check_outcomes": check_outcomes(report),
    }


@dataclass
class EmployeeJob:
    """The stages of the job; each runs the ones before it when it gets no input.

    ``output`` and the stage folder must be on storage that every executor can reach.
    """

    spark: SparkSession
    paths: Mapping[str, str]
    output: str
    rules: EmployeeRules
    payroll_format: str = "parquet"
    stage: str = field(default="")
    counts: Counts = field(default_factory=Counts, compare=False)
    read: dict[str, Ingested] = field(default_factory=dict, compare=False)

    def __post_init__(self) -> None:
        self.stage = self.stage or stage_folder(self.spark, f"{self.output}/_stage")

    def ingest(self) -> dict[str, DataFrame]:
        """Each source is parsed once; its rows and its rejects come from the written result."""
        self.read = ingest_employees(
            self.spark, self.paths, self.rules, self.payroll_format, self.stage
        )
        rejects = union_sources(got.rejects for got in self.read.values())
        files.write_dead_letters(rejects, f"{self.output}/dead_letters")
        return {name: got.frame for name, got in self.read.items()}

    def clean(self, frames: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
        """Cleaned sources, written once: the later stages read them several times."""
        lazy = clean_all_employees(self.ingest() if frames is None else frames, self.rules)
        lost = F.count_if(unformattable(F.col("manager_id_raw"), F.col("manager_id")))
        watched = {
            name: self.counts.watch(df, name, {f"unformattable_manager_ids:{name}": lost})
            for name, df in lazy.items()
        }
        cleaned = {name: staged(df, self.stage, name) for name, df in watched.items()}
        files.write_unmapped(cleaned.values(), f"{self.output}/unmapped_departments")
        return cleaned

    def resolve(self, cleaned: Mapping[str, DataFrame] | None = None) -> Resolved:
        cleaned = self.clean() if cleaned is None else cleaned
        lost = [reject_unformattable_ids(df, name)[1] for name, df in cleaned.items()]
        files.write_dead_letters(union_sources(lost), f"{self.output}/dead_letters")
        found = resolve_employees(cleaned, self.rules, self.stage, self.counts)
        pairs = self.counts.watch(probable_matches(found.employees, self.rules), "probable_matches")
        matches = staged(pairs, self.stage, "matches")
        ghosts = staged(self.counts.watch(found.ghosts, "ghost_employees"), self.stage, "ghosts")
        files.write_ghosts(ghosts, f"{self.output}/ghost_employees")
        files.write_probable_matches(matches, f"{self.output}/probable_matches")
        crosswalk = staged(self.counts.watch(found.crosswalk, "consumed_ids"), self.stage, "crosswalk")
        files.write_review_csv(crosswalk, f"{self.output}/id_crosswalk")
        return Resolved(found.employees, ghosts, matches, crosswalk)

    def validate(self, employees: DataFrame | None = None, gate: bool = True) -> DataFrame:
        """The report is written before the gate may raise."""
        employees = self.resolve().employees if employees is None else employees
        path = files.write_quality_report(
            employee_report(employees, self.rules), f"{self.output}/quality_report"
        )
        report = self.spark.read.csv(path, header=True, inferSchema=False, escape='"').selectExpr(
            "check", "description", "cast(total as bigint) total", "cast(passed as bigint) passed",
            "cast(failed as bigint) failed", "cast(pass_rate as double) pass_rate", "status",
        )
        if gate:
            enforce_gate(report, self.rules.max_failed_checks)
        return report

    def profile(
        self, employees: DataFrame | None = None, report: DataFrame | None = None
    ) -> dict[str, str]:
        employees = self.resolve().employees if employees is None else employees
        report = self.validate(employees, gate=False) if report is None else report
        tables = profile_employees(employees, report, self.rules)
        return {
            name: files.write_review_csv(df, f"{self.output}/profile/{name}", single_file=True)
            for name, df in tables.items()
        }

    def publish(
        self,
        employees: DataFrame | None = None,
        ghosts: DataFrame | None = None,
        matches: DataFrame | None = None,
    ) -> dict[str, str]:
        """Review files, golden table and column table, in that order."""
        if employees is None or ghosts is None:
            found = self.resolve()
            employees = found.employees if employees is None else employees
            ghosts = found.ghosts if ghosts is None else ghosts
        matches = probable_matches(employees, self.rules) if matches is None else matches
        columns = column_profile(employees, COLUMN_DESCRIPTIONS, key="employee_id")
        return {
            "ghost_employees": files.write_ghosts(ghosts, f"{self.output}/ghost_employees"),
            "probable_matches": files.write_probable_matches(
                matches, f"{self.output}/probable_matches"
            ),
            "golden_employees": files.write_golden(employees, f"{self.output}/golden_employees"),
            "columns": files.write_review_csv(columns, f"{self.output}/columns", single_file=True),
        }

    def run(self) -> dict[str, str]:
        """All stages in order; a failed gate stops before profile and golden table."""
        cleaned = self.clean(self.ingest())
        found = self.resolve(cleaned)
        report = self.validate(found.employees)
        profiles = self.profile(found.employees, report)
        published = self.publish(found.employees, found.ghosts, found.probable_matches)
        summary = self.summarize(cleaned, found, report)
        return {**published, **profiles, "run_summary": summary}

    def summarize(
        self, cleaned: Mapping[str, DataFrame], found: Resolved, report: DataFrame
    ) -> str:
        """Rows of sources and results, methods, check outcomes and warnings.

        All numbers were counted while the tables were written; only the quality report, one row
        per check, and the documents' table, one row per file, are read. Frames that this job
        has not written itself are counted.
        """
        results = {
            "golden_employees": found.employees,
            "ghost_employees": found.ghosts,
            "probable_matches": found.probable_matches,
        }
        seen = self.counts.seen
        uncounted = {n: df for n, df in {**cleaned, **results}.items() if n not in seen}
        if uncounted:
            seen = seen | {r.metric: r.value for r in run_summary(uncounted, {}).collect()}
        names = [*cleaned, *results, *(f"method:{m}" for m in DEDUP_METHODS if seen.get(f"method:{m}"))]
        names += [n for n in ("consumed_ids",) if n in seen]
        lines = [(name, seen[name]) for name in names]
        outcomes = Counter(r.status for r in report.select("status").collect())
        lines += [(f"checks:{status}", n) for status, n in sorted(outcomes.items())]
        # a source that cannot be read has been dead-lettered and counts as empty
        lines += [(f"warning:empty source {n}", 0) for n in cleaned if not seen[n]]
        for name in cleaned:
            lost = seen.get(f"unformattable_manager_ids:{name}")
            lines += [(f"warning:unformattable manager ids in {name}", lost)] if lost else []
        for got in self.read.values():
            for r in got.stated.collect() if got.stated is not None else []:
                lines.append((f"warning:stated {r.total_records} records in {r.file}", r.actual_records))
        return write_summary(self.spark, lines, f"{self.output}/run_summary")
