"""Schemas, taxonomies, rates and thresholds of the two integration jobs.

Everything is frozen: a job gets its rules as an argument and never changes them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

POSITION = "_position"  # lineage column: where a record stood in its source file

# ---------------------------------------------------------------------------
# Column names, source tags, lookup maps, rates, patterns and
# thresholds below must equal the published data contract for right results.
# ---------------------------------------------------------------------------

EMPLOYEE_SCHEMA: Mapping[str, str] = {
    "employee_id": "string",
    "first_name": "string",
    "last_name": "string",
    "email": "string",
    "department": "string",
    "job_title": "string",
    "hire_date": "string",
    "country": "string",
    "employment_type": "string",
    "employment_status": "string",
    "manager_id": "string",
    "company_origin": "string",
    "source_system": "string",
    "base_salary": "string",
    "currency": "string",
    "pay_frequency": "string",
    "bonus_target_pct": "double",
    "payroll_effective_date": "string",
    "salary_usd_annual": "double",
    "benefits_enrolled": "boolean",
    "benefit_plans": "string",
    "benefit_plan_count": "bigint",
    "benefit_coverage_level": "string",
    "benefit_enrollment_date": "string",
    "premium_employee": "decimal(18,2)",
    "premium_employer": "decimal(18,2)",
}

DATE_COLUMNS = ("hire_date", "payroll_effective_date", "benefit_enrollment_date")

PAYROLL_FIELDS = (
    "base_salary",
    "currency",
    "pay_frequency",
    "bonus_target_pct",
    "payroll_effective_date",
    "salary_usd_annual",
)

BENEFIT_FIELDS = (
    "benefits_enrolled",
    "benefit_plans",
    "benefit_plan_count",
    "benefit_coverage_level",
    "benefit_enrollment_date",
    "premium_employee",
    "premium_employer",
)

# native column -> standard column, per source
EMPLOYEE_COLUMN_MAPS: Mapping[str, Mapping[str, str]] = {
    "globaltech_hris": {
        "employee_id": "employee_id",
        "first_name": "first_name",
        "last_name": "last_name",
        "email": "email",
        "department": "department",
        "job_title": "job_title",
        "hire_date": "hire_date",
        "country": "country",
        "employment_type": "employment_type",
        "manager_id": "manager_id",
    },
    "acquiredco_hris": {
        "employee_identifier": "employee_id",
        "name_first": "first_name",
        "name_last": "last_name",
        "contact_email": "email",
        "assignment_department": "department",
        "assignment_role": "job_title",
        "assignment_hire_timestamp": "hire_date",
        "assignment_location": "country",
        "employment_type": "employment_type",
        "employment_status": "employment_status",
        "manager_employee_id": "manager_id",
    },
    "payroll": {
        "employee_id": "employee_id",
        "source": "company_origin",
        "base_salary": "base_salary",
        "currency": "currency",
        "pay_frequency": "pay_frequency",
        "bonus_target_pct": "bonus_target_pct",
        "effective_date": "payroll_effective_date",
    },
    "benefits": {
        "employee_id": "employee_id",
        "plan_type": "benefit_plans",
        "coverage_level": "benefit_coverage_level",
        "enrollment_date": "benefit_enrollment_date",
        "premium_employee": "premium_employee",
        "premium_employer": "premium_employer",
    },
}

COMPANY_OF_SOURCE: Mapping[str, str] = {
    "globaltech_hris": "GlobalTech",
    "acquiredco_hris": "AcquiredCo",
    "benefits": "GlobalTech",
}

REQUIRED_COLUMNS: Mapping[str, tuple[str, ...]] = {
    "globaltech_hris": tuple(EMPLOYEE_COLUMN_MAPS["globaltech_hris"]),
    "acquiredco_hris": ("employee_identifier", "name_first", "name_last", "contact_email"),
    "payroll": tuple(EMPLOYEE_COLUMN_MAPS["payroll"]),
    "benefits": tuple(EMPLOYEE_COLUMN_MAPS["benefits"]),
}

ACQUIRED_JSON_ELEMENT = (
    "employee_identifier string, name struct<first: string, last: string>, "
    "contact struct<email: string>, "
    "assignment struct<department: string, role: string, hire_timestamp: string, "
    "location: string>, "
    "employment_type string, employment_status string, manager_employee_id string"
)

STANDARD_DEPARTMENTS = (
    "Business Development",
    "Communications",
    "Customer Success",
    "Data Science",
    "DevOps",
    "Engineering",
    "Finance",
    "Human Resources",
    "Information Technology",
    "Legal",
    "Manufacturing",
    "Marketing",
    "Operations",
    "Product",
    "Quality Assurance",
    "Sales",
    "Strategy",
    "Supply Chain",
)

CUSTOMER_SCHEMA: Mapping[str, str] = {
    "email": "string",
    "first_name": "string",
    "last_name": "string",
    "phone": "string",
    "region": "string",
    "registration_date": "timestamp_ntz",
    "opt_out": "string",
    "source": "string",
}

CRM_JSON_ELEMENT = (
    "id string, email string, profile struct<first_name: string, last_name: string>, "
    "phone string, region string, registration_date string, opt_out boolean, "
    "lifetime_value double"
)

ERP_LAYOUT: tuple[tuple[str, int, int], ...] = (
    ("customer_id", 0, 10),
    ("full_name", 10, 60),
    ("email", 60, 120),
    ("phone", 120, 140),
    ("region_code", 140, 145),
    ("registration_date", 145, 155),
    ("status", 155, 160),
)

# texts that delimited and fixed-width readers take as null (case-sensitive)
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
WEBSITE_NULL_TOKENS = (*NULL_TOKENS, "none")


@dataclass(frozen=True)
class EmployeeRules:
    """Rules of the employee job; ``as_of`` is the day the job treats as today."""

    as_of: dt.date
    companies: tuple[str, ...] = ("GlobalTech", "AcquiredCo")
    id_prefixes: Mapping[str, str] = field(
        default_factory=lambda: {"globaltech": "GT", "acquiredco": "AC"}
    )
    usd_rates: Mapping[str, float] = field(
        default_factory=lambda: {"USD": 1.00, "EUR": 1.09, "GBP": 1.27}
    )
    periods_per_year: Mapping[str, int] = field(
        default_factory=lambda: {"Annual": 1, "Monthly": 12, "Bi-Weekly": 26}
    )
    employment_types: Mapping[str, str] = field(
        default_factory=lambda: {
            "FT": "Full-Time",
            "FULL-TIME": "Full-Time",
            "FULL TIME": "Full-Time",
            "PT": "Part-Time",
            "PART-TIME": "Part-Time",
            "PART TIME": "Part-Time",
            "CONTRACTOR": "Contractor",
        }
    )
    valid_employment_types: tuple[str, ...] = ("Full-Time", "Part-Time", "Contractor")
    departments: Mapping[str, str] = field(
        default_factory=lambda: {
            **{name.upper(): name for name in STANDARD_DEPARTMENTS},
            "ENG-01": "Engineering",
            "MKT-03": "Marketing",
        }
    )
    source_priority: Mapping[str, int] = field(
        default_factory=lambda: {
            "globaltech_hris": 1,
            "acquiredco_hris": 1,
            "payroll": 2,
            "benefits": 3,
        }
    )
    email_pattern: str = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
    id_pattern: str = r"^(GT|AC)-\d{6}$"
    earliest_date: str = "1970-01-01"
    salary_range: tuple[float, float] = (15000, 2000000)
    fuzzy_threshold: int = 88
    fuzzy_window_days: int = 30
    pass_threshold: float = 0.95
    max_failed_checks: int = 2


@dataclass(frozen=True)
class CustomerRules:
    """Rules of the customer job."""

    as_of: dt.date
    regions: Mapping[str, str] = field(
        default_factory=lambda: {
            "us": "US", "usa": "US", "united states": "US", "north america": "US",
            "na": "US", "amer": "US", "america": "US",
            "eu": "EU", "europe": "EU", "emea": "EU", "eur": "EU", "european union": "EU",
            "apac": "APAC", "asia": "APAC", "asia pacific": "APAC",
            "ap": "APAC", "asia-pacific": "APAC",
        }
    )
    valid_regions: tuple[str, ...] = ("US", "EU", "APAC")
    source_priority: Mapping[str, int] = field(
        default_factory=lambda: {"crm": 1, "website": 2, "erp": 3, "marketing": 4}
    )
    email_pattern: str = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
    test_account_pattern: str = r"(?i)@test\.shopstream\.com$"
    earliest_date: str = "2010-01-01"
    pass_threshold: float = 0.95


UNKNOWN_PRIORITY = 99

# ------------------------- end of the fixed values -------------------------


def session(app: str = "recordloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs expect; used by tests, bench and examples.

    Cleaning many columns makes generated methods that the JVM would not compile; beyond its
    limit of 8000 bytes Spark then generates smaller ones. The whole job has more of them
    than the default cache of generated classes holds.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
