"""Queries over the employee operators and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.config import EMPLOYEE_SCHEMA, PAYROLL_FIELDS, POSITION
from recordloom.functions import dates, identity, money, text
from recordloom.operators import clean, fuzzy, profile, quality, quarantine, resolve
from recordloom.plans.employees import COLUMN_DESCRIPTIONS, resolve_employees
from recordloom.plans.staging import stage_folder, staged
from recordloom.sinks.files import unmapped_departments
from recordloom.sources.align import align_employees, union_sources
from workload import oracle as o
from workload.inputs import AS_OF, EMPLOYEE_RULES as RULES, source, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

HRIS = ("globaltech_hris", "acquiredco_hris")


def add(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- inputs -----------------------------------------------------------------


def kept(spark: SparkSession, sf: str, name: str) -> tuple[DataFrame, DataFrame]:
    """A source after quarantine, in its own columns, and its rejects."""
    raw = source(spark, sf, name)
    if name == "acquiredco_hris":
        return quarantine.reject_missing_identity(raw, name, "employee_identifier")
    good, no_id = quarantine.reject_missing_identity(raw, name, "employee_id")
    if name != "payroll":
        return good, no_id
    good, no_company = quarantine.reject_unknown_origin(good, name, "source", RULES.companies)
    return good, no_id.unionByName(no_company)


def aligned(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    names = (*HRIS, "payroll", "benefits")
    return {n: align_employees(kept(spark, sf, n)[0], n) for n in names}


def cleaned(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return clean.clean_all_employees(aligned(spark, sf), RULES)


def clean_one(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return clean.clean_employees(align_employees(kept(spark, sf, name)[0], name), RULES)


def hris(spark: SparkSession, sf: str) -> DataFrame:
    return union_sources([clean_one(spark, sf, n) for n in HRIS])


def exact(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.match_exact_ids(
        hris(spark, sf), clean_one(spark, sf, "payroll"), clean_one(spark, sf, "benefits"), RULES
    )


def employees(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Resolved employees, written once for the several passes that most queries make.

    With ``columns`` the written tables have only these and what resolution reads.
    """
    frames = cleaned(spark, sf)
    return resolve_employees(frames, RULES, stage_folder(spark), columns=columns).employees


#: columns that the employee checks read
CHECKED = (
    "employee_id", "first_name", "last_name", "email", "department", "country", "employment_type",
    "currency", "salary_usd_annual", "hire_date", "manager_id",
)


def shown(df: DataFrame) -> DataFrame:
    """Decimals as doubles, without file positions."""
    money_columns = [c for c, k in df.dtypes if k.startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in money_columns}).drop(POSITION)


# --- sources, alignment, quarantine -----------------------------------------


@add(
    "u_align",
    o.query(
        " UNION ALL BY NAME ".join(
            f"SELECT * EXCLUDE (premium_employee, premium_employer{', _position' if n != 'benefits' else ''}), "
            f"CAST(premium_employee AS DOUBLE) AS premium_employee, CAST(premium_employer AS DOUBLE) AS premium_employer FROM std_{n}"
            for n in (*HRIS, "payroll", "benefits")
        )
    ),
)
def u_align(spark, sf):
    """Four sources in the standard columns, stacked."""
    return shown(union_sources([df.drop(POSITION) for df in aligned(spark, sf).values()]))


_REJECTS = """SELECT '{s}' AS source_system, '{r}' AS reason, to_json({{{cells}}}) AS raw_record FROM raw_{s} WHERE {w}"""


def _reject_sql(s: str, reason: str, where: str) -> str:
    from workload.inputs import SOURCES

    cells = ", ".join(f"'{c}': {c}" for c in SOURCES[s][1] if c != "_position")
    return _REJECTS.format(s=s, r=reason, cells=cells, w=where)


_NO_ID = "trim(coalesce(employee_id, '')) = ''"


@add(
    "p_quarantine",
    o.query(
        f"SELECT source_system, reason, CAST(raw_record AS VARCHAR) AS raw_record FROM ({_reject_sql('globaltech_hris', 'Missing required identity field: employee_id', _NO_ID)}"
        f" UNION ALL {_reject_sql('payroll', 'Missing required identity field: employee_id', _NO_ID)} UNION ALL "
        + _reject_sql("payroll", "Unknown payroll company source", f"NOT ({_NO_ID}) AND NOT coalesce(source IN ('GlobalTech', 'AcquiredCo'), false)")
        + ")"
    ),
)
def p_quarantine(spark, sf):
    """Rejected rows as JSON with their reasons."""
    return union_sources([kept(spark, sf, n)[1] for n in (*HRIS, "payroll")])


@add(
    "p_unformattable_ids",
    o.query(
        " UNION ALL ".join(
            f"SELECT '{n}' AS source_system, employee_id_raw, company_origin FROM cln_{n} WHERE employee_id IS NULL"
            for n in (*HRIS, "payroll", "benefits")
        )
    ),
)
def p_unformattable_ids(spark, sf):
    """Rows that have no usable key after cleaning."""
    return union_sources(
        [
            df.where(F.col("employee_id").isNull()).select("source_system", "employee_id_raw", "company_origin")
            for df in cleaned(spark, sf).values()
        ]
    )


@add(
    "p_filters",
    o.query(
        r"""SELECT count(*) FILTER (WHERE regexp_matches(base_salary, '[$£€]')) AS with_symbol,
        count(*) FILTER (WHERE regexp_matches(employee_id, '^(GT|AC)-\d{6}$')) AS canonical_ids,
        (SELECT count(*) FROM hris WHERE department_unmapped) AS unmapped,
        (SELECT count(*) FROM exact WHERE source_systems LIKE '%,%') AS multi_source FROM cln_payroll"""
    ),
)
def p_filters(spark, sf):
    """P7, P8, P9, P12 as counts."""
    pay = clean_one(spark, sf, "payroll").agg(
        F.count_if(text.has_currency_symbol(F.col("base_salary"))).alias("with_symbol"),
        F.count_if(text.matches(F.col("employee_id"), RULES.id_pattern)).alias("canonical_ids"),
    )
    unmapped = hris(spark, sf).where("department_unmapped").agg(F.count("*").alias("n"))
    several = resolve.multi_source(exact(spark, sf)).agg(F.count("*").alias("n"))
    return pay.withColumns({"unmapped": unmapped.scalar(), "multi_source": several.scalar()})


# --- scalar functions ---------------------------------------------------------


@add("f_ids", o.query("SELECT employee_id_raw, manager_id_raw, company_origin, employee_id, manager_id FROM hris UNION ALL SELECT employee_id_raw, manager_id_raw, company_origin, employee_id, manager_id FROM cln_payroll"))
def f_ids(spark, sf):
    """F4, F5."""
    frames = [identity.with_ids(df, RULES) for n, df in aligned(spark, sf).items() if n != "benefits"]
    return union_sources(frames).select("employee_id_raw", "manager_id_raw", "company_origin", "employee_id", "manager_id")


_FULL = "trim(coalesce({f}, '') || ' ' || coalesce({l}, ''))"


@add("f_names", o.query(f"SELECT employee_id_raw, first_name, last_name, {_FULL.format(f='first_name', l='last_name')} AS full_name FROM hris"))
def f_names(spark, sf):
    """F1, F2, F20."""
    frames = [df for n, df in aligned(spark, sf).items() if n in HRIS]
    names = union_sources(frames).select(
        F.col("employee_id").alias("employee_id_raw"),
        text.person_name(F.col("first_name")).alias("first_name"),
        text.person_name(F.col("last_name")).alias("last_name"),
    )
    return names.withColumn("full_name", text.full_name(F.col("first_name"), F.col("last_name")))


@add("f_taxonomy", o.query("SELECT employee_id_raw, employment_type, department, department_original, department_unmapped FROM hris"))
def f_taxonomy(spark, sf):
    """F6, F7."""
    rows = union_sources([df for n, df in aligned(spark, sf).items() if n in HRIS])
    mapped = text.with_department(rows, RULES.departments)
    return mapped.select(
        F.col("employee_id").alias("employee_id_raw"),
        text.map_taxonomy(F.col("employment_type"), RULES.employment_types).alias("employment_type"),
        "department", "department_original", "department_unmapped",
    )


@add("f_unknown_types", o.query("SELECT employment_type, count(*) AS record_count FROM (SELECT employment_type FROM std_globaltech_hris UNION ALL SELECT employment_type FROM std_acquiredco_hris) WHERE employment_type = 'temp' GROUP BY 1"))
def f_unknown_types(spark, sf):
    """texts of both HR sources that the map does not know."""
    frames = aligned(spark, sf)
    return clean.unknown_employment_types(union_sources([frames[n] for n in HRIS]), RULES)


@add("f_money", o.query("SELECT _position AS row_id, base_salary, currency, pay_frequency, salary_usd_annual FROM cln_payroll"))
def f_money(spark, sf):
    """F8, F9."""
    return money.annualize(aligned(spark, sf)["payroll"], RULES).select(
        F.col(POSITION).alias("row_id"), "base_salary", "currency", "pay_frequency", "salary_usd_annual"
    )


@add(
    "f_salary_issues",
    o.query(
        f"""SELECT count(*) FILTER (WHERE ({o.money('base_salary')}) IS NULL) AS invalid_salary,
        count(*) FILTER (WHERE coalesce(currency NOT IN ('USD', 'EUR', 'GBP'), true)) AS unknown_currency,
        count(*) FILTER (WHERE pay_frequency IS NULL) AS unknown_frequency,
        coalesce(string_agg(DISTINCT currency, ',' ORDER BY currency) FILTER (WHERE currency NOT IN ('USD', 'EUR', 'GBP')), '') AS unknown_currencies
        FROM cln_payroll WHERE base_salary IS NOT NULL"""
    ),
)
def f_salary_issues(spark, sf):
    """F10."""
    return money.salary_issues(aligned(spark, sf)["payroll"], RULES)


@add("f_dates", o.query("SELECT _position AS row_id, source_system, hire_date, hire_date_invalid FROM hris"))
def f_dates(spark, sf):
    """F11, F12."""
    rows = union_sources([df for n, df in aligned(spark, sf).items() if n in HRIS])
    parsed = dates.with_dates(rows, AS_OF, RULES.earliest_date, ["hire_date"])
    return parsed.select(F.col(POSITION).alias("row_id"), "source_system", "hire_date", "hire_date_invalid")


@add(
    "f_tenure",
    o.query(
        f"""SELECT _position AS row_id, {o.cents(f"greatest(date_sub('day', hire_date, {o.AS_OF}), 0) / 365.25")} AS tenure_years
        FROM hris WHERE hire_date IS NOT NULL"""
    ),
)
def f_tenure(spark, sf):
    """F27."""
    rows = hris(spark, sf).where(F.col("hire_date").isNotNull())
    years = dates.tenure_years(F.col("hire_date"), AS_OF)
    return rows.select(F.col(POSITION).alias("row_id"), money.two_places(years).alias("tenure_years"))


_CLEAN_COLUMNS = [c for c in o.GOLDEN if c not in ("source_systems", "dedup_method")]


@add(
    "f_clean_sources",
    o.query(
        " UNION ALL ".join(
            f"SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' if c.startswith('premium') else c for c in _CLEAN_COLUMNS)} FROM cln_{n}"
            for n in (*HRIS, "payroll", "benefits")
        )
    ),
)
def f_clean_sources(spark, sf):
    """F13, F28 input: every source through all cleaning steps."""
    return shown(union_sources([df.drop(POSITION) for df in cleaned(spark, sf).values()])).select(*_CLEAN_COLUMNS)


@add("f_clip", o.query("SELECT _position AS row_id, least(salary_usd_annual, 2000000.0) AS salary FROM cln_payroll WHERE salary_usd_annual IS NOT NULL"))
def f_clip(spark, sf):
    """F28."""
    rows = clean_one(spark, sf, "payroll").where(F.col("salary_usd_annual").isNotNull())
    return rows.select(
        F.col(POSITION).alias("row_id"), money.clip_upper(F.col("salary_usd_annual"), 2000000.0).alias("salary")
    )


# --- resolution -----------------------------------------------------------------


@add("a_payroll", o.query(f"SELECT employee_id, company_origin, {', '.join(PAYROLL_FIELDS)}, 'payroll' AS source_system FROM pay"))
def a_payroll(spark, sf):
    """A1, O1, W2."""
    return resolve.aggregate_payroll(clean_one(spark, sf, "payroll"), RULES)


@add(
    "a_benefits",
    o.query(
        "SELECT employee_id, company_origin, benefits_enrolled, benefit_plans, benefit_plan_count, benefit_coverage_level, benefit_enrollment_date, "
        "CAST(premium_employee AS DOUBLE) AS premium_employee, CAST(premium_employer AS DOUBLE) AS premium_employer, 'benefits' AS source_system FROM ben"
    ),
)
def a_benefits(spark, sf):
    """A2, X2."""
    return shown(resolve.aggregate_benefits(clean_one(spark, sf, "benefits")))


_COLLAPSED = [c for c in _CLEAN_COLUMNS if c not in ("premium_employee", "premium_employer")]


@add("a_collapse", o.query(f"SELECT {', '.join(_COLLAPSED)}, dedup_method, source_system AS source_systems FROM collapsed"))
def a_collapse(spark, sf):
    """A3, F22, W1."""
    return resolve.collapse_by_id(hris(spark, sf), RULES).select(*_COLLAPSED, "dedup_method", "source_systems")


@add("j_enrich", o.query(f"SELECT {o.golden_cells()} FROM exact"))
def j_enrich(spark, sf):
    """J1, J2, F24, R1."""
    return shown(exact(spark, sf)).select(*o.GOLDEN)


@add("j_ghost", o.query("SELECT * FROM ghosts"))
def j_ghost(spark, sf):
    """J3, A6."""
    return resolve_employees(cleaned(spark, sf), RULES).ghosts


@add("a_email", o.query(f"SELECT {o.golden_cells()} FROM merged"))
def a_email(spark, sf):
    """The merged rows."""
    once = staged(exact(spark, sf), stage_folder(spark), "exact")
    merged = resolve.merge_by_email(once, RULES).where("dedup_method = 'email_match'")
    return shown(merged).select(*o.GOLDEN)


@add("r_employees", o.query(f"SELECT {o.golden_cells()} FROM employees"))
def r_employees(spark, sf):
    """The whole resolution."""
    return shown(employees(spark, sf)).select(*o.GOLDEN)


_CROSSWALK = """SELECT DISTINCT k.employee_id AS consumed_id, s.surviving_id FROM keyed k JOIN (
    SELECT email_key, arg_min(employee_id, [company_origin, employee_id]) AS surviving_id FROM keyed SEMI JOIN crossing USING (email_key) WHERE employee_id IS NOT NULL GROUP BY 1
    ) s USING (email_key) WHERE k.employee_id <> s.surviving_id"""


@add("j_crosswalk", o.query(_CROSSWALK))
def j_crosswalk(spark, sf):
    """Ids consumed by the e-mail merge and the ids that survive."""
    return resolve.consumed_ids(resolve.collapse_by_id(hris(spark, sf), RULES), RULES)


@add(
    "j_reference_known",
    o.query(
        "SELECT count(*) AS total, count(*) FILTER (WHERE manager_id NOT IN (SELECT employee_id FROM employees WHERE employee_id IS NOT NULL UNION ALL SELECT consumed_id FROM crosswalk)) AS failed "
        "FROM employees WHERE manager_id IS NOT NULL",
        crosswalk=_CROSSWALK,
    ),
)
def j_reference_known(spark, sf):
    """References to ids that the e-mail merge consumed are not broken."""
    found = resolve_employees(cleaned(spark, sf), RULES, stage_folder(spark), columns=("manager_id",))
    return resolve.dangling_references(found.employees, "manager_id", "employee_id", found.crosswalk)


_REFERENCES = """SELECT count(*) AS total, count(*) FILTER (WHERE manager_id NOT IN (SELECT employee_id FROM {t} WHERE employee_id IS NOT NULL)) AS failed
    FROM {t} WHERE manager_id IS NOT NULL"""


@add("j_reference", o.query(_REFERENCES.format(t="exact")))
def j_reference(spark, sf):
    """J4."""
    spine = resolve.collapse_by_id(hris(spark, sf), RULES)
    return resolve.dangling_references(spine, "manager_id", "employee_id")


@add("k_unmapped", o.query("SELECT source_system, company_origin, department_original, count(*) AS record_count FROM hris WHERE department_unmapped GROUP BY ALL"))
def k_unmapped(spark, sf):
    """K3, P7, O3."""
    return unmapped_departments(cleaned(spark, sf).values())


# --- quality ------------------------------------------------------------------------


def report_sql(rows: list[tuple[str, str, str, str]], threshold: float = 0.95) -> tuple[str, dict[str, str]]:
    """(select, tables) of a report from (check, description, total, failed) expressions."""
    lines = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, '{text_}' AS description, {total} AS total, {failed} AS failed" for name, text_, total, failed in rows
    )
    rate = "(CASE WHEN total > 0 THEN 1 - failed / total ELSE 1.0 END)"
    select = (
        f"SELECT check_name AS \"check\", description, total, total - failed AS passed, failed, CAST({o.four(rate)} AS DOUBLE) AS pass_rate, "
        f"CASE WHEN {rate} >= {threshold} THEN 'PASS' ELSE 'FAIL' END AS status FROM report_lines"
    )
    return select, {"report_lines": lines}


def _employee_report_sql() -> str:
    names = [
        ("NOT NULL: employee_id", "Every employee has a canonical id", "true", "employee_id IS NULL"),
        ("NOT NULL: first_name", "Every employee has a first name", "true", "first_name IS NULL"),
        ("NOT NULL: last_name", "Every employee has a last name", "true", "last_name IS NULL"),
        ("NOT NULL: email", "Every employee has an e-mail address", "true", "email IS NULL"),
        ("NOT NULL: department", "Every employee has a department", "true", "department IS NULL"),
        ("NOT NULL: country", "Every employee has a country", "true", "country IS NULL"),
        ("UNIQUE: email", "No two employees share an e-mail address", "email IS NOT NULL", "(SELECT count(email) - count(DISTINCT lower(trim(email))) FROM employees)"),
        ("UNIQUE: employee_id", "No two employees share an id", "employee_id IS NOT NULL", "(SELECT count(employee_id) - count(DISTINCT employee_id) FROM employees)"),
        ("VALUES IN SET: employment_type", "Employment type is a standard one", "employment_type IS NOT NULL", "employment_type NOT IN ('Full-Time', 'Part-Time', 'Contractor')"),
        ("VALUES IN SET: currency", "Currency has a known rate", "currency IS NOT NULL", "currency NOT IN ('USD', 'EUR', 'GBP')"),
        ("REGEX: email", "E-mail addresses are well formed", "email IS NOT NULL", r"NOT regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')"),
        ("REGEX: employee_id", "Ids carry a company prefix and six digits", "employee_id IS NOT NULL", r"NOT regexp_matches(employee_id, '^(GT|AC)-\d{6}$')"),
        ("NUMERIC RANGE: salary_usd_annual", "Yearly salary in USD is plausible", "salary_usd_annual IS NOT NULL", "salary_usd_annual NOT BETWEEN 15000 AND 2000000"),
        ("DATE RANGE: hire_date", "Hire date is not before 1970 or ahead", "hire_date IS NOT NULL", f"hire_date NOT BETWEEN TIMESTAMP '1970-01-01' AND {o.AS_OF}"),
        ("REFERENTIAL INTEGRITY: manager_id -> employee_id", "Every manager is an employee", "manager_id IS NOT NULL", "manager_id NOT IN (SELECT employee_id FROM employees)"),
    ]
    rows = []
    for name, text_, counted, failing in names:
        total = f"(SELECT count(*) FROM employees WHERE {counted})"
        failed = failing if failing.startswith("(SELECT") else f"(SELECT count(*) FROM employees WHERE {counted} AND {failing})"
        rows.append((name, text_, total, failed))
    select, tables = report_sql(rows)
    return o.query(select, **tables)


@add("q_employee_suite", _employee_report_sql())
def q_employee_suite(spark, sf):
    """Q1-Q9."""
    return quality.employee_report(employees(spark, sf, *CHECKED), RULES)


@add(
    "q_custom",
    "SELECT 'positive balance' AS \"check\", 'Customers have money' AS description, count(*) AS total, count(*) FILTER (WHERE c_acctbal >= 0) AS passed, "
    "count(*) FILTER (WHERE c_acctbal < 0) AS failed, round_even((1 - count(*) FILTER (WHERE c_acctbal < 0) / count(*)) * 10000, 0) / 10000 AS pass_rate, "
    "CASE WHEN 1 - count(*) FILTER (WHERE c_acctbal < 0) / count(*) >= 0.9 THEN 'PASS' ELSE 'FAIL' END AS status FROM customer",
)
def q_custom(spark, sf):
    """A check of one's own."""
    check = quality.custom("positive balance", "Customers have money", F.col("c_acctbal") < 0)
    return quality.quality_report(table(spark, sf, "customer"), [check], 0.9)


# --- profiles -----------------------------------------------------------------------


@add("e_headcount_department", o.query("SELECT coalesce(department, '(Unknown)') AS department, count(*) AS employees FROM employees GROUP BY 1"))
def e_headcount_department(spark, sf):
    """A8."""
    return profile.headcount_by_department(employees(spark, sf, "department"))


@add("e_headcount_country", o.query("SELECT coalesce(country, '(Unknown)') AS country, count(*) AS employees FROM employees GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"))
def e_headcount_country(spark, sf):
    """A8, O4."""
    return profile.headcount_by_country(employees(spark, sf, "country"))


@add(
    "e_salary_distribution",
    o.query(
        f"""SELECT employment_type, records, {o.cents('q1')} AS q1, {o.cents('med')} AS median, {o.cents('q3')} AS q3,
        {o.cents('(SELECT min(v) FROM pay_points p WHERE p.employment_type = b.employment_type AND v >= q1 - 1.5 * (q3 - q1))')} AS whisker_low,
        {o.cents('(SELECT max(v) FROM pay_points p WHERE p.employment_type = b.employment_type AND v <= q3 + 1.5 * (q3 - q1))')} AS whisker_high
        FROM (SELECT employment_type, count(*) AS records, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3
        FROM pay_points GROUP BY 1) b""",
        pay_points="SELECT coalesce(employment_type, '(Unknown)') AS employment_type, least(salary_usd_annual, 2000000) AS v FROM employees WHERE salary_usd_annual IS NOT NULL",
    ),
)
def e_salary_distribution(spark, sf):
    """A9, O5."""
    return profile.salary_distribution(employees(spark, sf, "employment_type", "salary_usd_annual"), RULES)


_YEARS = f"SELECT greatest(date_sub('day', hire_date, {o.AS_OF}), 0) / 365.25 AS y FROM employees WHERE hire_date IS NOT NULL"


@add(
    "e_tenure_histogram",
    o.query(
        f"""SELECT CAST(bin AS INTEGER) AS bin, {o.cents('lo + (hi - lo) / 20 * bin')} AS from_years, {o.cents('lo + (hi - lo) / 20 * (bin + 1)')} AS to_years,
        (SELECT count(*) FROM years WHERE least(floor((y - lo) * 20 / (hi - lo)), 19) = bin) AS employees
        FROM range(20) r(bin), (SELECT min(y) AS lo, max(y) AS hi FROM years)""",
        years=_YEARS,
    ),
)
def e_tenure_histogram(spark, sf):
    """A10."""
    return profile.tenure_histogram(employees(spark, sf, "hire_date"), AS_OF)


@add("e_tenure_median", o.query(f"SELECT {o.cents('quantile_cont(y, 0.5)')} AS median_years FROM years", years=_YEARS))
def e_tenure_median(spark, sf):
    """A10."""
    return profile.tenure_median(employees(spark, sf, "hire_date"), AS_OF)


@add("e_enrolment_rate", o.query(f"SELECT coalesce(department, '(Unknown)') AS department, {o.cents('avg(CASE WHEN benefits_enrolled THEN 1.0 ELSE 0.0 END) * 100')} AS enrolment_rate FROM employees GROUP BY 1"))
def e_enrolment_rate(spark, sf):
    """A11."""
    return profile.enrolment_rate_by_department(employees(spark, sf, "department", "benefits_enrolled"))


@add("e_check_outcomes", _employee_report_sql().replace("SELECT check_name AS \"check\", description,", "SELECT \"check\", passed, failed FROM (SELECT check_name AS \"check\", description,") + ")")
def e_check_outcomes(spark, sf):
    """A12."""
    return profile.check_outcomes(quality.employee_report(employees(spark, sf, *CHECKED), RULES))


@add("e_value_counts", o.query("SELECT department, count(*) AS records FROM hris GROUP BY 1"))
def e_value_counts(spark, sf):
    """A7 with nulls."""
    return profile.value_counts(hris(spark, sf), "department", keep_null=True)


@add(
    "e_salary_statistics",
    o.query(
        f"""SELECT currency, pay_frequency, count(salary_usd_annual) AS records, {o.cents('min(salary_usd_annual)')} AS minimum,
        {o.cents('quantile_cont(salary_usd_annual, 0.5)')} AS median, {o.cents('avg(salary_usd_annual)')} AS mean, {o.cents('max(salary_usd_annual)')} AS maximum
        FROM cln_payroll WHERE currency IS NOT NULL AND pay_frequency IS NOT NULL GROUP BY 1, 2"""
    ),
)
def e_salary_statistics(spark, sf):
    """A18."""
    return profile.salary_statistics(clean_one(spark, sf, "payroll"))


@add(
    "e_ingestion_summary",
    o.query(
        " UNION ALL ".join(
            f"SELECT '{n}' AS source_system, count(*) AS records, CAST(26 AS BIGINT) AS columns, count(*) FILTER (WHERE source_system = '{n}') AS tagged_correctly, "
            f"string_agg(DISTINCT company_origin, ', ' ORDER BY company_origin) AS company_origins FROM std_{n}"
            for n in (*HRIS, "payroll", "benefits")
        )
    ),
)
def e_ingestion_summary(spark, sf):
    """A19, S13."""
    return profile.ingestion_summary(aligned(spark, sf))


@add(
    "e_date_summary",
    o.query(
        " UNION ALL ".join(
            f"SELECT '{n}' AS source_system, '{d}' AS \"column\", count({d}) AS parsed, count(*) FILTER (WHERE {d}_invalid) AS invalid, min({d}) AS minimum, max({d}) AS maximum FROM cln_{n}"
            for n, d in ((HRIS[0], "hire_date"), (HRIS[1], "hire_date"), ("payroll", "payroll_effective_date"), ("benefits", "benefit_enrollment_date"))
        )
    ),
)
def e_date_summary(spark, sf):
    """A20."""
    return profile.date_summary(cleaned(spark, sf))


@add(
    "e_stage_summary",
    o.query(
        " UNION ALL ".join(
            f"SELECT '{n}' AS source_system, (SELECT count(*) FROM std_{n}) AS ingested_records, count(*) AS cleaned_records, "
            rf"count(*) FILTER (WHERE regexp_matches(employee_id, '^(GT|AC)-\d{{6}}$')) AS canonical_employee_ids, count(salary_usd_annual) AS annual_usd_salaries, "
            f"count(*) FILTER (WHERE hire_date_invalid) + count(*) FILTER (WHERE payroll_effective_date_invalid) + count(*) FILTER (WHERE benefit_enrollment_date_invalid) AS invalid_dates FROM cln_{n}"
            for n in (*HRIS, "payroll", "benefits")
        )
    ),
)
def e_stage_summary(spark, sf):
    """A21."""
    raw = aligned(spark, sf)
    return profile.stage_summary(raw, clean.clean_all_employees(raw, RULES), RULES)


_METRICS = {
    "input_hris_rows": "SELECT count(*) FROM hris",
    "pass1_employees": "SELECT count(*) FROM exact",
    "exact_id_merges": "SELECT count(*) FROM exact WHERE dedup_method = 'exact_id'",
    "single_source": "SELECT count(*) FROM exact WHERE dedup_method = 'single_source'",
    "with_payroll": "SELECT count(*) FROM exact WHERE source_systems LIKE '%payroll%'",
    "with_benefits": "SELECT count(*) FROM exact WHERE source_systems LIKE '%benefits%'",
}


@add("e_match_summary", o.query(" UNION ALL ".join(f"SELECT '{m}' AS metric, ({q}) AS value" for m, q in _METRICS.items())))
def e_match_summary(spark, sf):
    """A22."""
    return profile.match_summary(hris(spark, sf), exact(spark, sf))


@add(
    "e_dead_letters",
    o.query(
        f"""SELECT source_system, count(*) AS recorded_failures, max(reason) AS latest_reason FROM (
        SELECT 'globaltech_hris' AS source_system, 'Missing required identity field: employee_id' AS reason FROM raw_globaltech_hris WHERE {_NO_ID}
        UNION ALL SELECT 'payroll', 'Missing required identity field: employee_id' FROM raw_payroll WHERE {_NO_ID}
        UNION ALL SELECT 'payroll', 'Unknown payroll company source' FROM raw_payroll WHERE NOT ({_NO_ID}) AND NOT coalesce(source IN ('GlobalTech', 'AcquiredCo'), false)
        ) GROUP BY 1"""
    ),
)
def e_dead_letters(spark, sf):
    """A23; all letters of the query carry one moment, so the reason alone decides."""
    letters = p_quarantine(spark, sf).withColumn("rejected_at_utc", F.lit("2015-06-30T00:00:00+00:00"))
    return profile.dead_letter_summary(letters)


@add("e_golden_by_company", o.query("SELECT company_origin, count(*) AS records FROM employees GROUP BY 1"))
def e_golden_by_company(spark, sf):
    """A24."""
    return profile.value_counts(employees(spark, sf, "company_origin"), "company_origin")


@add(
    "e_run_summary",
    o.query(
        " UNION ALL ".join(f"SELECT '{n}' AS metric, count(*) AS value FROM std_{n}" for n in (*HRIS, "payroll", "benefits"))
        + " UNION ALL SELECT 'ghost_employees', count(*) FROM ghosts UNION ALL SELECT 'employees', count(*) FROM employees"
        " UNION ALL SELECT 'method:' || dedup_method, count(*) FROM employees GROUP BY dedup_method"
    ),
)
def e_run_summary(spark, sf):
    """A25."""
    frames = cleaned(spark, sf)
    found = resolve_employees(frames, RULES, stage_folder(spark))
    return profile.run_summary(
        frames, {"ghost_employees": found.ghosts, "employees": found.employees}, found.employees
    )


def _profile_sql() -> str:
    kinds = {**EMPLOYEE_SCHEMA, "employee_id_raw": "string", "manager_id_raw": "string", "department_original": "string",
             "department_unmapped": "boolean", "source_systems": "string", "dedup_method": "string",
             **{c: "timestamp_ntz" for c in EMPLOYEE_SCHEMA if c.endswith("_date")},
             **{f"{c}_invalid": "boolean" for c in EMPLOYEE_SCHEMA if c.endswith("_date")}}
    rows = []
    for c in o.GOLDEN:
        example = f"arg_min({c}, employee_id) FILTER (WHERE {c} IS NOT NULL)"
        if kinds[c] == "timestamp_ntz":
            example = f"strftime({example}, '%Y-%m-%dT%H:%M:%S')"
        cast = f"CAST({example} AS VARCHAR)"
        cut = f"CASE WHEN length({cast}) > 80 THEN left({cast}, 77) || '...' ELSE {cast} END"
        rows.append(
            f"SELECT '{c}' AS column_name, '{kinds[c]}' AS data_type, '{COLUMN_DESCRIPTIONS[c].replace(chr(39), chr(39) * 2)}' AS description, "
            f"coalesce({cut}, '') AS example_value FROM employees"
        )
    return o.query(" UNION ALL ".join(rows))


@add("e_column_profile", _profile_sql())
def e_column_profile(spark, sf):
    """K10."""
    return profile.column_profile(employees(spark, sf).select(*o.GOLDEN), COLUMN_DESCRIPTIONS, "employee_id")


# --- probable matches -----------------------------------------------------------------


_FUZZY = rf"""
WITH RECURSIVE people AS MATERIALIZED ({o.source_sql('people')}),
named AS MATERIALIZED (
    SELECT employee_id AS id, company_origin AS company, hire_date,
        trim(regexp_replace(coalesce(first_name, '') || ' ' || coalesce(last_name, ''), '\s+', ' ', 'g')) AS full_text,
        CASE company_origin WHEN 'GlobalTech' THEN 1 WHEN 'AcquiredCo' THEN 2 ELSE 3 END AS company_order
    FROM people WHERE hire_date IS NOT NULL),
ready AS MATERIALIZED (SELECT *, array_to_string(list_sort(string_split(full_text, ' ')), ' ') AS tokens FROM named WHERE full_text <> ''),
near AS MATERIALIZED (
    SELECT a.id AS id1, b.id AS id2, a.full_text AS name1, b.full_text AS name2, a.company AS company1, b.company AS company2,
        a.tokens AS t1, b.tokens AS t2, date_sub('day', a.hire_date, b.hire_date) AS days
    FROM ready a JOIN ready b ON a.hire_date <= b.hire_date AND b.hire_date < a.hire_date + INTERVAL 31 DAY
    WHERE (a.hire_date < b.hire_date OR a.company_order < b.company_order OR (a.company_order = b.company_order AND a.id < b.id))
        AND (a.company IS NULL OR a.company IS DISTINCT FROM b.company) AND a.id <> b.id
        AND 200 * least(length(a.tokens), length(b.tokens)) >= 88 * (length(a.tokens) + length(b.tokens))),
pairs AS MATERIALIZED (SELECT DISTINCT t1, t2 FROM near),
lcs AS (
    SELECT t1, t2, 0 AS i, list_transform(range(length(t2) + 1), lambda x: 0) AS line FROM pairs
    UNION ALL
    SELECT t1, t2, i + 1, list_prepend(0, list_transform(range(1, length(t2) + 1), lambda j: list_max(list_transform(range(1, j + 1),
        lambda k: greatest(line[k + 1], CASE WHEN t1[i + 1] = t2[k] THEN line[k] + 1 ELSE 0 END)))))
    FROM lcs WHERE i < length(t1)),
scored AS (SELECT t1, t2, line[length(t2) + 1] AS common FROM lcs WHERE i = length(t1))
SELECT id1 AS record_1_id, id2 AS record_2_id, round_even(common * 20000.0 / (length(t1) + length(t2)), 0) / 100 AS similarity_score,
    days AS hire_date_diff_days, 'review' AS recommended_action, name1 AS record_1_name, name2 AS record_2_name,
    company1 AS record_1_company, company2 AS record_2_company, 'fuzzy_name' AS dedup_method
FROM near JOIN scored USING (t1, t2) WHERE 200 * common >= 88 * (length(t1) + length(t2))
"""


@add("j_fuzzy", _FUZZY)
def j_fuzzy(spark, sf):
    """J5, F23, P11, O2."""
    return fuzzy.review_order(fuzzy.probable_matches(source(spark, sf, "people"), RULES))
