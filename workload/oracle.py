"""Checking SQL: the same results written as plain queries over the star-schema tables."""

from __future__ import annotations

from recordloom.config import (
    BENEFIT_FIELDS,
    COMPANY_OF_SOURCE,
    EMPLOYEE_COLUMN_MAPS,
    EMPLOYEE_SCHEMA,
    PAYROLL_FIELDS,
)
from workload.inputs import CUSTOMER_RULES, EMPLOYEE_RULES, SOURCES, source_sql

AS_OF = f"TIMESTAMP '{EMPLOYEE_RULES.as_of} 00:00:00'"
CUSTOMER_AS_OF = f"TIMESTAMP '{CUSTOMER_RULES.as_of} 00:00:00'"


def norm(e: str) -> str:
    plain = f"replace(replace({e}, 'ﬁ', 'fi'), chr(160), ' ')"
    return rf"nullif(trim(regexp_replace({plain}, '\s+', ' ', 'g')), '')"


def title(e: str) -> str:
    runs = rf"regexp_extract_all(lower({e}), '\p{{L}}+|[^\p{{L}}]+')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || w[2:]), '')"


def case_map(e: str, mapping: dict[str, object]) -> str:
    quote = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    whens = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in mapping.items())
    return f"CASE {e} {whens} END"


def namespaced(raw: str, company: str) -> str:
    n = rf"try_cast(regexp_extract(trim({raw}), '(\d+)', 1) AS BIGINT)"
    prefix = case_map(f"lower(trim({company}))", EMPLOYEE_RULES.id_prefixes)
    return f"CASE WHEN {n} BETWEEN 0 AND 999999 THEN {prefix} || '-' || lpad(CAST({n} AS VARCHAR), 6, '0') END"


def money(e: str) -> str:
    number = rf"try_cast(regexp_replace(trim({e}), '[^\d.\-]', '', 'g') AS DOUBLE)"
    return rf"CASE WHEN regexp_matches(trim({e}), '^\(.*\)$') THEN -{number} ELSE {number} END"


def cents(e: str) -> str:
    return f"(round_even(({e}) * 100, 0) / 100)"


def four(e: str) -> str:
    return f"(round_even(({e}) * 10000, 0) / 10000)"


def date(e: str) -> str:
    formats = "['%Y-%m-%d', '%m/%d/%Y', '%d-%b-%Y', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%d %H:%M:%S']"
    return f"try_strptime({norm(e)}, {formats})"


def priority(e: str, mapping: dict[str, int]) -> str:
    return f"coalesce({case_map(e, mapping)}, 99)"


_SQL_TYPES = {"string": "VARCHAR", "decimal(18,2)": "DECIMAL(18,2)"}


def _aligned(source: str) -> str:
    """Quarantined source in the standard columns."""
    native = {std: col for col, std in EMPLOYEE_COLUMN_MAPS[source].items()}
    cells = []
    for name, kind in EMPLOYEE_SCHEMA.items():
        sql_type = _SQL_TYPES.get(kind, kind)
        if name == "source_system":
            cells.append(f"'{source}' AS source_system")
        elif name == "company_origin" and source in COMPANY_OF_SOURCE:
            cells.append(f"'{COMPANY_OF_SOURCE[source]}' AS company_origin")
        elif name == "company_origin":
            cells.append("trim(source) AS company_origin")
        elif source == "benefits" and name == "benefits_enrolled":
            cells.append("true AS benefits_enrolled")
        elif source == "benefits" and name == "benefit_plan_count":
            cells.append("CAST(1 AS BIGINT) AS benefit_plan_count")
        elif name in native:
            cells.append(f"try_cast({native[name]} AS {sql_type}) AS {name}")
        else:
            cells.append(f"CAST(NULL AS {sql_type}) AS {name}")
    if "_position" in SOURCES[source][1]:
        cells.append("_position")
    keep = {
        "globaltech_hris": "trim(coalesce(employee_id, '')) <> ''",
        "acquiredco_hris": "coalesce(employee_identifier, '') <> ''",
        "payroll": "trim(coalesce(employee_id, '')) <> '' AND coalesce(source IN ('GlobalTech', 'AcquiredCo'), false)",
        "benefits": "trim(coalesce(employee_id, '')) <> '' AND trim(coalesce(plan_type, '')) <> ''",
    }[source]
    return f"SELECT {', '.join(cells)} FROM raw_{source} WHERE {keep}"


def _cleaned(source: str) -> str:
    company = "company_origin"
    frequency = case_map(
        f"lower({norm('pay_frequency')})", {k.lower(): k for k in EMPLOYEE_RULES.periods_per_year}
    )
    rate = case_map("upper(trim(currency))", EMPLOYEE_RULES.usd_rates)
    periods = case_map(frequency, EMPLOYEE_RULES.periods_per_year)
    department = case_map(f"upper({norm('department')})", EMPLOYEE_RULES.departments)
    new = {
        "first_name": title(norm("first_name")),
        "last_name": title(norm("last_name")),
        "employee_id": namespaced("employee_id", company),
        "manager_id": namespaced("manager_id", company),
        "employment_type": case_map(f"upper({norm('employment_type')})", EMPLOYEE_RULES.employment_types),
        "currency": "upper(trim(currency))",
        "pay_frequency": frequency,
        "salary_usd_annual": cents(f"({money('base_salary')}) * ({rate}) * ({periods})"),
        "department": department,
    }
    flags = []
    for d in ("hire_date", "payroll_effective_date", "benefit_enrollment_date"):
        new[d] = date(d)
        out = f"({date(d)} < TIMESTAMP '1970-01-01' OR {date(d)} > {AS_OF})"
        flags.append(f"({d} IS NOT NULL AND {date(d)} IS NULL) OR coalesce({out}, false) AS {d}_invalid")
    cells = [f"{new.get(n, n)} AS {n}" for n in EMPLOYEE_SCHEMA]
    cells += ["employee_id AS employee_id_raw", "manager_id AS manager_id_raw", "department AS department_original",
              f"(department IS NOT NULL AND ({department}) IS NULL) AS department_unmapped", *flags]
    if "_position" in SOURCES[source][1]:
        cells.append("_position")
    return f"SELECT {', '.join(cells)} FROM std_{source}"


def first(column: str, order: str) -> str:
    return f"arg_min({column}, [{order}]) FILTER (WHERE {column} IS NOT NULL) AS {column}"


GOLDEN = [
    *EMPLOYEE_SCHEMA, "employee_id_raw", "manager_id_raw", "department_original", "department_unmapped",
    "hire_date_invalid", "payroll_effective_date_invalid", "benefit_enrollment_date_invalid",
    "source_systems", "dedup_method",
]

_LATEST = "CASE WHEN payroll_effective_date IS NULL THEN 1 ELSE 0 END, -epoch_us(payroll_effective_date), _position"


def _employee_ctes() -> dict[str, str]:
    ctes: dict[str, str] = {}
    for s in ("globaltech_hris", "acquiredco_hris", "payroll", "benefits"):
        ctes[f"raw_{s}"] = source_sql(s)
        ctes[f"std_{s}"] = _aligned(s)
        ctes[f"cln_{s}"] = _cleaned(s)
    ctes["hris"] = "SELECT * FROM cln_globaltech_hris UNION ALL BY NAME SELECT * FROM cln_acquiredco_hris"
    dup = "CASE WHEN employee_id_raw ILIKE '%dup%' THEN 1 ELSE 0 END"
    rank = "CASE company_origin WHEN 'GlobalTech' THEN 1 ELSE 2 END"
    values = [c for c in GOLDEN if c not in ("employee_id", "source_systems", "dedup_method")]
    ctes["collapsed"] = (
        "SELECT employee_id, " + ", ".join(first(c, f"{dup}, {rank}, _position") for c in values)
        + ", CASE WHEN count(*) > 1 THEN 'exact_id' ELSE 'single_source' END AS dedup_method"
        " FROM hris WHERE employee_id IS NOT NULL GROUP BY employee_id"
    )
    ctes["pay"] = (
        "SELECT employee_id, " + ", ".join(first(c, _LATEST) for c in ("company_origin", *PAYROLL_FIELDS))
        + " FROM cln_payroll WHERE employee_id IS NOT NULL GROUP BY employee_id"
    )
    label = lambda c: f"coalesce(nullif(trim({c}), ''), 'N/A')"
    in_order = (
        f"ORDER BY benefit_enrollment_date ASC NULLS LAST, {label('benefit_plans')}, {label('benefit_coverage_level')}"
    )
    ctes["ben"] = f"""SELECT employee_id, min(company_origin) AS company_origin, bool_or(benefits_enrolled) AS benefits_enrolled,
        string_agg({label('benefit_plans')}, ',' {in_order}) AS benefit_plans, count(benefit_plans) AS benefit_plan_count,
        string_agg({label('benefit_coverage_level')}, ',' {in_order}) AS benefit_coverage_level,
        min(benefit_enrollment_date) AS benefit_enrollment_date,
        coalesce(sum(premium_employee), 0) AS premium_employee, coalesce(sum(premium_employer), 0) AS premium_employer
        FROM cln_benefits WHERE employee_id IS NOT NULL GROUP BY employee_id"""
    spine = [c for c in GOLDEN if c not in (*PAYROLL_FIELDS, *BENEFIT_FIELDS, "source_systems", "dedup_method")]
    ctes["exact"] = (
        "SELECT " + ", ".join(f"c.{c}" for c in spine) + ", " + ", ".join(f"p.{c}" for c in PAYROLL_FIELDS) + ", "
        + ", ".join(f"b.{c}" for c in BENEFIT_FIELDS if c not in ("benefits_enrolled", "benefit_plan_count"))
        + """, coalesce(b.benefits_enrolled, false) AS benefits_enrolled, coalesce(b.benefit_plan_count, 0) AS benefit_plan_count,
        c.source_system || CASE WHEN p.employee_id IS NULL THEN '' ELSE ',payroll' END
            || CASE WHEN b.employee_id IS NULL THEN '' ELSE ',benefits' END AS source_systems,
        CASE WHEN p.employee_id IS NULL AND b.employee_id IS NULL THEN c.dedup_method ELSE 'exact_id' END AS dedup_method
        FROM collapsed c LEFT JOIN pay p USING (employee_id) LEFT JOIN ben b USING (employee_id)"""
    )
    ctes["ghosts"] = (
        "SELECT employee_id AS payroll_employee_id, CAST(NULL AS VARCHAR) AS name, salary_usd_annual, "
        "'Payroll employee_id has no matching HRIS record' AS ghost_flag_reason, true AS ghost_employee, company_origin, "
        "'payroll' AS source_system FROM pay WHERE NOT EXISTS (SELECT 1 FROM exact x WHERE x.employee_id = pay.employee_id)"
    )
    key = "nullif(lower(trim(email)), '')"
    ctes["keyed"] = f"SELECT *, {key} AS email_key FROM exact"
    ctes["crossing"] = (
        "SELECT email_key FROM keyed WHERE email_key IS NOT NULL GROUP BY email_key "
        "HAVING count(DISTINCT company_origin) > 1 AND count(employee_id) > 1"
    )
    order = "company_origin, employee_id"  # both HR systems have the same priority
    merged = [c for c in GOLDEN if c not in ("source_systems", "dedup_method")]
    ranks = priority("s", EMPLOYEE_RULES.source_priority)
    ctes["sources_of_key"] = f"""SELECT email_key, string_agg(s, ',' ORDER BY {ranks}, s) AS source_systems FROM (
        SELECT DISTINCT email_key, unnest(string_split(source_systems, ',')) AS s FROM keyed SEMI JOIN crossing USING (email_key)
        ) GROUP BY email_key"""
    ctes["merged"] = (
        "SELECT " + ", ".join(first(c, order) for c in merged)
        + ", any_value(k.source_systems) AS source_systems, 'email_match' AS dedup_method"
        " FROM (SELECT * EXCLUDE (source_systems, dedup_method) FROM keyed) JOIN sources_of_key k USING (email_key) GROUP BY email_key"
    )
    cols = ", ".join(GOLDEN)
    ctes["employees"] = (
        f"SELECT {cols} FROM keyed ANTI JOIN crossing USING (email_key) UNION ALL SELECT {cols} FROM merged"
    )
    return ctes


def _customer_ctes() -> dict[str, str]:
    rules = CUSTOMER_RULES
    squeezed = r"regexp_replace(lower(email), '\s+', '', 'g')"
    email = f"CASE WHEN {squeezed} NOT IN ('nan', 'none', '') THEN {squeezed} END"
    name = lambda c: (
        lambda t: f"CASE WHEN {t} NOT IN ('Nan', 'None', '') THEN {t} END"
    )(title(rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"))
    digits = "regexp_replace(phone, '[^0-9]', '', 'g')"
    region = case_map("lower(trim(region))", rules.regions)
    flag = r"coalesce(CASE WHEN regexp_matches(opt_out, '^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$') THEN try_cast(opt_out AS DOUBLE) END <> 0, false)"
    ctes = {
        "raw_customers": source_sql("customers"),
        "real_customers": r"SELECT * FROM raw_customers WHERE NOT coalesce(regexp_matches(email, '(?i)@test\.example\.org$'), false)",
        "cln_customers": f"""SELECT {email} AS email, {name('first_name')} AS first_name, {name('last_name')} AS last_name,
            CASE WHEN length({digits}) >= 7 THEN CASE WHEN trim(phone) LIKE '+%' THEN '+' ELSE '' END || {digits} END AS phone,
            {region} AS region, try_strptime(registration_date, '%Y-%m-%d') AS registration_date, opt_out, source, _position,
            email AS email_raw, coalesce(regexp_matches({email}, '{rules.email_pattern}'), false) AS email_valid FROM real_customers""",
        "ranked_customers": f"""SELECT * REPLACE ({flag} AS opt_out),
            {priority('source', rules.source_priority)} AS source_priority FROM cln_customers""",
    }
    order = "source_priority, _position"
    filled = ("first_name", "last_name", "phone", "region", "registration_date")
    best = ", ".join(f"arg_min({c}, [{order}]) AS {c}" for c in ("email_raw", "source", "source_priority", "email_valid"))
    ctes["customer_sources"] = """SELECT email, string_agg(source, ',' ORDER BY source_priority, source) AS sources,
        count(*) AS source_count FROM (SELECT DISTINCT email, source, source_priority FROM ranked_customers WHERE email_valid) GROUP BY email"""
    ctes["golden_customers"] = (
        "SELECT email, " + ", ".join(first(c, order) for c in filled)
        + f", bool_or(opt_out) AS opt_out, {best}, any_value(k.sources) AS sources, any_value(k.source_count) AS source_count"
        " FROM ranked_customers JOIN customer_sources k USING (email) WHERE email_valid GROUP BY email"
        " UNION ALL BY NAME SELECT email, first_name, last_name, phone, region, registration_date, opt_out, email_raw, source,"
        " source_priority, email_valid, CAST(NULL AS VARCHAR) AS sources, CAST(NULL AS BIGINT) AS source_count"
        " FROM ranked_customers WHERE NOT email_valid"
    )
    return ctes


_CTES = {**_employee_ctes(), **_customer_ctes()}


def _needed(text: str) -> list[str]:
    """Names of the common tables that a query uses, directly or through others."""
    import re

    found: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & _CTES.keys() - found:
            found.add(name)
            todo.append(_CTES[name])
    return [name for name in _CTES if name in found]


def query(select: str, **more: str) -> str:
    """A full statement: the common tables it needs, ``more`` tables, and the select."""
    names = _needed(" ".join([select, *more.values()]))
    parts = [f"{n} AS MATERIALIZED ({_CTES[n]})" for n in names] + [f"{n} AS ({sql})" for n, sql in more.items()]
    return f"WITH {', '.join(parts)} {select}" if parts else select


def golden_cells() -> str:
    """Golden columns with decimals as doubles, the way the queries show them."""
    shown = lambda c: f"CAST({c} AS DOUBLE) AS {c}" if c.startswith("premium") else c
    return ", ".join(shown(c) for c in GOLDEN)
