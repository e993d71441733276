"""Queries over the customer operators and the text sources, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.config import CUSTOMER_SCHEMA, ERP_LAYOUT, POSITION
from recordloom.functions import text
from recordloom.operators import clean, profile, quality, quarantine, resolve
from recordloom.plans.staging import stage_folder
from recordloom.sources import readers
from recordloom.sources.align import align_customers, align_employees, flatten_json, union_sources
from workload import oracle as o
from workload.employees import report_sql
from workload.inputs import CUSTOMER_RULES as RULES
from workload.inputs import source, table, write_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def add(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def aligned(spark: SparkSession, sf: str) -> DataFrame:
    real = quarantine.drop_test_accounts(source(spark, sf, "customers"), RULES.test_account_pattern)
    dated = real.withColumn("registration_date", F.try_to_timestamp("registration_date", F.lit("yyyy-MM-dd")))
    return align_customers(dated)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_customers(aligned(spark, sf), RULES)


def golden(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.merge_customers(cleaned(spark, sf), RULES)


# --- alignment and scalar functions ---------------------------------------------


@add("u_customers", o.query("SELECT email, first_name, last_name, phone, region, try_strptime(registration_date, '%Y-%m-%d') AS registration_date, opt_out, source FROM real_customers"))
def u_customers(spark, sf):
    """S15, P6."""
    return aligned(spark, sf).select(*CUSTOMER_SCHEMA)


@add("f_clean_customers", o.query("SELECT _position AS row_id, email, email_raw, email_valid, first_name, last_name, phone, region, registration_date FROM cln_customers"))
def f_clean_customers(spark, sf):
    """F3, F14, F16, F17, F18, P10."""
    return cleaned(spark, sf).select(
        F.col(POSITION).alias("row_id"), "email", "email_raw", "email_valid", "first_name", "last_name", "phone", "region", "registration_date"
    )


@add("f_opt_out", o.query("SELECT _position AS row_id, opt_out FROM ranked_customers"))
def f_opt_out(spark, sf):
    """F31."""
    return cleaned(spark, sf).select(F.col(POSITION).alias("row_id"), text.opt_out_flag(F.col("opt_out")).alias("opt_out"))


@add("f_source_priority", o.query("SELECT source, source_priority, count(*) AS records FROM ranked_customers GROUP BY 1, 2"))
def f_source_priority(spark, sf):
    """F21."""
    from recordloom.functions.identity import source_priority

    ranked = cleaned(spark, sf).select("source", source_priority(F.col("source"), RULES.source_priority).alias("source_priority"))
    return ranked.groupBy("source", "source_priority").agg(F.count("*").alias("records"))


_GUESS = "CASE user_id % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN 'APAC' ELSE NULL END"


@add(
    "f_inferred_region",
    o.query(
        f"""SELECT _position AS row_id, coalesce(region, CASE WHEN guess IN ('US', 'EU', 'APAC') THEN guess END) AS region,
        region IS NULL AND coalesce(guess IN ('US', 'EU', 'APAC'), false) AS region_inferred FROM cln_customers JOIN guesses ON event_id = _position""",
        guesses=f"SELECT event_id, {_GUESS} AS guess FROM events",
    ),
)
def f_inferred_region(spark, sf):
    """F30."""
    rows = cleaned(spark, sf).select(F.col(POSITION).alias("row_id"), "region")
    guesses = table(spark, sf, "events").selectExpr("event_id AS row_id", f"{_GUESS} AS region")
    return clean.apply_inferred_regions(rows, guesses, "row_id", RULES)


@add("f_split_name", r"SELECT c_custkey AS row_id, split_part(n, ' ', 1) AS first_name, CASE WHEN strpos(n, ' ') > 0 THEN trim(substr(n, strpos(n, ' ') + 1)) END AS last_name FROM (SELECT c_custkey, trim('  ' || c_mktsegment || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '   van  ' || c_name || ' ' END) AS n FROM customer)")
def f_split_name(spark, sf):
    """F26."""
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey AS row_id", "'  ' || c_mktsegment || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '   van  ' || c_name || ' ' END AS name"
    )
    first, last = text.split_full_name(F.col("name"))
    return rows.select("row_id", first.alias("first_name"), last.alias("last_name"))


# --- merge, checks, profiles --------------------------------------------------------


_GOLDEN = "email, first_name, last_name, phone, region, registration_date, opt_out, email_raw, email_valid, source, source_priority, sources"


@add("a_customers", o.query(f"SELECT {_GOLDEN}, coalesce(source_count, 0) AS source_count FROM golden_customers"))
def a_customers(spark, sf):
    """A5, F21, X3, U1."""
    counted = golden(spark, sf).withColumn("source_count", F.coalesce("source_count", F.lit(0)))
    return counted.select(*_GOLDEN.split(", "), "source_count")


def _customer_report_sql() -> str:
    t = "golden_customers"
    checks = [
        ("NOT NULL: email", "Every customer has an e-mail address", "true", "email IS NULL"),
        ("NOT NULL: first_name", "Every customer has a first name", "true", "first_name IS NULL"),
        ("NOT NULL: region", "Every customer has a region", "true", "region IS NULL"),
        ("UNIQUE: email", "No two customers share an e-mail address", "email IS NOT NULL", f"(SELECT count(email) - count(DISTINCT email) FROM {t})"),
        ("REGEX: email", "E-mail addresses are well formed", "email IS NOT NULL", f"NOT regexp_matches(email, '{RULES.email_pattern}')"),
        ("VALUES IN SET: region", "Region is a standard one", "region IS NOT NULL", "region NOT IN ('US', 'EU', 'APAC')"),
        ("DATE RANGE: registration_date", "Registration date is not before 2010 or ahead", "registration_date IS NOT NULL", f"registration_date NOT BETWEEN TIMESTAMP '2010-01-01' AND {o.CUSTOMER_AS_OF}"),
    ]
    rows = []
    for name, description, counted, failing in checks:
        total = f"(SELECT count(*) FROM {t} WHERE {counted})"
        failed = failing if failing.startswith("(SELECT") else f"(SELECT count(*) FROM {t} WHERE {counted} AND {failing})"
        rows.append((name, description, total, failed))
    select, tables = report_sql(rows)
    return o.query(select, **tables)


@add("q_customer_suite", _customer_report_sql())
def q_customer_suite(spark, sf):
    """Q1-Q4, Q6, Q8, Q10."""
    return quality.customer_report(golden(spark, sf), RULES)


@add(
    "q_report_summary",
    "SELECT count(*) AS checks, count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status = 'FAIL') AS failed, "
    f"count(*) FILTER (WHERE status = 'FAIL') = 0 AS all_passed FROM ({_customer_report_sql()})",
)
def q_report_summary(spark, sf):
    """Q8, Q11's count."""
    return quality.report_summary(quality.customer_report(golden(spark, sf), RULES))


@add(
    "e_monthly_registrations",
    o.query(
        """SELECT CAST(last_day(m) AS DATE) AS month_end, (SELECT count(*) FROM golden_customers WHERE date_trunc('month', registration_date) = m) AS registrations
        FROM (SELECT unnest(generate_series(date_trunc('month', min(registration_date)), date_trunc('month', max(registration_date)), INTERVAL 1 MONTH)) AS m FROM golden_customers)"""
    ),
)
def e_monthly_registrations(spark, sf):
    """A13."""
    return profile.monthly_registrations(golden(spark, sf))


@add("e_contribution", o.query("SELECT unnest(string_split(sources, ',')) AS source, count(*) AS customers FROM golden_customers WHERE sources IS NOT NULL GROUP BY 1"))
def e_contribution(spark, sf):
    """A14."""
    return profile.contribution_by_source(golden(spark, sf))


@add(
    "e_completeness",
    o.query(" UNION ALL ".join(f"SELECT '{c}' AS field, {o.four(f'count({c}) / count(*)')} AS completeness FROM golden_customers" for c in ("email", "first_name", "last_name", "phone", "region"))),
)
def e_completeness(spark, sf):
    """A15."""
    return profile.field_completeness(golden(spark, sf))


@add("e_validity", o.query("SELECT 'Valid' AS validity, count(*) FILTER (WHERE email_valid) AS customers FROM golden_customers UNION ALL SELECT 'Invalid', count(*) FILTER (WHERE NOT email_valid) FROM golden_customers"))
def e_validity(spark, sf):
    """A16."""
    return profile.email_validity(golden(spark, sf))


@add("e_opt_out_rate", o.query(f"SELECT region, {o.four('avg(CASE WHEN opt_out THEN 1.0 ELSE 0.0 END)')} AS opt_out_rate FROM golden_customers WHERE region IS NOT NULL GROUP BY 1"))
def e_opt_out_rate(spark, sf):
    """A17."""
    return profile.opt_out_rate_by_region(golden(spark, sf))


# --- text sources ------------------------------------------------------------------


@add("s_flatten_json", "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
def s_flatten_json(spark, sf):
    """F29 on parsed JSON text."""
    parsed = table(spark, sf, "events").select("event_id", "user_id", F.from_json("props", "k bigint").alias("props"))
    return flatten_json(parsed)


_ELEMENT = """CASE s_suppkey % 12 WHEN 0 THEN 'plain text' WHEN 1 THEN '17' WHEN 2 THEN '{"employee_identifier": 0}' WHEN 3 THEN '{"employee_identifier": ""}'
    WHEN 4 THEN '{"employee_identifier": null}' WHEN 5 THEN '[1]'
    ELSE '{"employee_identifier": "' || s_name || '", "name": {"first": "F' || CAST(s_suppkey AS STRING) || '"}, "contact": {"email": "' || lower(s_name) || '@x.com"}, "assignment": {"location": "N' || CAST(s_nationkey AS STRING) || '"}}' END"""


@add(
    "s_json_elements",
    "SELECT s_name AS employee_id, 'F' || CAST(s_suppkey AS STRING) AS first_name, CAST(NULL AS VARCHAR) AS last_name, lower(s_name) || '@x.com' AS email, "
    "'N' || CAST(s_nationkey AS STRING) AS country, 'AcquiredCo' AS company_origin FROM supplier WHERE s_suppkey % 12 > 5",
)
def s_json_elements(spark, sf):
    """Elements of an export, checked, parsed and flattened."""
    rows = readers.checked_elements(table(spark, sf, "supplier").selectExpr(f"{_ELEMENT} AS element"))
    good = rows.where(F.col("reason").isNull())
    return align_employees(good, "acquiredco_hris").select("employee_id", "first_name", "last_name", "email", "country", "company_origin")


_LINE = "lpad(CAST(c_custkey AS STRING), 10, ' ') || rpad(c_mktsegment || ' de ' || c_name, 50, ' ') || rpad('User' || CAST(c_custkey AS STRING) || '@x.com', 60, ' ') || " \
    "rpad(CASE WHEN c_custkey % 4 = 0 THEN 'N/A' ELSE '555 ' || CAST(c_custkey + 1000000 AS STRING) END, 20, ' ') || rpad(CASE WHEN c_custkey % 3 = 0 THEN 'EU' ELSE 'NA' END, 5, ' ') || " \
    "CASE WHEN c_custkey % 5 = 0 THEN '          ' ELSE '2019-05-' || lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0') END || 'ACTIV'"


@add(
    "s_fixed_width",
    "SELECT 'User' || CAST(c_custkey AS STRING) || '@x.com' AS email, c_mktsegment AS first_name, 'de ' || c_name AS last_name, "
    "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '555 ' || CAST(c_custkey + 1000000 AS STRING) END AS phone, CASE WHEN c_custkey % 3 = 0 THEN 'EU' END AS region, "
    "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST('2019-05-' || lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0') AS TIMESTAMP) END AS registration_date, "
    "CAST(NULL AS VARCHAR) AS opt_out, 'erp' AS source FROM customer",
)
def s_fixed_width(spark, sf):
    """S7, D8, F26."""
    lines = table(spark, sf, "customer").selectExpr(f"{_LINE} AS value")
    return readers.erp_customers(readers.fixed_width(lines, ERP_LAYOUT))


_CSV_LINE = "CAST(p_partkey AS STRING) || ',' || CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN '\"' || p_name || ',' || p_type || '\"' ELSE p_name || ',' || p_type END || CASE WHEN p_partkey % 3 = 0 THEN ',' || p_brand ELSE '' END"


@add(
    "s_over_long",
    "SELECT p_partkey, (2 + CASE WHEN p_partkey % 4 > 1 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END) > 3 AS too_long FROM part",
)
def s_over_long(spark, sf):
    """Delimited lines with more fields than the header."""
    lines = table(spark, sf, "part").selectExpr("p_partkey", f"{_CSV_LINE} AS line")
    return lines.select("p_partkey", readers.over_long(F.col("line"), 3).alias("too_long"))


@add(
    "s_xml_elements",
    "SELECT CAST(o_orderkey AS STRING) AS employee_id, o_orderpriority AS benefit_plans, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS benefit_coverage_level, "
    "substr(CAST(o_orderdate AS STRING), 1, 10) AS benefit_enrollment_date, o_totalprice AS premium_employee FROM orders WHERE o_orderkey % 7 <> 0",
)
def s_xml_elements(spark, sf):
    """Enrolment elements of written files, checked and aligned."""
    elements = table(spark, sf, "orders").selectExpr(
        "'<enrollment><employee_id>' || CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE CAST(o_orderkey AS STRING) END || '</employee_id><plan_type> ' || o_orderpriority || "
        "'</plan_type><coverage_level>' || CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE o_orderstatus END || '</coverage_level><enrollment_date>' || "
        "substr(CAST(o_orderdate AS STRING), 1, 10) || '</enrollment_date><premium_employee>' || CAST(o_totalprice AS STRING) || "
        "'</premium_employee><premium_employer></premium_employer></enrollment>' AS element"
    )
    folder = stage_folder(spark)
    path = write_documents(elements.toDF("value"), f"{folder}/in", "<benefits>", "", "</benefits>")
    rows = readers.read_benefits_xml(spark, path, folder).frame
    return rows.select(
        "employee_id", "benefit_plans", "benefit_coverage_level", "benefit_enrollment_date", F.col("premium_employee").cast("double").alias("premium_employee")
    )


_LAST_PAGE = "CAST(floor(max(s_suppkey) * 3 / 28) AS BIGINT) + 2"


@add(
    "s_paged",
    "SELECT CAST(s_suppkey AS STRING) || '@x.com' AS email, page FROM (SELECT *, CAST(floor(s_suppkey / 7) AS BIGINT) + 1 AS page FROM supplier) "
    f"WHERE page < (SELECT {_LAST_PAGE} FROM supplier) AND s_suppkey % 7 < 6",
)
def s_paged(spark, sf):
    """Pages up to the first empty one, which lies at three quarters of all."""
    suppliers = table(spark, sf, "supplier")
    rows = suppliers.selectExpr("CAST(floor(s_suppkey / 7) AS BIGINT) + 1 AS page", "CASE WHEN s_suppkey % 7 < 6 THEN CAST(s_suppkey AS STRING) || '@x.com' END AS email")
    empty = suppliers.agg(F.expr(_LAST_PAGE).alias("empty"))  # one row
    there = rows.join(F.broadcast(empty)).withColumn("email", F.when(F.col("page") != F.col("empty"), F.col("email")))
    pages = there.groupBy("page").agg(F.count("email").alias("actual_records"), F.lit(1 << 40).alias("total_pages"))
    kept = readers.pages_to_read(pages).select("page")
    return there.join(kept, "page").where("email IS NOT NULL").select("email", "page")


@add("s_count", "SELECT file, total_records, actual_records FROM (SELECT 'customer ' || CAST(o_custkey AS STRING) AS file, CAST(10 AS BIGINT) AS total_records, count(*) AS actual_records FROM orders GROUP BY o_custkey) WHERE total_records <> actual_records")
def s_count(spark, sf):
    """Stated against actual number of elements."""
    docs = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("actual_records"))
    stated = docs.selectExpr("'customer ' || CAST(o_custkey AS STRING) AS _file", "CAST(10 AS BIGINT) AS total_records", "actual_records")
    return readers.reconcile_count(stated)


@add("u_stack", "SELECT 'customer' AS kind, c_custkey AS key, c_acctbal AS balance, CAST(NULL AS DOUBLE) AS price FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier UNION ALL SELECT 'part', p_partkey, NULL, p_retailprice FROM part")
def u_stack(spark, sf):
    """Frames with different columns."""
    return union_sources(
        [
            table(spark, sf, "customer").selectExpr("'customer' AS kind", "c_custkey AS key", "c_acctbal AS balance"),
            table(spark, sf, "supplier").selectExpr("'supplier' AS kind", "s_suppkey AS key", "s_acctbal AS balance"),
            table(spark, sf, "part").selectExpr("'part' AS kind", "p_partkey AS key", "p_retailprice AS price"),
        ]
    )
