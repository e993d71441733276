"""Queries that write the dirty sources as files, read them back and check what the readers gave."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.config import CUSTOMER_SCHEMA, EMPLOYEE_SCHEMA
from recordloom.operators.ordinal import preview, with_place
from recordloom.plans.staging import stage_folder
from recordloom.sinks import files
from recordloom.sources import readers
from recordloom.sources.align import union_sources
from workload import customers, employees
from workload import oracle as o
from workload.inputs import CUSTOMER_RULES, EMPLOYEE_RULES, source, table, write_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_CSV = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": ""}
_COLUMNS = [c for c in EMPLOYEE_SCHEMA if not c.startswith("premium")]


def add(name: str, sql: str):
    def register(fn):
        QUERIES[name] = fn
        ORACLES[name] = sql
        return fn

    return register


def _csv(df: DataFrame, path: str, **options: str) -> str:
    df.write.options(**_CSV, **options).csv(path)
    return path


def hris_csv(spark, sf: str, folder: str) -> readers.Ingested:
    path = _csv(source(spark, sf, "globaltech_hris").drop("_position"), f"{folder}/hris")
    return readers.read_hris_csv(spark, path, folder)


def hris_json(spark, sf: str, folder: str) -> readers.Ingested:
    element = F.to_json(
        F.struct(
            "employee_identifier",
            F.struct(F.col("name_first").alias("first"), F.col("name_last").alias("last")).alias("name"),
            F.struct(F.col("contact_email").alias("email")).alias("contact"),
            F.struct(*(F.col(f"assignment_{c}").alias(c) for c in ("department", "role", "hire_timestamp", "location"))).alias("assignment"),
            "employment_type", "employment_status", "manager_employee_id",
        )
    )
    rows = source(spark, sf, "acquiredco_hris").select(element.alias("value"))
    path = write_documents(rows, f"{folder}/api", '{"total_records": 7, "employees": [', ", ", "]}")
    return readers.read_hris_json(spark, path, folder)


def payroll_csv(spark, sf: str, folder: str) -> readers.Ingested:
    path = _csv(source(spark, sf, "payroll").drop("_position"), f"{folder}/pay")
    return readers.read_payroll(spark, path, EMPLOYEE_RULES, "csv", folder)


def benefits_xml(spark, sf: str, folder: str) -> readers.Ingested:
    rows = source(spark, sf, "benefits")
    cells = [F.concat(F.lit(f"<{c}>"), F.coalesce(c, F.lit("")), F.lit(f"</{c}>")) for c in rows.columns]
    element = F.concat(F.lit("<enrollment>"), *cells, F.lit("</enrollment>")).alias("value")
    return readers.read_benefits_xml(spark, write_documents(rows.select(element), f"{folder}/plans", "<benefits>", "", "</benefits>"), folder)


_ALL = {"globaltech_hris": hris_csv, "acquiredco_hris": hris_json, "payroll": payroll_csv, "benefits": benefits_xml}


def _std(name: str, columns: list[str]) -> str:
    return o.query(f"SELECT {', '.join(columns)} FROM std_{name}")


@add("s_hris_csv", _std("globaltech_hris", _COLUMNS))
def s_hris_csv(spark, sf):
    """Employee CSV files, all standard columns."""
    return hris_csv(spark, sf, stage_folder(spark)).frame.select(*_COLUMNS)


@add("s_hris_json", _std("acquiredco_hris", _COLUMNS))
def s_hris_json(spark, sf):
    """Employee JSON documents."""
    return hris_json(spark, sf, stage_folder(spark)).frame.select(*_COLUMNS)


@add("s_payroll_csv", _std("payroll", _COLUMNS))
def s_payroll_csv(spark, sf):
    """S3: payroll CSV files."""
    return payroll_csv(spark, sf, stage_folder(spark)).frame.select(*_COLUMNS)


@add(
    "s_benefits_xml",
    o.query("SELECT employee_id, benefit_plans, nullif(trim(benefit_coverage_level), '') AS benefit_coverage_level, benefit_enrollment_date, CAST(premium_employee AS DOUBLE) AS premium_employee, CAST(premium_employer AS DOUBLE) AS premium_employer FROM std_benefits"),
)
def s_benefits_xml(spark, sf):
    """Enrolment files."""
    frame = benefits_xml(spark, sf, stage_folder(spark)).frame
    premiums = [F.col(c).cast("double").alias(c) for c in ("premium_employee", "premium_employer")]
    return frame.select("employee_id", "benefit_plans", "benefit_coverage_level", "benefit_enrollment_date", *premiums)


_NO_ID = employees._NO_ID


@add(
    "p_job_rejects",
    o.query(
        f"""SELECT source_system, reason, count(*) AS rejects FROM (
        SELECT 'globaltech_hris' AS source_system, 'Missing required identity field: employee_id' AS reason FROM raw_globaltech_hris WHERE {_NO_ID}
        UNION ALL SELECT 'payroll', 'Missing required identity field: employee_id' FROM raw_payroll WHERE {_NO_ID}
        UNION ALL SELECT 'payroll', 'Unknown payroll company source' FROM raw_payroll WHERE NOT ({_NO_ID}) AND NOT coalesce(source IN ('GlobalTech', 'AcquiredCo'), false)
        UNION ALL SELECT 'benefits', 'Malformed enrollment or missing employee_id/plan_type' FROM raw_benefits WHERE {_NO_ID} OR plan_type IS NULL
        UNION ALL SELECT source_system, 'Unformattable employee id' FROM ("""
        + " UNION ALL ".join(f"SELECT source_system FROM cln_{n} WHERE employee_id IS NULL" for n in _ALL)
        + ")) GROUP BY 1, 2"
    ),
)
def p_job_rejects(spark, sf):
    """Dead letters of all four sources as the job writes them, read back."""
    from recordloom.operators.clean import clean_all_employees
    from recordloom.operators.quarantine import reject_unformattable_ids

    folder = stage_folder(spark)
    read = {n: fn(spark, sf, folder) for n, fn in _ALL.items()}
    cleaned = clean_all_employees({n: got.frame for n, got in read.items()}, EMPLOYEE_RULES)
    lost = [reject_unformattable_ids(df, n)[1] for n, df in cleaned.items()]
    path = files.write_dead_letters(union_sources([*(got.rejects for got in read.values()), *lost]), f"{folder}/dead")
    return files.read_dead_letters(spark, path).groupBy("source_system", "reason").agg(F.count("*").alias("rejects"))


_TITLES = "CASE p_partkey % 3 WHEN 0 THEN p_name || ',' || chr(10) || '\"' || p_type || '\"' WHEN 1 THEN p_type || ', ' || p_brand ELSE p_name END"


@add(
    "s_csv_lines",
    f"SELECT CAST(p_partkey AS VARCHAR) AS employee_id, {_TITLES} AS job_title, CASE WHEN p_partkey % 5 <> 0 THEN 'C' || CAST(p_size AS VARCHAR) END AS country, "
    "'good' AS outcome FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 "
    "UNION ALL SELECT NULL, NULL, NULL, 'Malformed CSV row' FROM part WHERE p_partkey % 7 = 0 "
    "UNION ALL SELECT NULL, NULL, NULL, 'Missing required identity field: employee_id' FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 = 0",
)
def s_csv_lines(spark, sf):
    """Quoted line breaks, commas and quotes, short, over-long and blank lines."""
    title = f"chr(34) || replace({_TITLES}, chr(34), chr(34) || chr(34)) || chr(34)"
    head = "employee_id,job_title,first_name,last_name,email,department,hire_date,employment_type,manager_id,country"
    rows = table(spark, sf, "part").selectExpr(
        f"CASE WHEN p_partkey % 11 = 0 THEN ' ' ELSE CAST(p_partkey AS STRING) END || ',' || {title} || CASE WHEN p_partkey % 7 = 0 THEN repeat(',x', 9) "
        "WHEN p_partkey % 5 = 0 THEN ',A,B' ELSE ',A,B,,,,,,C' || CAST(p_size AS STRING) END || CASE WHEN p_partkey % 4 = 0 THEN chr(10) ELSE '' END AS value"
    )
    folder = stage_folder(spark)
    got = readers.read_hris_csv(spark, write_documents(rows, f"{folder}/in", head + "\n", "", ""), folder)
    bad = got.rejects.select(*(F.lit(None).cast("string").alias(c) for c in ("employee_id", "job_title", "country")), F.col("reason").alias("outcome"))
    return got.frame.select("employee_id", "job_title", "country", F.lit("good").alias("outcome")).unionByName(bad)


_WEB = "SELECT email, first_name, last_name, phone, region, CASE WHEN regexp_matches(registration_date, '^\\d{{4}}-\\d\\d-\\d\\d$') THEN try_strptime(registration_date, '%Y-%m-%d') END AS registration_date, {opt} AS opt_out, '{name}' AS source FROM real_customers WHERE source = '{name}'"


@add("s_website_csv", o.query(_WEB.format(name="website", opt="opt_out").replace(" first_name,", " nullif(first_name, 'nan') AS first_name,").replace(" region,", " nullif(region, 'NA') AS region,")))
def s_website_csv(spark, sf):
    """Latin-1 customer CSV files without test accounts."""
    heads = {"email": "CustomerEmail", "first_name": "First Name", "last_name": "Last Name", "phone": "Phone", "region": "Region", "registration_date": "Registration Date", "opt_out": "OptOut"}
    rows = source(spark, sf, "customers").where("source = 'website'").select(*(F.col(c).alias(h) for c, h in heads.items()))
    folder = stage_folder(spark)
    path = _csv(rows, f"{folder}/web", encoding="ISO-8859-1")
    return readers.read_website(spark, path, CUSTOMER_RULES, folder).frame.select(*CUSTOMER_SCHEMA)


@add("s_crm_json", o.query(_WEB.format(name="crm", opt="CASE WHEN opt_out IN ('1', 'true') THEN '1' WHEN opt_out = '0' THEN '0' END").replace("real_customers", "raw_customers")))
def s_crm_json(spark, sf):
    """Customer JSON documents."""
    flag = F.col("opt_out").isin("1", "true")
    element = F.to_json(F.struct("email", F.struct("first_name", "last_name").alias("profile"), "phone", "region", "registration_date", flag.alias("opt_out")))
    folder = stage_folder(spark)
    path = write_documents(source(spark, sf, "customers").where("source = 'crm'").select(element.alias("value")), f"{folder}/crm", '{"customers": [', ",\n", '], "total_pages": 1}')
    return readers.read_crm_json(spark, path, folder).select(*CUSTOMER_SCHEMA)


# --- files that a run leaves behind ------------------------------------------------


@add("k_dead_letters", employees.ORACLES["p_quarantine"])
def k_dead_letters(spark, sf):
    """K1: dead letters, written and read back."""
    path = files.write_dead_letters(employees.QUERIES["p_quarantine"](spark, sf), f"{stage_folder(spark)}/dead")
    return files.read_dead_letters(spark, path).select("source_system", "reason", "raw_record")


@add("k_ghosts_file", employees.ORACLES["j_ghost"])
def k_ghosts_file(spark, sf):
    """K2, K4: the review file of ghosts, read back."""
    path = files.write_ghosts(employees.QUERIES["j_ghost"](spark, sf), f"{stage_folder(spark)}/ghosts")
    kinds = "payroll_employee_id string, name string, salary_usd_annual double, ghost_flag_reason string, ghost_employee boolean, company_origin string, source_system string"
    return spark.read.schema(kinds).csv(path, header=True, escape='"')


@add("k_quality_file", customers.ORACLES["q_customer_suite"])
def k_quality_file(spark, sf):
    """K6: the quality report, read back."""
    made = customers.QUERIES["q_customer_suite"](spark, sf)
    path = files.write_quality_report(made, f"{stage_folder(spark)}/report")
    return spark.read.schema(made.schema).csv(path, header=True, escape='"')


@add("k_golden", o.query(f"SELECT {o.golden_cells()} FROM employees"))
def k_golden(spark, sf):
    """The golden table, written and read back by company."""
    made = employees.QUERIES["r_employees"](spark, sf)
    path = files.write_golden(made, f"{stage_folder(spark)}/golden")
    parts = [readers.read_golden(spark, path, c) for c in (*EMPLOYEE_RULES.companies, "Unknown")]
    return union_sources(parts).select(*made.columns)


@add("k_golden_customers", customers.ORACLES["a_customers"])
def k_golden_customers(spark, sf):
    """K8: golden customers, written and read back."""
    out = files.write_golden_customers(customers.QUERIES["a_customers"](spark, sf), stage_folder(spark))
    return spark.read.parquet(out["parquet"])


@add("k_stringify", "SELECT o_orderstatus, CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders")
def k_stringify(spark, sf):
    """K9: files whose column types differ, read as text and stacked."""
    folder = stage_folder(spark)
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", "o_custkey")
    odd = F.col("o_orderkey") % 2 == 1
    parts = {"wide": orders.where(odd), "narrow": orders.where(~odd).withColumn("o_custkey", F.col("o_custkey").cast("int"))}
    for name, part in parts.items():
        part.write.parquet(f"{folder}/{name}")
    read = [files.stringify(spark.read.parquet(f"{folder}/{n}"), ("o_orderkey", "o_custkey")) for n in parts]
    return union_sources(read)


# --- places of rows ------------------------------------------------------------------

_UNMAPPED = "SELECT source_system, company_origin, department_original, count(*) AS record_count FROM hris WHERE department_unmapped GROUP BY ALL"


@add("o_unmapped_place", o.query(f"SELECT *, row_number() OVER (ORDER BY source_system, department_original, company_origin) AS place FROM ({_UNMAPPED})"))
def o_unmapped_place(spark, sf):
    """O3: the place of every line of the unmapped departments."""
    lines = files.unmapped_departments([employees.clean_one(spark, sf, n) for n in employees.HRIS])
    return with_place(lines, [F.col(c) for c in ("source_system", "department_original", "company_origin")])


_ORDER = "similarity_score DESC, hire_date_diff_days, record_1_id, record_2_id"


@add("o_review_place", f"SELECT *, row_number() OVER (ORDER BY similarity_score DESC NULLS LAST, hire_date_diff_days NULLS FIRST, record_1_id, record_2_id) AS place FROM ({employees.ORACLES['j_fuzzy']})")
def o_review_place(spark, sf):
    """O2: the place of every pair in the review list."""
    pairs = employees.QUERIES["j_fuzzy"](spark, sf)
    return with_place(pairs, [F.col("similarity_score").desc(), F.col("hire_date_diff_days"), F.col("record_1_id"), F.col("record_2_id")])


@add("o_preview", "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders QUALIFY place <= 12")
def o_preview(spark, sf):
    """The first rows of an order with their places."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return preview(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 12)


@add("o_order_place", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS place FROM orders")
def o_order_place(spark, sf):
    """The place of every row, equal labels split by further columns."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return with_place(rows, [F.col("o_orderpriority"), F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_orderkey", "place")
