"""Dirty sources derived from the star-schema tables, row for row.

Every expression is plain SQL that means the same in Spark and in the checking engine, so
both sides start from the same text. Rows carry a unique ``_position`` in place of the
line number that a file reader would give them.
"""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from recordloom.config import CustomerRules, EmployeeRules
from recordloom.sources.spread import spread

AS_OF = dt.date(2015, 6, 30)
EMPLOYEE_RULES = EmployeeRules(as_of=AS_OF)
CUSTOMER_RULES = CustomerRules(
    as_of=dt.date(2024, 3, 31), test_account_pattern=r"(?i)@test\.example\.org$"
)

_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _two(expression: str) -> str:
    return f"lpad({_text(expression)}, 2, '0')"


def _date_text(key: str) -> str:
    """Dates from 1949 to 2019 in all accepted formats, broken and absent ones too."""
    year, month, day = f"({key} * 7 % 71 + 1949)", f"({key} % 12 + 1)", f"({key} % 28 + 1)"
    iso = f"{_text(year)} || '-' || {_two(month)} || '-' || {_two(day)}"
    return f"""CASE {key} % 8
        WHEN 0 THEN {iso}
        WHEN 1 THEN {_two(month)} || '/' || {_two(day)} || '/' || {_text(year)}
        WHEN 2 THEN {_two(day)} || '-' || substr('{_MONTHS}', 3 * ({month} - 1) + 1, 3) || '-' || {_text(year)}
        WHEN 3 THEN {iso} || 'T08:30:00'
        WHEN 4 THEN {iso} || 'T08:30:00Z'
        WHEN 5 THEN ' ' || {iso} || ' 23:59:59 '
        WHEN 6 THEN CASE WHEN {key} % 3 = 0 THEN 'not a date' ELSE {iso} END
        ELSE CASE WHEN {key} % 5 = 0 THEN NULL ELSE {iso} END END"""


_DEPARTMENT = """CASE {k} % 9 WHEN 0 THEN 'ENG-01' WHEN 1 THEN 'sales ' WHEN 2 THEN '  Human  Resources'
    WHEN 3 THEN 'Mystery Team' WHEN 4 THEN NULL WHEN 5 THEN 'finance' WHEN 6 THEN 'DEVOPS'
    WHEN 7 THEN 'mkt-03' ELSE 'Legal' END"""
_EMPLOYMENT = """CASE {k} % 6 WHEN 0 THEN 'ft' WHEN 1 THEN 'Part  Time' WHEN 2 THEN 'CONTRACTOR'
    WHEN 3 THEN 'temp' WHEN 4 THEN NULL ELSE 'Full-Time' END"""
_NAME = """'  ' || substr({s}, 1, 3) || CASE {k} % 5 WHEN 0 THEN '-' WHEN 1 THEN chr(39) WHEN 2 THEN '  '
    WHEN 3 THEN 'É' ELSE chr(160) END || lower(substr({s}, 4)) || CASE WHEN {k} % 11 = 0 THEN ' ﬁ' ELSE '' END"""

# source -> (table, column -> expression)
SOURCES: dict[str, tuple[str, dict[str, str]]] = {
    "globaltech_hris": (
        "customer",
        {
            "employee_id": """CASE WHEN c_custkey % 97 = 0 THEN ' ' WHEN c_custkey % 89 = 0
                THEN 'GT' || CAST(c_custkey + 5000000 AS STRING)
                ELSE ' GT' || lpad(CAST(c_custkey - (CASE WHEN c_custkey % 10 = 1 THEN 1 ELSE 0 END) AS STRING), CAST(greatest(6, length(CAST(c_custkey - (CASE WHEN c_custkey % 10 = 1 THEN 1 ELSE 0 END) AS STRING))) AS INTEGER), '0') END""",
            "first_name": _NAME.format(k="c_custkey", s="c_mktsegment"),
            "last_name": f"CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE {_NAME.format(k='(c_custkey + 2)', s='c_mktsegment')} END",
            "email": """CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 'broken@'
                ELSE ' User' || CAST(c_custkey % 900 AS STRING) || '@Example.com' END""",
            "department": _DEPARTMENT.format(k="c_custkey"),
            "job_title": "c_mktsegment",
            "hire_date": _date_text("c_custkey"),
            "country": "CASE WHEN c_nationkey % 12 = 0 THEN NULL ELSE 'Country ' || CAST(c_nationkey AS STRING) END",
            "employment_type": _EMPLOYMENT.format(k="c_custkey"),
            "manager_id": """CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN '777777'
                ELSE CAST(c_custkey % 50 AS STRING) END""",
            "_position": "c_custkey",
        },
    ),
    "acquiredco_hris": (
        "supplier",
        {
            "employee_identifier": """CASE WHEN s_suppkey % 10 = 3 THEN 'ACQ_DUP_' || lpad(CAST(s_suppkey - 1 AS STRING), CAST(greatest(5, length(CAST(s_suppkey - 1 AS STRING))) AS INTEGER), '0')
                ELSE 'ACQ_' || lpad(CAST(s_suppkey AS STRING), CAST(greatest(5, length(CAST(s_suppkey AS STRING))) AS INTEGER), '0') END""",
            "name_first": _NAME.format(k="s_suppkey", s="s_name"),
            "name_last": "CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE 'van der ' || s_name END",
            "contact_email": "CASE WHEN s_suppkey % 10 = 3 THEN NULL ELSE 'USER' || CAST(s_suppkey * 3 AS STRING) || '@example.com ' END",
            "assignment_department": _DEPARTMENT.format(k="s_suppkey"),
            "assignment_role": "CASE WHEN s_suppkey % 10 = 2 THEN NULL ELSE s_name END",
            "assignment_hire_timestamp": _date_text("s_suppkey"),
            "assignment_location": "'Country ' || CAST(s_nationkey AS STRING)",
            "employment_type": _EMPLOYMENT.format(k="s_suppkey"),
            "employment_status": "CASE s_suppkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN NULL ELSE 'leave' END",
            "manager_employee_id": "'ACQ_' || lpad(CAST(s_suppkey % 5 AS STRING), CAST(greatest(5, length(CAST(s_suppkey % 5 AS STRING))) AS INTEGER), '0')",
            "_position": "s_suppkey",
        },
    ),
    "payroll": (
        "orders",
        {
            "employee_id": """CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN '  '
                WHEN o_orderkey % 4 = 3 THEN 'ACQ_' || lpad(CAST(o_custkey % 150 AS STRING), CAST(greatest(5, length(CAST(o_custkey % 150 AS STRING))) AS INTEGER), '0')
                ELSE 'GT' || CAST(o_custkey AS STRING) END""",
            "source": """CASE WHEN o_orderkey % 107 = 0 THEN ' GlobalTech' WHEN o_orderkey % 109 = 0 THEN NULL
                WHEN o_orderkey % 4 = 3 THEN 'AcquiredCo' ELSE 'GlobalTech' END""",
            "base_salary": """CASE o_orderkey % 7 WHEN 0 THEN NULL
                WHEN 1 THEN '$' || CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING) || ',' || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING), CAST(greatest(3, length(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING))) AS INTEGER), '0')
                WHEN 2 THEN '(' || CAST(o_totalprice AS STRING) || ')'
                WHEN 3 THEN '€ ' || CAST(o_totalprice AS STRING)
                WHEN 4 THEN 'unknown'
                ELSE CAST(o_totalprice AS STRING) END""",
            "currency": "CASE o_orderkey % 5 WHEN 0 THEN 'usd' WHEN 1 THEN ' EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'USD' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'JPY' ELSE NULL END END",
            "pay_frequency": "CASE o_orderkey % 6 WHEN 0 THEN 'annual' WHEN 1 THEN 'Monthly' WHEN 2 THEN ' BI-WEEKLY' WHEN 3 THEN 'Annual' WHEN 4 THEN 'weekly' ELSE 'ANNUAL' END",
            "bonus_target_pct": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 20 AS DOUBLE) END",
            "effective_date": "CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'soon' ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END",
            "_position": "o_orderkey",
        },
    ),
    "benefits": (
        "lineitem",
        {
            "employee_id": "CAST(l_orderkey % 2000 AS STRING)",
            "plan_type": "CASE l_returnflag WHEN 'A' THEN 'Dental' WHEN 'N' THEN 'Vision' ELSE 'Health' END",
            "coverage_level": "CASE WHEN l_partkey % 5 = 0 THEN ' ' WHEN l_linestatus = 'F' THEN 'Family' ELSE 'Individual' END",
            "enrollment_date": "CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE substr(CAST(l_shipdate AS STRING), 1, 10) END",
            "premium_employee": "CAST(l_quantity AS STRING)",
            "premium_employer": "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE CAST(l_discount AS STRING) END",
        },
    ),
    "customers": (
        "events",
        {
            "email": """CASE WHEN event_id % 47 = 0 THEN 'not-an-email' WHEN event_id % 53 = 0 THEN NULL
                WHEN event_id % 59 = 0 THEN 't' || CAST(event_id AS STRING) || '@TEST.example.org'
                ELSE ' User' || CAST(user_id AS STRING) || CASE WHEN event_id % 2 = 0 THEN '@Example.COM ' ELSE '@ example.com' END END""",
            "first_name": "CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'nan' ELSE '  ' || event_type || '  mARY-jane' END",
            "last_name": "CASE WHEN event_id % 5 < 2 THEN NULL ELSE 'o' || chr(39) || event_type END",
            "phone": "CASE event_id % 4 WHEN 0 THEN '+1 (555) ' || lpad(CAST(event_id AS STRING), CAST(greatest(7, length(CAST(event_id AS STRING))) AS INTEGER), '0') WHEN 1 THEN '555.' || CAST(user_id AS STRING) WHEN 2 THEN NULL ELSE '020 ' || lpad(CAST(event_id AS STRING), CAST(greatest(8, length(CAST(event_id AS STRING))) AS INTEGER), '1') END",
            "region": "CASE event_id % 9 WHEN 0 THEN 'usa' WHEN 1 THEN ' EMEA' WHEN 2 THEN 'Asia Pacific' WHEN 3 THEN 'NA' WHEN 4 THEN 'Mars' WHEN 5 THEN 'eu' ELSE NULL END",
            "registration_date": "CASE WHEN event_id % 31 = 0 THEN 'unknown' WHEN event_id % 6 = 0 THEN NULL ELSE CAST(2009 + user_id % 16 AS STRING) || substr(CAST(ts AS STRING), 5, 6) END",
            "opt_out": "CASE event_id % 11 WHEN 0 THEN '1' WHEN 1 THEN 'true' WHEN 2 THEN NULL ELSE '0' END",
            "source": "CASE event_type WHEN 'click' THEN 'crm' WHEN 'view' THEN 'website' WHEN 'purchase' THEN 'erp' WHEN 'error' THEN 'marketing' ELSE 'partner' END",
            "_position": "event_id",
        },
    ),
    "people": (
        "part",
        {
            "employee_id": "CASE WHEN p_partkey % 2 = 0 THEN 'GT-' ELSE 'AC-' END || lpad(CAST(p_partkey AS STRING), CAST(greatest(9, length(CAST(p_partkey AS STRING))) AS INTEGER), '0')",
            "first_name": """CASE p_partkey % 5 WHEN 0 THEN replace(p_name, 'e', '') WHEN 1 THEN p_name || 's' WHEN 2 THEN ' ' || replace(p_name, ' ', '  ')
                ELSE p_name END""",
            "last_name": "CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 7 = 1 THEN substr(p_type, 1, 3) ELSE substr(p_type, 1, 4) END",
            "hire_date": """CAST(CAST(2005 + p_partkey * 13 % 15 AS STRING) || '-' || lpad(CAST(1 + p_partkey * 5 % 12 AS STRING), CAST(greatest(2, length(CAST(1 + p_partkey * 5 % 12 AS STRING))) AS INTEGER), '0') || '-' ||
                lpad(CAST(1 + p_partkey * 11 % 28 AS STRING), CAST(greatest(2, length(CAST(1 + p_partkey * 11 % 28 AS STRING))) AS INTEGER), '0') || ' ' || lpad(CAST(p_partkey % 24 AS STRING), CAST(greatest(2, length(CAST(p_partkey % 24 AS STRING))) AS INTEGER), '0') || ':00:00' AS {NTZ})""",
            "company_origin": "CASE WHEN CAST(floor(p_partkey / 7) AS BIGINT) % 2 = 0 THEN 'GlobalTech' WHEN p_partkey % 15 = 1 THEN NULL ELSE 'AcquiredCo' END",
        },
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A dirty source as a DataFrame."""
    origin, columns = SOURCES[name]
    return spread(table(spark, sf_dir, origin)).selectExpr(
        *(f"{e.replace('{NTZ}', 'TIMESTAMP_NTZ')} AS `{c}`" for c, e in columns.items())
    )


def source_sql(name: str) -> str:
    """The same rows as a sub-query for the checking engine."""
    origin, columns = SOURCES[name]
    cells = ", ".join(f"{e.replace('{NTZ}', 'TIMESTAMP')} AS {c}" for c, e in columns.items())
    return f"SELECT {cells} FROM {origin}"


def write_documents(values: DataFrame, path: str, first: str, between: str, last: str) -> str:
    """One text file per partition: its ``value`` texts with something before, between and after."""

    def document(batches):
        lead = first
        for batch in batches:
            values = batch.column(0)
            if values.null_count:
                raise ValueError("a document can't hold a null value")
            if len(values):
                leads = pa.array([lead], pa.string()), pa.repeat(pa.scalar(between, pa.string()), len(values) - 1)
                lead = between
                texts = pc.binary_join_element_wise(pa.concat_arrays(leads), values.cast(pa.string()), "")
                yield pa.RecordBatch.from_arrays([texts], names=["value"])
        end = last if lead == between else first + last
        yield pa.RecordBatch.from_arrays([pa.array([end])], names=["value"])

    values.mapInArrow(document, "value string").write.text(path)
    return path
