"""File readers with quarantine.

A reader parses its files once and writes every record with its outcome; the standard-schema rows
and the rejects are both read from that table. Large CSV, JSON and XML files are read in ranges,
by as many tasks as there are. The driver gets a line per range, a header or name per file,
counts and flags. Every row carries its place in the file, which later settles ties the way file
order would. Tables go to ``folder``, or to a fresh stage folder where none is given.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.config import (
    ACQUIRED_JSON_ELEMENT,
    CRM_JSON_ELEMENT,
    EMPLOYEE_SCHEMA,
    ERP_LAYOUT,
    NULL_TOKENS,
    POSITION,
    REQUIRED_COLUMNS,
    WEBSITE_NULL_TOKENS,
    CustomerRules,
    EmployeeRules,
)
from recordloom.functions.dates import iso_timestamp
from recordloom.functions.text import is_blank, null_tokens, split_full_name, strip
from recordloom.operators.quarantine import no_rejects
from recordloom.plans.staging import stage_folder
from recordloom.sinks.files import current_version
from recordloom.sources.align import (
    align_customers,
    align_employees,
    flatten_json,
    missing_columns,
    normalize_headers,
    union_sources,
)
from recordloom.sources.csv_ranges import read_records, split_cells
from recordloom.sources.json_ranges import read_array
from recordloom.sources.outcomes import RAW, REASON, mark, written
from recordloom.sources.xml_ranges import read_elements

_LINE, _TOO_LONG = "_line", "_too_long"
_WITH_NULLS = {"ignoreNullFields": "false"}


@dataclass(frozen=True)
class Ingested:
    """Good rows in the standard schema and the rejected records of one source.

    ``seen`` has what was counted while the source was written; ``stated`` the documents whose
    stated number of records is not the actual one.
    """

    frame: DataFrame
    rejects: DataFrame
    seen: Mapping[str, object] = field(default_factory=dict)
    stated: DataFrame | None = None


#: columns that a reader adds to those of the source
_BESIDE = (POSITION, _LINE, _TOO_LONG, REASON, RAW)


def empty_employees(spark: SparkSession) -> DataFrame:
    ddl = ", ".join(f"{n} {k}" for n, k in EMPLOYEE_SCHEMA.items())
    return spark.createDataFrame([], ddl)


def _row_position() -> Column:
    # taken directly on the scan: the id grows with the row within each file block
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(POSITION)


def guarded_read(
    spark: SparkSession, source: str, path: str, reader: Callable[[], Ingested]
) -> Ingested:
    """Turn a missing or unreadable source into one reject and an empty frame."""
    try:
        return reader()
    except (PySparkException, ValueError, OSError) as error:
        reason = f"{type(error).__name__}: {str(error).splitlines()[0]}"
        return _source_failure(spark, source, reason, F.struct(F.lit(path).alias("filepath")))


def _source_failure(
    spark: SparkSession, source: str, reason: str, record: Column, rows: DataFrame | None = None
) -> Ingested:
    """One reject and an empty frame; with ``rows`` only where these are not empty."""
    row = (spark.range(1) if rows is None else rows.limit(1)).select(
        F.lit(source).alias("source_system"),
        F.lit(reason).alias("reason"),
        F.to_json(record).alias("raw_record"),
    )
    return Ingested(empty_employees(spark), row)


def require_columns(df: DataFrame, source: str, read: Callable[[DataFrame], Ingested]) -> Ingested:
    """Go on with ``read`` only when the source has its required columns."""
    missing = missing_columns(df, REQUIRED_COLUMNS[source])
    if not missing:
        return read(df)
    available = F.array(*(F.lit(c) for c in df.columns if c not in _BESIDE)).cast("array<string>")
    return _source_failure(
        df.sparkSession,
        source,
        f"Missing required columns: {missing}",
        F.struct(available.alias("available_columns")),
    )


def over_long(raw: Column, width: int) -> Column:
    """True when a delimited line has more than ``width`` fields."""
    line = F.regexp_replace(raw, r"[\r\n]+$", "")
    return raw.isNotNull() & split_cells(line, [f"c{i}" for i in range(width)])[1]


def _read_csv(
    spark: SparkSession, path: str, encoding: str, tokens: Iterable[str], folder: str
) -> DataFrame:
    """Records with all cells as text under the header's names, null texts as null.

    Cells are bound by position, so the files of one source must have equal headers; the read
    fails otherwise. Names that are blank or repeated get their place as their end.
    """
    found = read_records(spark, path, encoding, folder)
    cells = [null_tokens(F.col(f"`{n}`"), tokens).alias(n) for n in found.names]
    return found.rows.select(
        *cells,
        F.col("line").alias(_LINE),
        F.col("too_long").alias(_TOO_LONG),
        F.col("_pos").alias(POSITION),
    )


def _raw_record(df: DataFrame) -> Column:
    """A record as JSON with its nulls; one with too many cells also has its line."""
    cells = [F.col(f"`{c}`") for c in df.columns if c not in _BESIDE]
    plain = F.to_json(F.struct(*cells), _WITH_NULLS)
    if _TOO_LONG not in df.columns:
        return plain
    whole = F.to_json(F.struct(*cells, F.col(_LINE).alias("line")), _WITH_NULLS)
    return F.when(F.col(_TOO_LONG), whole).otherwise(plain)


def _too_long(df: DataFrame) -> list[tuple[Column, str]]:
    """Lines with more cells than the header are rejected whole; shorter ones have null cells."""
    return [(F.col(_TOO_LONG), "Malformed CSV row")] if _TOO_LONG in df.columns else []


def _no_identity(column: str) -> tuple[Column, str]:
    return is_blank(F.col(column)), f"Missing required identity field: {column}"


def _employee_table(
    df: DataFrame, source: str, folder: str, checks: Sequence[tuple[Column, str]]
) -> Ingested:
    """Rows of a table source, checked and written once."""
    marked = mark(df, [*_too_long(df), *checks], _raw_record(df)).drop(_LINE, _TOO_LONG)
    got = written(marked, source, folder)
    return Ingested(align_employees(got.good, source), got.rejects, got.seen)


def read_hris_csv(spark: SparkSession, path: str, folder: str | None = None) -> Ingested:
    """Employee CSV: over-long lines are rejected, short ones padded with null."""
    source = "globaltech_hris"
    folder = folder or stage_folder(spark)

    def read() -> Ingested:
        raw = _read_csv(spark, path, "UTF-8", NULL_TOKENS, folder)
        return require_columns(
            raw, source, lambda df: _employee_table(df, source, folder, [_no_identity("employee_id")])
        )

    return guarded_read(spark, source, path, read)


def _position() -> Column:
    return F.struct(
        F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_pos").alias("row")
    ).alias(POSITION)


def truthy(element: Column, key: str) -> Column:
    """The element is an object whose ``key`` holds something other than null, empty or 0."""
    document = F.try_parse_json(element)
    value = F.try_variant_get(document, f"$.{key}", "variant")
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(document, f"$.{key}", "string")
    falsy = (
        (kind == "VOID")
        | ((kind == "STRING") & (text == ""))
        | ((kind == "BOOLEAN") & (text == "false"))
        | (kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & (text.try_cast("double") == 0))
        | (kind.rlike("^(ARRAY|OBJECT)") & text.isin("[]", "{}"))
    )
    return F.coalesce(~falsy, F.lit(False)) & value.isNotNull()


_JSON_PATHS = {
    "employee_identifier": "$.employee_identifier",
    "name_first": "$.name.first",
    "name_last": "$.name.last",
    "contact_email": "$.contact.email",
    "assignment_department": "$.assignment.department",
    "assignment_role": "$.assignment.role",
    "assignment_hire_timestamp": "$.assignment.hire_timestamp",
    "assignment_location": "$.assignment.location",
    "employment_type": "$.employment_type",
    "employment_status": "$.employment_status",
    "manager_employee_id": "$.manager_employee_id",
}


def checked_elements(elements: DataFrame) -> DataFrame:
    """Employee elements, parsed and flattened, with the reason and record of bad ones."""
    document = F.try_parse_json("element")
    is_object = F.coalesce(F.schema_of_variant(document).startswith("OBJECT"), F.lit(False))
    shown = F.when(is_object, F.col("element")).otherwise(
        F.concat(F.lit('{"raw_value":'), F.coalesce("element", F.lit("null")), F.lit("}"))
    )
    bad = ~truthy(F.col("element"), "employee_identifier")
    marked = mark(elements, [(bad, "Malformed JSON employee or missing employee_identifier")], shown)
    parsed = F.from_json("element", ACQUIRED_JSON_ELEMENT).alias("e")
    rest = [c for c in marked.columns if c != "element"]
    has = [F.try_variant_get(document, p, "variant").isNotNull().alias(f"has_{n}") for n, p in _JSON_PATHS.items()]
    return flatten_json(marked.select(parsed, *rest, *has).select("e.*", *rest, *(f"has_{n}" for n in _JSON_PATHS)))


def read_hris_json(spark: SparkSession, path: str, folder: str | None = None) -> Ingested:
    """Employee JSON export: bad elements are rejected, good ones flattened."""
    source = "acquiredco_hris"
    folder = folder or stage_folder(spark)

    def read() -> Ingested:
        found = read_array(spark, path, "employees", "total_records bigint", folder)
        unreadable = found.docs.where(~F.col("readable")).select(
            F.lit(source).alias("source_system"),
            F.lit("Unreadable document or 'employees' is not a list").alias(REASON),
            F.to_json(F.struct(F.col("_file").alias("filepath"))).alias(RAW),
        )
        marked = checked_elements(found.elements.select("element", _position()))
        got = written(marked, source, folder, **{n: F.col(f"has_{n}") for n in _JSON_PATHS})
        # with no good element at all there is nothing to miss
        present = {n for n in _JSON_PATHS if got.seen[n] or got.seen[n] is None}
        good = got.good.drop(*(f"has_{n}" for n in _JSON_PATHS))
        seen = good.select(*(c for c in good.columns if c in present or c == POSITION))
        rows = require_columns(
            seen, source, lambda df: Ingested(align_employees(df, source), no_rejects(spark))
        )
        rejects = union_sources([unreadable, got.rejects, rows.rejects])
        return Ingested(rows.frame, rejects, got.seen, reconcile_count(found.docs))

    return guarded_read(spark, source, path, read)


def reconcile_count(docs: DataFrame) -> DataFrame:
    """Documents whose stated total differs from their number of elements."""
    return docs.where(F.col("total_records") != F.col("actual_records")).select(
        F.col("_file").alias("file"), "total_records", "actual_records"
    )


def read_payroll(
    spark: SparkSession,
    path: str,
    rules: EmployeeRules,
    fmt: str = "parquet",
    folder: str | None = None,
) -> Ingested:
    """Payroll table in Parquet or CSV; missing ids and unknown companies rejected (S3).

    Lines of a CSV with more cells than its header are rejected too.
    """
    source = "payroll"
    folder = folder or stage_folder(spark)

    def read() -> Ingested:
        if fmt == "csv":
            raw = _read_csv(spark, path, "UTF-8", NULL_TOKENS, folder)
        else:
            raw = spark.read.format(fmt).load(path).select("*", _row_position())

        def check(df: DataFrame) -> Ingested:
            # null and padded company texts fail too
            known = F.coalesce(F.col("source").isin(*rules.companies), F.lit(False))
            checks = [_no_identity("employee_id"), (~known, "Unknown payroll company source")]
            return _employee_table(df, source, folder, checks)

        return require_columns(raw, source, check)

    return guarded_read(spark, source, path, read)


def read_benefits_xml(spark: SparkSession, path: str, folder: str | None = None) -> Ingested:
    """Enrolment elements; a file with a broken element is left out as a whole.

    A rejected element keeps all its child tags. Where there are enrolments but no element has
    one of the required tags, the source is one reject and an empty frame (S11).
    """
    source = "benefits"
    fields = REQUIRED_COLUMNS[source]
    folder = folder or stage_folder(spark)

    def read() -> Ingested:
        found = read_elements(spark, path, "enrollment", folder, fields)
        failures = spark.createDataFrame([(f,) for f in found.broken], "filepath string").select(
            F.lit(source).alias("source_system"),
            F.lit("ParseError: malformed XML document").alias(REASON),
            F.to_json(F.struct("filepath")).alias(RAW),
        )
        record = F.col("record")
        has = [f"has_{f}" for f in fields]
        rows = found.rows.select(*(F.col(f"f_{f}").alias(f) for f in fields), F.col("_pos").alias(POSITION), "record", *has)
        lost = F.col("employee_id").isNull() | F.col("plan_type").isNull()
        why = "Malformed enrollment or missing employee_id/plan_type"
        marked = mark(rows, [(lost, why)], F.to_json(record, _WITH_NULLS))
        got = written(marked.drop("record"), source, folder, **{f: F.col(f"has_{f}") for f in fields})
        rejects = failures.unionByName(got.rejects)
        good = got.good.drop(*has)
        missing = sorted(f for f in fields if got.seen[f] is False)
        if not missing:
            return Ingested(align_employees(good, source), rejects, got.seen)
        tags = found.rows.select(F.explode(F.map_keys(record)).alias("tag")).distinct().collect()
        available = F.array(*(F.lit(r.tag) for r in tags)).cast("array<string>").alias("available_columns")
        failed = _source_failure(
            spark, source, f"Missing required columns: {missing}", F.struct(available), good
        )
        return Ingested(failed.frame, rejects.unionByName(failed.rejects), got.seen)

    return guarded_read(spark, source, path, read)


def ingest_employees(
    spark: SparkSession,
    paths: Mapping[str, str],
    rules: EmployeeRules,
    payroll_format: str = "parquet",
    folder: str | None = None,
) -> dict[str, Ingested]:
    """Every employee source by name, each parsed once."""
    folder = folder or stage_folder(spark)
    return {
        "globaltech_hris": read_hris_csv(spark, paths["globaltech_hris"], folder),
        "acquiredco_hris": read_hris_json(spark, paths["acquiredco_hris"], folder),
        "payroll": read_payroll(spark, paths["payroll"], rules, payroll_format, folder),
        "benefits": read_benefits_xml(spark, paths["benefits"], folder),
    }


TEST_ACCOUNT = "Test account"


def read_website(
    spark: SparkSession, path: str, rules: CustomerRules, folder: str | None = None
) -> Ingested:
    """Latin-1 customer CSV without its test accounts (S5, P6); over-long lines are rejected.

    Test accounts are no rejects; ``seen`` has their number.
    """
    folder = folder or stage_folder(spark)
    raw = _read_csv(spark, path, "ISO-8859-1", WEBSITE_NULL_TOKENS, folder)
    record = _raw_record(raw)
    cells = [c for c in raw.columns if c not in _BESIDE]
    beside = [c for c in raw.columns if c in _BESIDE]
    names = normalize_headers(cells)
    renamed = raw.select(*cells, *beside, record.alias("_record")).toDF(*names, *beside, "_record")
    renamed = renamed.withColumnsRenamed({"customeremail": "email", "optout": "opt_out"})
    is_test = F.col("email").rlike(rules.test_account_pattern)
    marked = mark(renamed, [*_too_long(renamed), (is_test, TEST_ACCOUNT)], F.col("_record"))
    marked = marked.withColumn("_test", F.col(REASON).eqNullSafe(TEST_ACCOUNT)).drop(_LINE, _TOO_LONG, "_record")
    got = written(marked, "website", folder, counts={"test_accounts": F.count_if("_test")})
    dated = got.good.withColumn("registration_date", iso_timestamp(F.col("registration_date")))
    frame = align_customers(dated.drop("_test").withColumn("source", F.lit("website")))
    return Ingested(frame, got.rejects.where(F.col(REASON) != TEST_ACCOUNT), got.seen)


def read_website_csv(spark: SparkSession, path: str, rules: CustomerRules) -> DataFrame:
    """The rows of ``read_website``."""
    return read_website(spark, path, rules).frame


def customer_elements(elements: DataFrame) -> DataFrame:
    """Customer JSON elements in the standard schema; flags become 0 or 1."""
    flat = flatten_json(
        elements.select(F.from_json("element", CRM_JSON_ELEMENT).alias("c"), POSITION).select(
            "c.*", POSITION
        )
    )
    ready = flat.withColumnsRenamed(
        {"profile_first_name": "first_name", "profile_last_name": "last_name"}
    ).withColumns(
        {
            "registration_date": iso_timestamp(F.col("registration_date")),
            "opt_out": F.col("opt_out").cast("int").cast("string"),
            "source": F.lit("crm"),
        }
    )
    return align_customers(ready)


def read_crm_json(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """Customer JSON export."""
    found = read_array(spark, path, "customers", "total_pages int", folder)
    return customer_elements(found.elements.select("element", _position()))


def pages_to_read(pages: DataFrame) -> DataFrame:
    """Pages (page, actual_records, total_pages) that a client would have fetched in turn.

    Reading stops before an empty page, and after a page whose successor is past the total
    it states (one page when it states none). The first stop is a single number.
    """
    is_empty = F.coalesce("actual_records", F.lit(0)) <= 0
    stated = F.coalesce("total_pages", F.lit(1)).cast("bigint")
    stops = F.when(is_empty, F.col("page")).when(F.col("page") + 1 > stated, F.col("page") + 1)
    # one row; without a stop all pages are read
    first = pages.agg(F.min(stops).alias("stop"))
    return pages.join(F.broadcast(first), F.col("stop").isNull() | (F.col("page") < F.col("stop"))).drop("stop")


def read_paged_json(
    spark: SparkSession, path: str, page_pattern: str = r"(\d+)\D*$", folder: str | None = None
) -> DataFrame:
    """Landed page files of a paged service (S8); the last number of the name is the page."""
    found = read_array(spark, path, "customers", "total_pages int", folder)
    page = F.regexp_extract(F.element_at(F.split("_file", "/"), -1), page_pattern, 1)
    kept = pages_to_read(found.docs.withColumn("page", page.cast("bigint"))).select("_file")
    # one row per page file
    return customer_elements(found.elements.join(kept, "_file").select("element", _position()))


def fixed_width(df: DataFrame, layout: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Character ranges of ``value`` as trimmed text columns, null texts as null."""
    cells = [
        null_tokens(strip(F.substring("value", start + 1, end - start)), NULL_TOKENS).alias(name)
        for name, start, end in layout
    ]
    rest = [c for c in df.columns if c != "value"]
    return df.where(strip(F.col("value")) != "").select(*cells, *rest)


def erp_customers(fields: DataFrame) -> DataFrame:
    """Fixed-width fields in the standard customer schema."""
    first, last = split_full_name(F.col("full_name"))
    return align_customers(
        fields.withColumns(
            {
                "first_name": first,
                "last_name": last,
                "region": F.col("region_code"),
                "registration_date": iso_timestamp(F.col("registration_date")),
                "source": F.lit("erp"),
            }
        )
    )


def read_erp_fixed_width(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select("value", _row_position())
    return erp_customers(fixed_width(lines, ERP_LAYOUT))


def ingest_customer_sources(
    spark: SparkSession, paths: Mapping[str, str], rules: CustomerRules, folder: str | None = None
) -> dict[str, Ingested]:
    """Every customer source by name, each parsed once."""
    folder = folder or stage_folder(spark)
    nothing = no_rejects(spark)
    return {
        "website": read_website(spark, paths["website"], rules, folder),
        "crm": Ingested(read_crm_json(spark, paths["crm"], folder), nothing),
        "erp": Ingested(read_erp_fixed_width(spark, paths["erp"]), nothing),
    }


def ingest_customers(
    spark: SparkSession, paths: Mapping[str, str], rules: CustomerRules
) -> DataFrame:
    """All customer sources in one frame."""
    return union_sources(got.frame for got in ingest_customer_sources(spark, paths, rules).values())


def read_golden(spark: SparkSession, path: str, company: str | None = None) -> DataFrame:
    """The golden table's last complete version, or its one partition of a company."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no complete golden table in {path}")
    golden = spark.read.parquet(f"{path}/{version[1]}")
    return golden if company is None else golden.where(F.col("company_origin") == company)
