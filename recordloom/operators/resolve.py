"""Identity resolution: collapse, enrich, ghosts and merges.

Groups of any size are reduced with aggregates that combine inside each task before the
shuffle, so one hot key costs one small row per task. No operator here sorts or collects
the rows of a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.config import (
    BENEFIT_FIELDS,
    PAYROLL_FIELDS,
    POSITION,
    CustomerRules,
    EmployeeRules,
)
from recordloom.functions.dates import epoch_micros
from recordloom.functions.identity import duplicate_rank, provenance, source_priority
from recordloom.functions.text import email_key, full_name, opt_out_flag, strip
from recordloom.operators.skew import grid_join

_SALTS = 16
_ROWS_PER_TASK = 1_000_000  # of one address
#: bytes of one employee's list of plans or levels
LONGEST_LIST = 1 << 30


def nulls_last(c: Column) -> list[Column]:
    """Ascending order keys for a struct, null after every value."""
    return [c.isNull(), c]


def latest_first(c: Column) -> list[Column]:
    """Descending order keys of a zone-free timestamp for a struct, null last."""
    return [c.isNull(), -epoch_micros(c)]


_ORDER = "_order"


def with_order(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The order keys of every row as one struct, worked out once per row."""
    return df.withColumn(_ORDER, F.struct(*(k.alias(f"k{i}") for i, k in enumerate(order))))


def first_non_null(name: str) -> Column:
    """First value of a column that is not null, in the order of ``with_order``.

    The smallest ``(order, value)`` pair is a plain minimum, so it is combined before the
    shuffle; the value itself settles what the order leaves open.
    """
    pair = f"CASE WHEN `{name}` IS NOT NULL THEN struct({_ORDER}, `{name}` AS value) END"
    return F.expr(f"min({pair}).value AS `{name}`")


def _file_order(df: DataFrame) -> list[Column]:
    return [F.col(POSITION)] if POSITION in df.columns else []


def aggregate_payroll(payroll: DataFrame, rules: EmployeeRules) -> DataFrame:
    """One profile per employee, the latest known value of every field (A1)."""
    order = [
        *latest_first(F.col("payroll_effective_date")),
        source_priority(F.col("source_system"), rules.source_priority),
        *_file_order(payroll),
    ]
    wanted = [c for c in ("company_origin", *PAYROLL_FIELDS) if c in payroll.columns]
    return (
        with_order(payroll.where(F.col("employee_id").isNotNull()), order)
        .groupBy("employee_id")
        .agg(*map(first_non_null, wanted))
        .withColumn("source_system", F.lit("payroll"))
    )


def aggregate_benefits(benefits: DataFrame) -> DataFrame:
    """One benefits profile per employee, lists in enrolment order (A2).

    Equal enrolments are counted first, spread over all their columns, and only the counts
    come together per employee. The company is one of the columns because the counts then
    have fixed-width buffers, which hash aggregation needs. The list state is therefore the number of different
    (date, plan, level) triples, not the number of rows; the copies come back when the text
    is put together. Plans on one day are ordered by plan, then level. A list of more than
    ``LONGEST_LIST`` bytes stops the job with the employee's id.
    """
    label = lambda c: F.coalesce(F.nullif(strip(F.col(c).cast("string")), F.lit("")), F.lit("N/A"))
    date = F.col("benefit_enrollment_date")
    counted = (
        benefits.where(F.col("employee_id").isNotNull())
        .groupBy(
            "employee_id",
            "company_origin",
            date.alias("date"),
            label("benefit_plans").alias("plan"),
            label("benefit_coverage_level").alias("level"),
        )
        .agg(
            F.count("*").alias("copies"),
            F.count("benefit_plans").alias("plans"),
            F.max("benefits_enrolled").alias("enrolled"),
            F.sum("premium_employee").alias("premium_employee"),
            F.sum("premium_employer").alias("premium_employer"),
        )
    )
    entry = F.struct(F.col("date").isNull().alias("undated"), "date", "plan", "level", "copies")
    ordered = F.sort_array(F.collect_list(entry))

    def joined(part: str) -> Column:
        of_one = lambda e: (F.octet_length(e[part]) + 1).cast("bigint") * e["copies"]
        size = F.aggregate("entries", F.lit(0).cast("bigint"), lambda n, e: n + of_one(e))
        repeated = F.transform(
            "entries", lambda e: F.repeat(F.concat(e[part], F.lit(",")), e["copies"].try_cast("int"))
        )
        too_long = F.concat(
            F.lit("the enrolment list of employee "), "employee_id", F.lit(" would have "),
            size.cast("string"), F.lit(f" bytes, more than {LONGEST_LIST}"),
        )
        text = F.regexp_replace(F.array_join(repeated, ""), ",$", "")
        return F.when(size > LONGEST_LIST, F.raise_error(too_long)).otherwise(text)

    return (
        counted.groupBy("employee_id")
        .agg(
            F.min("company_origin").alias("company_origin"),
            F.max("enrolled").alias("enrolled"),
            ordered.alias("entries"),
            F.sum("plans").alias("benefit_plan_count"),
            F.min("date").alias("benefit_enrollment_date"),
            F.sum("premium_employee").cast("decimal(18,2)").alias("premium_employee"),
            F.sum("premium_employer").cast("decimal(18,2)").alias("premium_employer"),
        )
        .select(
            "employee_id",
            "company_origin",
            F.lit("benefits").alias("source_system"),
            F.coalesce("enrolled", F.lit(False)).alias("benefits_enrolled"),
            joined("plan").alias("benefit_plans"),
            "benefit_plan_count",
            joined("level").alias("benefit_coverage_level"),
            "benefit_enrollment_date",
            F.coalesce("premium_employee", F.lit(0)).cast("decimal(18,2)").alias("premium_employee"),
            F.coalesce("premium_employer", F.lit(0)).cast("decimal(18,2)").alias("premium_employer"),
        )
    )


def collapse_by_id(hris: DataFrame, rules: EmployeeRules) -> DataFrame:
    """One row per employee id; plain ids win over marked duplicates.

    ``source_systems`` is the surviving source; the method tells whether rows were merged.
    """
    raw = [duplicate_rank(F.col("employee_id_raw"))] if "employee_id_raw" in hris.columns else []
    order = [
        source_priority(F.col("source_system"), rules.source_priority),
        *raw,
        # within one rank the configured company order, then file order
        *([company_rank(rules)] if "company_origin" in hris.columns else []),
        *_file_order(hris),
    ]
    values = [c for c in hris.columns if c not in ("employee_id", POSITION)]
    merged = F.when(F.count("*") > 1, "exact_id").otherwise("single_source")
    return (
        with_order(hris.where(F.col("employee_id").isNotNull()), order)
        .groupBy("employee_id")
        .agg(*map(first_non_null, values), merged.alias("dedup_method"))
        .withColumn("source_systems", F.col("source_system"))
    )


def company_rank(rules: EmployeeRules) -> Column:
    """Place of the company in the configured order; others after them."""
    known = F.array(*(F.lit(c) for c in rules.companies))
    place = F.array_position(known, F.col("company_origin"))
    return F.coalesce(F.nullif(place, F.lit(0)), F.lit(len(rules.companies) + 1))


def _enrich(
    spine: DataFrame, profile: DataFrame, fields: Iterable[str], marker: str
) -> DataFrame:
    """Left join of one-row-per-id fields that also tells which rows matched."""
    fields = [f for f in fields if f in profile.columns]
    right = profile.select("employee_id", *fields, F.lit(True).alias(marker))
    return spine.drop(*fields).join(right, "employee_id", "left")


def match_exact_ids(
    hris: DataFrame, payroll: DataFrame, benefits: DataFrame, rules: EmployeeRules
) -> DataFrame:
    """Employees from the HR systems, enriched by payroll and benefits.

    All three inputs are reduced to one row per id first; the joins then reuse that
    partitioning.
    """
    spine = collapse_by_id(hris, rules)
    paid = _enrich(spine, aggregate_payroll(payroll, rules), PAYROLL_FIELDS, "_in_payroll")
    both = _enrich(paid, aggregate_benefits(benefits), BENEFIT_FIELDS, "_in_benefits")
    sources = F.array(
        F.col("source_systems"),
        F.when(F.col("_in_payroll"), F.lit("payroll")),
        F.when(F.col("_in_benefits"), F.lit("benefits")),
    )
    matched = F.coalesce("_in_payroll", "_in_benefits", F.lit(False))
    return both.withColumns(
        {
            "source_systems": provenance(sources, rules.source_priority),
            "dedup_method": F.when(matched, F.lit("exact_id")).otherwise(F.col("dedup_method")),
            "benefits_enrolled": F.coalesce("benefits_enrolled", F.lit(False)),
            "benefit_plan_count": F.coalesce("benefit_plan_count", F.lit(0).cast("bigint")),
        }
    ).drop("_in_payroll", "_in_benefits")


def detect_ghosts(payroll: DataFrame, employee_ids: DataFrame) -> DataFrame:
    """Payroll ids that no HR system knows, latest values first.

    Payroll is reduced to one row per id before the anti join: the join then moves one row
    per id however often an id is paid. ``employee_ids`` needs one column, ``employee_id``.
    """
    order = [*latest_first(F.col("payroll_effective_date")), *_file_order(payroll)]
    wanted = ("first_name", "last_name", "salary_usd_annual", "company_origin")
    present = [c for c in wanted if c in payroll.columns]
    latest = (
        with_order(payroll.where(F.col("employee_id").isNotNull()), order)
        .groupBy("employee_id")
        .agg(*map(first_non_null, present))
    )
    name_parts = [F.col(c) if c in present else F.lit(None) for c in wanted[:2]]
    return latest.join(employee_ids.select("employee_id"), "employee_id", "left_anti").select(
        F.col("employee_id").alias("payroll_employee_id"),
        F.nullif(full_name(*(c.cast("string") for c in name_parts)), F.lit("")).alias("name"),
        "salary_usd_annual",
        F.lit("Payroll employee_id has no matching HRIS record").alias("ghost_flag_reason"),
        F.lit(True).alias("ghost_employee"),
        "company_origin",
        F.lit("payroll").alias("source_system"),
    )


def _salted(df: DataFrame, by: str) -> DataFrame:
    return df.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(_SALTS)).cast("int"))


def merge_by_email(
    employees: DataFrame, rules: EmployeeRules, addresses: DataFrame | None = None
) -> DataFrame:
    """Merge rows that share an e-mail address across companies.

    Every row with such an address is merged, also several of one company. The addresses
    come from a per-address minimum and maximum. Rows look their address up under a salt,
    so that a common address is spread over tasks, and rows without an address use their
    own id as a key that finds nothing, so that they do not pile up either.

    ``addresses`` may give id, company and e-mail of the same employees from a plan that is
    cheaper than ``employees``.
    """
    key = email_key(F.col("email"))
    crossing = (
        (employees if addresses is None else addresses)
        .where(key.isNotNull())
        .groupBy(key.alias("_key"))
        .agg(
            F.min("company_origin").alias("low"),
            F.max("company_origin").alias("high"),
            F.count("employee_id").alias("ids"),
        )
        .where((F.col("low") != F.col("high")) & (F.col("ids") > 1))
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    salted_keys = crossing.select("_key", salts.alias("_salt"), F.lit(True).alias("_crossing"))
    own_key = F.concat(F.lit("\u0000"), F.coalesce("employee_id", F.lit("")))
    keyed = _salted(employees.withColumn("_key", F.coalesce(key, own_key)), "employee_id")
    flagged = keyed.join(salted_keys, ["_key", "_salt"], "left")

    order = [
        source_priority(F.col("source_system"), rules.source_priority),
        *nulls_last(F.col("company_origin")),
        F.col("employee_id"),
    ]
    values = [c for c in employees.columns if c not in ("source_systems", "dedup_method")]
    parts = F.split(F.coalesce("source_systems", "source_system"), ",")
    merged = (
        with_order(flagged.where(F.col("_crossing")), order)
        .groupBy("_key")
        .agg(
            *map(first_non_null, values),
            F.flatten(F.collect_set(parts)).alias("_sources"),
        )
        .withColumns(
            {
                "source_systems": provenance(F.col("_sources"), rules.source_priority),
                "dedup_method": F.lit("email_match"),
            }
        )
    )
    untouched = flagged.where(F.col("_crossing").isNull())
    return untouched.select(*employees.columns).unionByName(merged.select(*employees.columns))


def consumed_ids(employees: DataFrame, rules: EmployeeRules) -> DataFrame:
    """(consumed_id, surviving_id) of the e-mail merge, from the rows before it.

    Every id of a merged address but the one that its row keeps is consumed. An address that
    many rows share is looked up by as many tasks as its rows need.
    """
    rows = employees.select(
        email_key(F.col("email")).alias("_key"), "employee_id", "company_origin", "source_system"
    ).where(F.col("_key").isNotNull() & F.col("employee_id").isNotNull())
    order = F.struct(
        source_priority(F.col("source_system"), rules.source_priority).alias("p"),
        F.col("company_origin").isNull().alias("n"),
        F.col("company_origin").alias("c"),
        F.col("employee_id").alias("id"),
    )
    survivors = (
        rows.groupBy("_key")
        .agg(
            F.min("company_origin").alias("low"),
            F.max("company_origin").alias("high"),
            F.min(order)["id"].alias("surviving_id"),
        )
        .where(F.col("low") != F.col("high"))
        .select("_key", "surviving_id")
    )
    met = grid_join(rows.select("_key", "employee_id"), survivors, "_key", _ROWS_PER_TASK)
    return (
        met.where(F.col("employee_id") != F.col("surviving_id"))
        .select(F.col("employee_id").alias("consumed_id"), "surviving_id")
        .distinct()
    )


def dangling_references(
    df: DataFrame, foreign: str, primary: str, aliases: DataFrame | None = None
) -> DataFrame:
    """One row: non-null foreign keys and how many of them have no primary key.

    References are counted per value before the join, so a value that a third of the rows
    share is one row there. The ``consumed_id`` of ``aliases`` are known keys too.
    """
    counted = (
        df.where(F.col(foreign).isNotNull())
        .groupBy(F.col(foreign).cast("string").alias("_key"))
        .agg(F.count("*").alias("_rows"))
    )
    keys = df.where(F.col(primary).isNotNull()).select(F.col(primary).cast("string").alias("_key"))
    if aliases is not None:
        keys = keys.unionByName(aliases.select(F.col("consumed_id").alias("_key")))
    known = keys.distinct().withColumn("_known", F.lit(True))
    joined = counted.join(known, "_key", "left")
    return joined.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_rows"))), F.lit(0)).alias("failed"),
    )


# columns that a merged customer fills from other records of the same address
_FILLED = ("first_name", "last_name", "phone", "region", "registration_date")


def merge_customers(customers: DataFrame, rules: CustomerRules) -> DataFrame:
    """One row per valid address, best source first; other rows pass through (A5).

    Opting out anywhere counts everywhere. Columns outside the filled ones come from the
    best record alone, as one struct.
    """
    ranked = customers.withColumns(
        {
            "source_priority": source_priority(F.col("source"), rules.source_priority),
            "opt_out": opt_out_flag(F.col("opt_out")),
        }
    )
    special = ("email", "opt_out", *_FILLED, POSITION)
    from_best = [c for c in ranked.columns if c not in special]
    # file order settles ties within a source; without it the rows' own values do
    ties = _file_order(customers) or [F.col(c) for c in (*_FILLED, *from_best)]
    order = [F.col("source_priority"), F.col("source"), *ties]
    best = F.min(F.struct(_ORDER, F.struct(*from_best).alias("row")))["row"]
    by_rank = F.sort_array(F.collect_set(F.struct("source_priority", "source")))
    merged = (
        with_order(ranked.where(F.col("email_valid")), order)
        .groupBy("email")
        .agg(
            best.alias("_best"),
            *map(first_non_null, _FILLED),
            F.max("opt_out").alias("opt_out"),
            by_rank.alias("_sources"),
        )
        .select(
            "email",
            *_FILLED,
            "opt_out",
            "_best.*",
            F.array_join(F.col("_sources.source"), ",").alias("sources"),
            F.size("_sources").cast("bigint").alias("source_count"),
        )
    )
    kept = [c for c in ranked.columns if c != POSITION]
    invalid = ranked.where(~F.col("email_valid")).select(*kept)
    return merged.select(*kept, "sources", "source_count").unionByName(
        invalid, allowMissingColumns=True
    )


def employee_ids(employees: DataFrame) -> DataFrame:
    return employees.where(F.col("employee_id").isNotNull()).select("employee_id")


def multi_source(df: DataFrame) -> DataFrame:
    """Rows that more than one source contributed to."""
    return df.where(F.size(F.split("source_systems", ",")) > 1)


def source_frames(frames: Mapping[str, DataFrame]) -> None:
    """Raise when a source that resolution needs is absent (U4)."""
    needed = {"globaltech_hris", "acquiredco_hris", "payroll", "benefits"}
    missing = sorted(needed - set(frames))
    if missing:
        raise KeyError(f"Missing cleaned source frame(s): {missing}")
