"""Profile tables: counts, distributions, rates and run summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.config import DATE_COLUMNS, POSITION, EmployeeRules
from recordloom.functions.dates import tenure_days
from recordloom.functions.money import clip_upper, two_places
from recordloom.functions.text import matches
from recordloom.operators.quantiles import exact_quantiles, value_counts_of
from recordloom.sources.align import union_sources

UNKNOWN = "(Unknown)"


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    """Rows per value of a column."""
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias("records"))


def _or_unknown(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(UNKNOWN)).alias(column)


def headcount_by_department(employees: DataFrame) -> DataFrame:
    """Smallest department first."""
    counts = employees.groupBy(_or_unknown("department")).agg(F.count("*").alias("employees"))
    return counts.orderBy("employees", "department")


def headcount_by_country(employees: DataFrame, top: int = 15) -> DataFrame:
    """The largest countries."""
    counts = employees.groupBy(_or_unknown("country")).agg(F.count("*").alias("employees"))
    return counts.orderBy(F.desc("employees"), "country").limit(top)


def salary_distribution(employees: DataFrame, rules: EmployeeRules) -> DataFrame:
    """Box of capped salaries per employment type.

    Quartiles are exact; a whisker is the outermost salary within 1.5 box heights.
    """
    capped = employees.select(
        _or_unknown("employment_type"),
        clip_upper(F.col("salary_usd_annual"), rules.salary_range[1]).alias("salary"),
    )
    counts = value_counts_of(capped, "employment_type", "salary")
    quartiles = exact_quantiles(counts, "employment_type", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    boxes = counts.join(quartiles, "employment_type").groupBy("employment_type").agg(
        F.sum("copies").alias("records"),
        *(F.first(q).alias(q) for q in ("q1", "median", "q3")),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
    )
    shown = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return in_label_order(
        boxes.withColumns({c: two_places(F.col(c)) for c in shown}),
        "employment_type",
        rules.valid_employment_types,
    )


def in_label_order(df: DataFrame, column: str, configured: Sequence[str]) -> DataFrame:
    """Configured labels first, in their order, then the others by name."""
    place = F.array_position(F.array(*(F.lit(v) for v in configured)), F.col(column))
    return df.orderBy(F.nullif(place, F.lit(0)).asc_nulls_last(), column)


def _tenure_counts(employees: DataFrame, as_of: dt.date) -> DataFrame:
    days = employees.select(tenure_days(F.col("hire_date"), as_of).alias("days"))
    return (
        days.where(F.col("days").isNotNull())
        .groupBy("days")
        .agg(F.count("*").alias("copies"))
        .withColumn("years", F.col("days") / F.lit(365.25))
    )


def tenure_histogram(employees: DataFrame, as_of: dt.date, bins: int = 20) -> DataFrame:
    """Equal-width bins between the shortest and longest tenure, empty ones too (A10).

    Rows are first counted per day of tenure, which leaves some ten thousand rows at most.
    """
    counts = _tenure_counts(employees, as_of)
    ends = counts.agg(F.min("years").alias("low"), F.max("years").alias("high")).where(
        F.col("low").isNotNull()
    )
    # one tenure only: a bin range of half a year on either side
    flat = F.col("low") == F.col("high")
    spread = ends.select(
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    grid = spread.select(
        "low", "high", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    ranged = counts.withColumns(
        {c: spread.select(c).scalar() for c in ("low", "high")}
    )
    place = F.least(
        F.floor((F.col("years") - F.col("low")) * bins / (F.col("high") - F.col("low"))),
        F.lit(bins - 1),
    ).cast("int")
    filled = ranged.groupBy(place.alias("bin")).agg(F.sum("copies").alias("employees"))
    width = (F.col("high") - F.col("low")) / bins
    return (
        grid.join(filled, "bin", "left")
        .select(
            "bin",
            two_places(F.col("low") + width * F.col("bin")).alias("from_years"),
            two_places(F.col("low") + width * (F.col("bin") + 1)).alias("to_years"),
            F.coalesce("employees", F.lit(0)).alias("employees"),
        )
        .orderBy("bin")
    )


def tenure_median(employees: DataFrame, as_of: dt.date) -> DataFrame:
    """One row: the median tenure in years (A10)."""
    counts = _tenure_counts(employees, as_of).select(
        F.lit(1).alias("all"), F.col("years").alias("value"), "copies"
    )
    return exact_quantiles(counts, "all", {"median_years": 0.5}).select(
        two_places(F.col("median_years")).alias("median_years")
    )


def enrolment_rate_by_department(employees: DataFrame) -> DataFrame:
    """Share of enrolled employees in percent, highest first."""
    enrolled = F.when(F.coalesce("benefits_enrolled", F.lit(False)), 1.0).otherwise(0.0)
    rates = employees.groupBy(_or_unknown("department")).agg(
        two_places(F.avg(enrolled) * 100).alias("enrolment_rate")
    )
    return rates.orderBy(F.desc("enrolment_rate"), "department")


def check_outcomes(report: DataFrame) -> DataFrame:
    """Passed and failed rows of every check."""
    return report.select("check", "passed", "failed")


def monthly_registrations(customers: DataFrame) -> DataFrame:
    """Registrations per month end, months without any included."""
    month = F.last_day(F.col("registration_date").cast("date"))
    counts = (
        customers.where(F.col("registration_date").isNotNull())
        .groupBy(month.alias("month_end"))
        .agg(F.count("*").alias("registrations"))
    )
    first_day = lambda c: F.trunc(c, "month")
    months = (
        counts.agg(F.min("month_end").alias("low"), F.max("month_end").alias("high"))
        .where(F.col("low").isNotNull())
        .select(
            F.explode(
                F.sequence(first_day(F.col("low")), first_day(F.col("high")), F.expr("interval 1 month"))
            ).alias("start")
        )
        .select(F.last_day("start").alias("month_end"))
    )
    return (
        months.join(counts, "month_end", "left")
        .select("month_end", F.coalesce("registrations", F.lit(0)).alias("registrations"))
        .orderBy("month_end")
    )


def contribution_by_source(customers: DataFrame) -> DataFrame:
    """Customers that each source contributed to."""
    if "sources" in customers.columns:
        sources = customers.select(F.explode(F.split("sources", ",")).alias("source"))
    else:
        sources = customers.select("source").where(F.col("source").isNotNull())
    return (
        sources.groupBy("source")
        .agg(F.count("*").alias("customers"))
        .orderBy(F.desc("customers"), "source")
    )


def field_completeness(
    customers: DataFrame,
    fields: Sequence[str] = ("email", "first_name", "last_name", "phone", "region"),
) -> DataFrame:
    """Share of non-null values of each field, lowest first."""
    shares = customers.agg(
        *(F.avg(F.col(f).isNotNull().cast("int")).alias(f) for f in fields)
    )
    lines = [F.struct(F.lit(f).alias("field"), F.col(f).alias("share")) for f in fields]
    long = shares.select(F.inline(F.array(*lines)))
    return long.select(
        "field", (F.rint(F.col("share") * 10000) / 10000).alias("completeness")
    ).orderBy("completeness", "field")


def email_validity(customers: DataFrame) -> DataFrame:
    """Customers with and without a valid address."""
    valid = F.coalesce("email_valid", F.lit(False))
    counts = customers.agg(F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid"))
    return counts.select(
        F.inline(
            F.array(
                F.struct(F.lit("Valid").alias("validity"), F.col("valid").alias("customers")),
                F.struct(F.lit("Invalid").alias("validity"), F.col("invalid").alias("customers")),
            )
        )
    )


def opt_out_rate_by_region(customers: DataFrame) -> DataFrame:
    """Share of opted-out customers per known region, lowest first."""
    rates = (
        customers.where(F.col("region").isNotNull())
        .groupBy("region")
        .agg(F.avg(F.col("opt_out").cast("int")).alias("rate"))
    )
    return rates.select(
        "region", (F.rint(F.col("rate") * 10000) / 10000).alias("opt_out_rate")
    ).orderBy("opt_out_rate", "region")


def salary_statistics(payroll: DataFrame) -> DataFrame:
    """Yearly salary statistics per currency and pay frequency."""
    keyed = payroll.where(
        F.col("currency").isNotNull() & F.col("pay_frequency").isNotNull()
    ).withColumn("pair", F.struct("currency", "pay_frequency"))
    counts = value_counts_of(keyed, "pair", "salary_usd_annual")
    medians = exact_quantiles(counts, "pair", {"median": 0.5})
    salary = F.col("salary_usd_annual")
    plain = keyed.groupBy("pair").agg(
        F.count(salary).alias("records"),
        F.min(salary).alias("minimum"),
        F.avg(salary).alias("mean"),
        F.max(salary).alias("maximum"),
    )
    stats = ("minimum", "median", "mean", "maximum")
    return plain.join(medians, "pair", "left").select(
        "pair.currency",
        "pair.pay_frequency",
        "records",
        *(two_places(F.col(c)).alias(c) for c in stats),
    )


def ingestion_summary(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns, correct tags and companies of every source."""
    lines = []
    for source, df in frames.items():
        width = len([c for c in df.columns if c != POSITION])
        # companies are gathered from per-company counts
        per_company = df.groupBy("company_origin").agg(
            F.count("*").alias("records"),
            F.count_if(F.col("source_system") == source).alias("tagged"),
        )
        companies = F.array_join(F.sort_array(F.collect_set("company_origin")), ", ")
        lines.append(
            per_company.agg(
                F.lit(source).alias("source_system"),
                F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
                F.lit(width).cast("bigint").alias("columns"),
                F.coalesce(F.sum("tagged"), F.lit(0)).alias("tagged_correctly"),
                companies.alias("company_origins"),
            )
        )
    return union_sources(lines)


def date_summary(cleaned: Mapping[str, DataFrame]) -> DataFrame:
    """Parsed and invalid dates with their range, per source and date column."""
    lines = []
    for source, df in cleaned.items():
        aggs = []
        for c in DATE_COLUMNS:
            aggs += [
                F.count(c).alias(f"{c}_parsed"),
                F.count_if(F.col(f"{c}_invalid")).alias(f"{c}_bad"),
                F.min(c).alias(f"{c}_min"),
                F.max(c).alias(f"{c}_max"),
            ]
        entries = [
            F.struct(
                F.lit(source).alias("source_system"),
                F.lit(c).alias("column"),
                F.col(f"{c}_parsed").alias("parsed"),
                F.col(f"{c}_bad").alias("invalid"),
                F.col(f"{c}_min").alias("minimum"),
                F.col(f"{c}_max").alias("maximum"),
            )
            for c in DATE_COLUMNS
        ]
        lines.append(df.agg(*aggs).select(F.inline(F.array(*entries))))
    return union_sources(lines).where(F.col("parsed") > 0)


def stage_summary(
    raw: Mapping[str, DataFrame], cleaned: Mapping[str, DataFrame], rules: EmployeeRules
) -> DataFrame:
    """Rows before and after cleaning and what cleaning derived, per source."""
    lines = []
    for source, df in cleaned.items():
        flags = [c for c in df.columns if c.endswith("_date_invalid")]
        invalid = sum((F.count_if(F.col(c)) for c in flags), F.lit(0).cast("bigint"))
        after = df.agg(
            F.count("*").alias("cleaned_records"),
            F.count_if(matches(F.col("employee_id"), rules.id_pattern)).alias(
                "canonical_employee_ids"
            ),
            F.count("salary_usd_annual").alias("annual_usd_salaries"),
            invalid.alias("invalid_dates"),
        ).withColumn("source_system", F.lit(source))
        before = raw[source].agg(F.count("*").alias("ingested_records")).withColumn(
            "source_system", F.lit(source)
        )
        # two one-row frames
        lines.append(before.join(after, "source_system"))
    return union_sources(lines)


def match_summary(input_rows: DataFrame, employees: DataFrame) -> DataFrame:
    """Rows into and out of the exact-id pass, by outcome."""
    has = lambda source: F.coalesce(F.col("source_systems").contains(source), F.lit(False))
    method = F.col("dedup_method")
    after = employees.agg(
        F.count("*").alias("pass1_employees"),
        F.count_if(method == "exact_id").alias("exact_id_merges"),
        F.count_if(method == "single_source").alias("single_source"),
        F.count_if(has("payroll")).alias("with_payroll"),
        F.count_if(has("benefits")).alias("with_benefits"),
    )
    before = input_rows.agg(F.count("*").alias("input_hris_rows"))
    long = lambda df: df.select(
        F.inline(
            F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in df.columns))
        )
    )
    return long(before).unionByName(long(after))


def dead_letter_summary(dead_letters: DataFrame) -> DataFrame:
    """Recorded failures per source and the reason of the latest."""
    latest = F.max(F.struct("rejected_at_utc", "reason"))["reason"]
    return dead_letters.groupBy("source_system").agg(
        F.count("*").alias("recorded_failures"), latest.alias("latest_reason")
    )


def run_summary(
    sources: Mapping[str, DataFrame], results: Mapping[str, DataFrame], methods: DataFrame | None = None
) -> DataFrame:
    """Row counts of the sources and results of a run, and rows per method."""
    one = lambda name, df: df.agg(F.count("*").alias("value")).select(
        F.lit(name).alias("metric"), "value"
    )
    lines = [one(n, df) for n, df in {**sources, **results}.items()]
    if methods is not None:
        lines.append(
            value_counts(methods, "dedup_method").select(
                F.concat(F.lit("method:"), "dedup_method").alias("metric"),
                F.col("records").alias("value"),
            )
        )
    return union_sources(lines)


def column_profile(
    df: DataFrame,
    descriptions: Mapping[str, str],
    key: str,
    default: str = "Derived or source field kept on the golden record",
) -> DataFrame:
    """Name, type, description and an example of every column.

    The example is the value of the smallest ``key`` that has one; long texts are cut.
    """
    pairs = [
        F.min(
            F.when(F.col(c).isNotNull(), F.struct(F.col(key).alias("k"), F.col(c).alias("v")))
        )["v"].alias(c)
        for c in df.columns
    ]
    kinds = dict(df.dtypes)

    def example(c: str) -> Column:
        if kinds[c].startswith("timestamp"):
            return F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss")
        text = F.col(c).cast("string")
        return F.when(F.length(text) > 80, F.concat(F.left(text, F.lit(77)), F.lit("..."))).otherwise(text)

    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(kinds[c]).alias("data_type"),
            F.lit(descriptions.get(c, default)).alias("description"),
            F.coalesce(example(c), F.lit("")).alias("example_value"),
        )
        for c in df.columns
    ]
    return df.agg(*pairs).select(F.inline(F.array(*lines)))
