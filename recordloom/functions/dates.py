"""Date parsing, flags and tenure."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.config import DATE_COLUMNS
from recordloom.functions.text import normalize_text

# Accepted date formats besides the ISO-8601 ones, and what they look like
DATE_FORMATS = {
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "d-MMM-yyyy": r"^\d{1,2}-[A-Za-z]{3}-\d{4}$",
}

_ISO_START = r"^\d{4}-\d{2}-\d{2}"
_ISO_ZONE = r"^\d{4}-\d{2}-\d{2}[T ].*(Z|[+-]\d{2}:?\d{2})$"


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 text to a zone-free UTC timestamp, anything else to null."""
    text = c.cast("string")
    zoned = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz")
    )
    return F.when(text.rlike(_ISO_ZONE), zoned).when(
        text.rlike(_ISO_START), text.try_cast("timestamp_ntz")
    )


def first_format(text: Column) -> Column:
    """Normalised text by the accepted format it looks like, else ISO-8601, else null.

    The shapes exclude each other. Looking first spares the failed parses, each of which
    costs an exception, that trying one format after the other would mean.
    """
    parsed = iso_timestamp(text)
    for pattern, shape in DATE_FORMATS.items():
        stamp = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
        parsed = F.when(text.rlike(shape), stamp).otherwise(parsed)
    return parsed


def mixed_timestamp(c: Column) -> Column:
    """Date text in any accepted form to a zone-free UTC timestamp, else null."""
    return first_format(normalize_text(c.cast("string")))


def midnight(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def with_dates(
    df: DataFrame,
    as_of: dt.date,
    earliest: str,
    columns: Sequence[str] = DATE_COLUMNS,
) -> DataFrame:
    """Parse date columns and add ``<column>_invalid``.

    Unparsable text and dates before ``earliest`` or after the start of ``as_of`` are
    flagged; a date out of range is kept for review. Each step reads the one before as
    plain columns, so a text is normalised once and not once per format.
    """
    present = [name for name in columns if name in df.columns]
    if not present:
        return df
    texts = df.withColumns({f"_text_{n}": normalize_text(F.col(n).cast("string")) for n in present})
    parsed = texts.withColumns({f"_date_{n}": first_format(F.col(f"_text_{n}")) for n in present})
    low, high = (f"CAST('{day}' AS TIMESTAMP_NTZ)" for day in (earliest, as_of.isoformat()))
    flag = "({n} IS NOT NULL AND {d} IS NULL) OR coalesce({d} < {low} OR {d} > {high}, false)"
    flags = {
        f"{n}_invalid": F.expr(flag.format(n=f"`{n}`", d=f"`_date_{n}`", low=low, high=high))
        for n in present
    }
    return (
        parsed.withColumns(flags)
        .withColumns({n: F.col(f"_date_{n}") for n in present})
        .drop(*(f"_{kind}_{n}" for n in present for kind in ("text", "date")))
    )


def epoch_micros(c: Column) -> Column:
    """Microseconds since 1970 on a clock without zones or summer time."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz"))


def tenure_days(date: Column, as_of: dt.date) -> Column:
    """Whole 24-hour periods up to the start of ``as_of``, never below zero."""
    days = F.timestamp_diff("DAY", date, midnight(as_of))
    # a part of a day before zero still floors to a negative number, which is cut to zero
    return F.when(date.isNotNull(), F.greatest(days, F.lit(0).cast("bigint")))


def tenure_years(date: Column, as_of: dt.date) -> Column:
    """Tenure in years of 365.25 days."""
    return tenure_days(date, as_of) / F.lit(365.25)
