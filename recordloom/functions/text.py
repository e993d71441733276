"""Text, name, contact and category normalisers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# every Unicode white space and the four ASCII separators, one by one
_BLANKS = (
    " \t\n\r\f\v\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# the wide range in front lets printable ASCII fail at once
SPACES = (
    r"[\x00-\x20\x7f-\uffff"
    r"&&[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]+"
)
# printable ASCII words with single blanks: already in normal form
_NORMAL = r"^[!-~]+( [!-~]+)*$"
# A letter that follows something which is neither a letter nor white space
_INNER_WORD = r"(?<=[^\p{L}\s])(?=\p{L})"
_MARK = "\u0001 "
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def sql_literal(value: object) -> str:
    """A constant in SQL text."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value}D" if isinstance(value, float) else str(value)


def lookup(key: Column, mapping: Mapping[str, object]) -> Column:
    """Value of ``key`` in a small constant map, null when absent."""
    entries = ", ".join(sql_literal(item) for pair in mapping.items() for item in pair)
    return F.element_at(F.expr(f"map({entries})"), key)


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(_BLANKS))


def is_blank(c: Column) -> Column:
    """True for null and for text of white space only."""
    return F.coalesce(strip(c.cast("string")), F.lit("")) == ""


def null_tokens(c: Column, tokens: Iterable[str]) -> Column:
    """Null where the whole cell is one of the reader's null texts."""
    return F.when(c.isin(*tokens), None).otherwise(c)


def _without(c: Column, *texts: str) -> Column:
    """Null instead of one of the texts; ``nullif`` evaluates ``c`` once."""
    for text in texts:
        c = F.nullif(c, F.lit(text))
    return c


def number_or_null(c: Column) -> Column:
    """Plain decimal text to double; anything else, ``1d`` and ``nan`` included, to null."""
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def normalize_text(c: Column) -> Column:
    """NFKC, one blank between words, no outer blanks, empty to null (F1).

    Most texts are in that form already and pass on one match. NFKC leaves ASCII alone, so
    only other rows pay for it; it is done inside the JVM by the Unicode library that ships
    with Spark, reached with the SQL function ``reflect``.
    """
    composed = F.reflect(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True)
    )
    text = F.when(c.rlike(r"[^\x00-\x7F]"), composed).otherwise(c)
    full = F.nullif(F.trim(F.regexp_replace(text, SPACES, " ")), F.lit(""))
    return F.when(c.rlike(_NORMAL), c).otherwise(full)


def title_case(c: Column) -> Column:
    """Capitalise after every non-letter: ``o'BRIEN`` to ``O'Brien``.

    ``initcap`` starts words at blanks only, so inner word starts get a marked blank first.
    """
    return F.replace(
        F.initcap(F.regexp_replace(c, _INNER_WORD, _MARK)), F.lit(_MARK), F.lit("")
    )


def person_name(c: Column) -> Column:
    """Employee name part: F1, then title case (F2)."""
    return title_case(normalize_text(c))


def customer_name(c: Column) -> Column:
    """Customer name part: collapse blanks, title case, null texts to null."""
    name = title_case(F.trim(F.regexp_replace(c, SPACES, " ")))
    return _without(name, "Nan", "None", "")


def full_name(first: Column, last: Column) -> Column:
    """``first last`` with nulls as nothing and single blanks."""
    both = F.concat_ws(" ", first, last)
    return F.trim(F.regexp_replace(both, SPACES, " "))


def split_full_name(c: Column) -> tuple[Column, Column]:
    """First word and the rest; the rest is null for one-word names."""
    parts = F.split(strip(c), SPACES, 2)
    return F.nullif(F.get(parts, F.lit(0)), F.lit("")), F.get(parts, F.lit(1))


def map_taxonomy(c: Column, mapping: Mapping[str, str]) -> Column:
    """Upper-cased normal form looked up in a code map, unknown to null."""
    return lookup(F.upper(normalize_text(c)), mapping)


def with_department(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Mapped department, the text it came from and a review flag."""
    if "department" not in df.columns:
        return df
    source = "department_original" if "department_original" in df.columns else "department"
    mapped = map_taxonomy(F.col(source), mapping)
    # mapped once, and read by the flag as a plain column
    return df.withColumns({"department_original": F.col(source), "department": mapped}).withColumn(
        "department_unmapped", F.expr("department_original IS NOT NULL AND department IS NULL")
    )


def email_key(c: Column) -> Column:
    """Comparison form of an e-mail address."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


def squeezed(c: Column) -> Column:
    """Lower case without any white space."""
    return F.regexp_replace(F.lower(c), SPACES, "")


def customer_email(c: Column) -> Column:
    """Lower case without any white space, null texts to null."""
    return _without(squeezed(c), "nan", "none", "")


def matches(c: Column, pattern: str) -> Column:
    """Pattern matched from the start of the text; null counts as no match."""
    return F.coalesce(c.rlike(f"^(?:{pattern})"), F.lit(False))


def phone_digits(c: Column) -> Column:
    """Digits with an optional leading plus; fewer than seven digits to null (F16)."""
    digits = F.regexp_replace(c, r"[^0-9]", "")
    signed = F.when(strip(c).startswith("+"), F.concat(F.lit("+"), digits)).otherwise(digits)
    return F.when(F.length(digits) >= 7, signed)


def region_code(c: Column, mapping: Mapping[str, str]) -> Column:
    """Region text to its code, unknown to null."""
    return lookup(F.lower(strip(c)), mapping)


def opt_out_flag(c: Column) -> Column:
    """Non-zero number is true; null and any other text is false."""
    return F.coalesce(number_or_null(c) != 0, F.lit(False))


def has_currency_symbol(c: Column) -> Column:
    """Text with a dollar, pound or euro sign."""
    return F.coalesce(c.rlike("[$£€]"), F.lit(False))
