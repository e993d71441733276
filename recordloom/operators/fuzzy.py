"""Probable same-person pairs by name similarity and hire-date distance.

Two rows pair when their hire dates are at most a number of whole days apart, their
companies and ids differ, and their token-sorted names score at least a threshold. The
plan keeps the work close to the size of the result:

1. Rows with one sorted name, company class and date bucket become one *cell*, so copies
   of a name are compared once, not once per row.
2. Cells meet only when they share an exact piece of text. A score of ``t`` on lengths
   ``a`` and ``b`` allows at most ``D = (100 - t)(a + b) / 100`` inserted or deleted
   characters. Cut one name into ``D + 1`` segments: at least one is untouched, and it has
   exactly ``i`` edits before it when it is segment ``i``, so its place in the other name
   is known up to a few shifts. Joining on (bucket, lengths, segment, text) therefore loses
   no pair and is a hash join without a nested loop.
3. Segment texts that very many cells share are spread over a grid of tasks.
4. Edit distance, a lower bound of the number of edits, removes nearly all other
   candidates inside the JVM; the exact score is computed for what is left.
5. Matching cells are expanded to rows slot by slot, which spreads cells with many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.config import EmployeeRules
from recordloom.functions.dates import epoch_micros
from recordloom.functions.similarity import lcs_length, score_of, sorted_tokens
from recordloom.functions.text import full_name
from recordloom.operators.resolve import company_rank
from recordloom.operators.skew import grid_join

_DAY_MICROS = 86_400_000_000
_SLOTS = 64  # one bit of a bigint per slot
_CELLS_PER_TASK = 20_000
_RATE = 64  # one name in so many is counted to find crowded pieces

_CELL = ("bucket", "class", "name")

REVIEW_COLUMNS = (
    "record_1_id",
    "record_2_id",
    "similarity_score",
    "hire_date_diff_days",
    "recommended_action",
    "record_1_name",
    "record_2_name",
    "record_1_company",
    "record_2_company",
    "dedup_method",
)


def _candidates_rows(employees: DataFrame, rules: EmployeeRules) -> DataFrame:
    """Rows that can take part (P11) with their cell, slot and place in the total order."""
    width = (rules.fuzzy_window_days + 1) * _DAY_MICROS
    micros = epoch_micros(F.col("hire_date"))
    rank = company_rank(rules)
    return (
        employees.where(F.col("hire_date").isNotNull())
        .select(
            F.coalesce("employee_id", F.lit("<NA>")).alias("id"),
            full_name(F.col("first_name"), F.col("last_name")).alias("full"),
            F.col("company_origin").alias("company"),
            micros.alias("micros"),
            rank.cast("int").alias("class"),
        )
        .where(F.length("full") > 0)
        .withColumns(
            {
                "name": sorted_tokens(F.col("full")),
                "bucket": F.floor(F.col("micros") / width),
                "slot": F.pmod(F.xxhash64("id", "micros"), F.lit(_SLOTS)).cast("int"),
            }
        )
    )


def _allowed_edits(threshold: int, a: Column, b: Column) -> Column:
    """Most insertions and deletions a pair may differ by; has the parity of ``a + b``."""
    most = F.floor(F.lit(100 - threshold) * (a + b) / 100)
    return (most - F.pmod(most - (a + b), F.lit(2))).cast("int")


def _lengths_within(threshold: int, length: Column) -> Column:
    """Every length the partner of a name of this length can have."""
    low = F.ceil(length * threshold / (200 - threshold)).cast("int")
    high = F.floor(length * (200 - threshold) / threshold).cast("int")
    return F.explode(F.sequence(low, high))


def _segments(threshold: int, cells: DataFrame, own: str, other: str) -> DataFrame:
    """One row per partner length and segment: start and size within the right name."""
    lengths = cells.withColumn(own, F.length("name")).select(
        "*", _lengths_within(threshold, F.col(own)).alias(other)
    )
    edits = lengths.withColumn(
        "edits", _allowed_edits(threshold, F.col("left_length"), F.col("right_length"))
    )
    numbered = edits.select("*", F.explode(F.sequence(F.lit(0), F.col("edits"))).alias("segment"))
    count = F.col("edits") + 1
    start = F.floor(F.col("segment") * F.col("right_length") / count).cast("int")
    end = F.floor((F.col("segment") + 1) * F.col("right_length") / count).cast("int")
    return numbered.withColumns({"start": start, "size": end - start})


def _piece(start: Column) -> Column:
    """Join key of a segment text; a hash collision only adds a candidate."""
    text = F.substring("name", start + 1, F.col("size"))
    return F.xxhash64("bucket", "left_length", "right_length", "segment", text).alias("piece")


def _right_pieces(cells: DataFrame, threshold: int) -> DataFrame:
    """Every segment of every name, for each length its partner can have."""
    parts = _segments(threshold, cells, "right_length", "left_length")
    return parts.select(_piece(F.col("start")), *(F.col(c).alias(f"right_{c}") for c in (*_CELL, "slots")))


def _left_pieces(cells: DataFrame, threshold: int) -> DataFrame:
    """Every text that could be an untouched segment of a partner in this or the next bucket.

    With ``i`` edits before segment ``i`` the shift has the parity of ``i``, is at most
    ``i``, leaves at most ``edits - i`` for the rest, and cannot exceed the insertions or
    deletions that the two lengths allow.
    """
    near = cells.withColumn("home", F.col("bucket")).withColumn(
        "bucket", F.explode(F.array(F.col("home"), F.col("home") + 1))
    )
    parts = _segments(threshold, near, "left_length", "right_length")
    i, edits = F.col("segment"), F.col("edits")
    gap = F.col("left_length") - F.col("right_length")
    low = F.greatest(-i, gap - (edits - i), -((edits - gap) / 2).cast("int"))
    high = F.least(i, gap + (edits - i), ((edits + gap) / 2).cast("int"))
    shifted = (
        parts.withColumns({"low": low, "high": high})
        .withColumn("low", F.col("low") + F.pmod(F.col("low") + i, F.lit(2)))
        .where(F.col("low") <= F.col("high"))
        .select("*", F.explode(F.sequence(F.col("low"), F.col("high"), F.lit(2))).alias("shift"))
    )
    at = F.col("start") + F.col("shift")
    inside = shifted.where((at >= 0) & (at + F.col("size") <= F.col("left_length")))
    return inside.select(
        _piece(at),
        F.col("home").alias("left_bucket"),
        *(F.col(c).alias(f"left_{c}") for c in ("class", "name", "slots")),
    )


def _matching_cells(cells: DataFrame, rules: EmployeeRules) -> DataFrame:
    """Pairs of cells whose names score high enough, each once."""
    t = rules.fuzzy_threshold
    outsiders = F.lit(len(rules.companies) + 1)
    left, right = _left_pieces(cells, t), _right_pieces(cells, t)
    # the pieces of one name in _RATE show which pieces are crowded; all of a name's cells are in
    some = cells.where(F.pmod(F.xxhash64("name"), F.lit(_RATE)) == 0)
    samples = _left_pieces(some, t), _right_pieces(some, t)
    met = grid_join(left, right, "piece", _CELLS_PER_TASK, samples, _RATE).where(
        (F.col("left_class") != F.col("right_class")) | (F.col("left_class") == outsiders)
    )
    total = F.length("left_name") + F.length("right_name")
    bound = met.withColumn("most", F.floor(F.lit(100 - t) * total / 100).cast("int"))
    close = bound.where(F.expr("levenshtein(left_name, right_name, most) >= 0"))
    once = close.drop("piece", "most").dropDuplicates(
        [f"{side}_{c}" for side in ("left", "right") for c in _CELL]
    )
    return once.withColumn("lcs", lcs_length("left_name", "right_name")).where(
        F.col("lcs") * 200 >= F.lit(t) * total
    )


def _slots_of(mask: str) -> Column:
    """The slots whose bit is set."""
    every = F.sequence(F.lit(0), F.lit(_SLOTS - 1))
    return F.explode(F.filter(every, lambda s: F.getbit(F.col(mask), s) == 1))


def probable_matches(employees: DataFrame, rules: EmployeeRules) -> DataFrame:
    """Pairs for review; nothing is merged.

    Record 1 is the one hired first; the configured company order, then the id, settles
    equal dates.
    """
    rows = _candidates_rows(employees, rules)
    cells = rows.groupBy(*_CELL).agg(
        F.bit_or(F.expr("shiftleft(1L, slot)")).alias("slots")
    )
    pairs = (
        _matching_cells(cells, rules)
        .withColumn("left_slot", _slots_of("left_slots"))
        .withColumn("right_slot", _slots_of("right_slots"))
    )
    key = (*_CELL, "slot")
    fields = ("id", "full", "company", "micros")
    left = rows.select(*(F.col(c).alias(f"left_{c}") for c in (*key, *fields)))
    right = rows.select(*(F.col(c).alias(f"right_{c}") for c in (*key, *fields)))
    both = pairs.join(left, [f"left_{c}" for c in key]).join(right, [f"right_{c}" for c in key])

    days = F.floor((F.col("right_micros") - F.col("left_micros")) / _DAY_MICROS)
    order = lambda side: F.struct(f"{side}_micros", f"{side}_class", f"{side}_id")
    other_company = F.col("left_company").isNull() | ~F.coalesce(
        F.col("left_company") == F.col("right_company"), F.lit(False)
    )
    total = F.length("left_name") + F.length("right_name")
    return (
        both.where(order("left") < order("right"))
        .where(days <= rules.fuzzy_window_days)
        .where(other_company & (F.col("left_id") != F.col("right_id")))
        .select(
            F.col("left_id").alias("record_1_id"),
            F.col("right_id").alias("record_2_id"),
            score_of(F.col("lcs"), F.length("left_name"), F.length("right_name")).alias(
                "similarity_score"
            ),
            days.cast("bigint").alias("hire_date_diff_days"),
            F.lit("review").alias("recommended_action"),
            F.col("left_full").alias("record_1_name"),
            F.col("right_full").alias("record_2_name"),
            F.col("left_company").alias("record_1_company"),
            F.col("right_company").alias("record_2_company"),
            F.lit("fuzzy_name").alias("dedup_method"),
        )
    )


def review_order(matches: DataFrame) -> DataFrame:
    """Best score first, then the smaller date gap, then ids (O2); for the sink only."""
    return matches.orderBy(
        F.desc("similarity_score"), "hire_date_diff_days", "record_1_id", "record_2_id"
    )
