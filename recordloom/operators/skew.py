"""Equi-join that spreads hot keys over a grid of tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(left: DataFrame, right: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """Keys over the limit on either side, and the lines and columns to cut them into.

    There are at most ``rows / rows_per_task`` of them. Partial sums are built before the
    shuffle, so a hot key costs one row per task.
    """
    both = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    parts = lambda n: F.greatest(F.ceil(F.col(n) / rows_per_task), F.lit(1)).cast("bigint")
    return (
        both.groupBy(key)
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
        .where(F.greatest("l", "r") > rows_per_task)
        .where(F.least("l", "r") > 0)
        .select(key, parts("l").alias("_lines"), parts("r").alias("_columns"))
    )


def _place(df: DataFrame, hot: DataFrame, key: str, own: str, other: str, cell: tuple[str, str]) -> DataFrame:
    """Each row in one line of its key's grid, repeated along the other direction."""
    cols = [c for c in df.columns if c != key]
    mine = F.coalesce(F.pmod(F.xxhash64(*cols), F.col(own)), F.lit(0).cast("bigint"))
    last = F.coalesce(F.col(other), F.lit(1).cast("bigint")) - 1
    repeated = F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    return df.join(hot, key, "left").select(key, *cols, mine.alias(cell[0]), repeated.alias(cell[1]))


def grid_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    rows_per_task: int,
    samples: tuple[DataFrame, DataFrame] | None = None,
    rate: int = 1,
) -> DataFrame:
    """Inner join on ``key`` with the same rows as a plain join.

    A key with ``m`` rows on the left and ``n`` on the right is ``m * n`` comparisons. When
    either side is over ``rows_per_task`` the key is cut into a grid: a left row goes to one
    line of it and is repeated along the columns, a right row the other way round, so each
    pair meets in exactly one cell.

    Keys are counted in ``samples`` of both sides where these are given, one row in ``rate`` of
    each, because making the rows again only to count them can cost as much as the join. The
    counts decide only how work is cut, never which rows meet.

    The plan is one at every size and stays lazy: hot keys are counted as part of it, and
    adaptive execution chooses how to join the counted table from its measured size.
    """
    hot = hot_keys(*(samples or (left, right)), key, max(rows_per_task // rate, 1))
    lines = _place(left, hot, key, "_lines", "_columns", ("_line", "_column"))
    columns = _place(right, hot, key, "_columns", "_lines", ("_column", "_line"))
    return lines.join(columns, [key, "_line", "_column"]).drop("_line", "_column")
