"""The place of every row in an order, without a window over all rows.

Rows are range-partitioned and sorted; a row's place is the number of rows in the partitions
before its own plus its place within it. Only one count per partition reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.plans.staging import stage_folder, staged

_IN_PARTITION = (1 << 33) - 1  # the low bits of Spark's growing row id


def with_place(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "place",
    folder: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """All rows with their place, from 1, in a long column ``name``.

    The sorted rows are written once, so that places don't change when an executor is lost.
    Rows that the order doesn't tell apart get different places in any order, and share a
    partition: add a unique column where many rows can be equal. An empty frame stays empty.
    """
    spark = df.sparkSession
    if name in df.columns:
        raise ValueError(f"the frame already has a column {name}")
    wide = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_id = F.monotonically_increasing_id()
    # on the sorted partition: its number, and the row's number in it
    ordered = (
        df.repartitionByRange(wide, *order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "__part": F.shiftright(row_id, 33),
                name: row_id.bitwiseAND(F.lit(_IN_PARTITION)) + 1,
            }
        )
    )
    written = staged(ordered, folder or stage_folder(spark), "ordered")
    counts = sorted(map(tuple, written.groupBy("__part").count().collect()))
    before = accumulate((n for _, n in counts), initial=0)
    offsets = spark.createDataFrame(
        [(part, rows) for (part, _), rows in zip(counts, before)], "__part long, __before long"
    )
    # one row per partition
    return (
        written.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col(name) + F.col("__before"))
        .drop("__part", "__before")
    )


def preview(df: DataFrame, order: Sequence[Column], rows: int = 10) -> DataFrame:
    """The first rows of an order with their place; only these leave their partitions."""
    from pyspark.sql import Window

    first = df.orderBy(*order).limit(rows)
    return first.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))
