"""One parse of a source, written once with its outcomes.

A row has a null ``reason`` when it is good; a rejected one has its reason and the raw record.
Good rows, rejects, counts and flags all come from the written table or from the metrics of the
write itself, so no later step parses the files again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from recordloom.plans.staging import staged

REASON, RAW = "reason", "raw_record"


def mark(df: DataFrame, checks: list[tuple[Column, str]], raw: Column) -> DataFrame:
    """Adds the first reason that holds, and the raw record of rows that have one.

    A condition that is null does not reject.
    """
    reason = F.coalesce(*(F.when(bad, F.lit(why)) for bad, why in checks))
    return df.withColumn(REASON, reason).withColumn(RAW, F.when(F.col(REASON).isNotNull(), raw))


@dataclass(frozen=True)
class Outcomes:
    """The written table of one source and what was seen while it was written."""

    table: DataFrame
    source: str
    seen: Mapping[str, object] = field(default_factory=dict)

    @property
    def good(self) -> DataFrame:
        return self.table.where(F.col(REASON).isNull()).drop(REASON, RAW)

    @property
    def rejects(self) -> DataFrame:
        return self.table.where(F.col(REASON).isNotNull()).select(
            F.lit(self.source).alias("source_system"), REASON, RAW
        )


def written(
    rows: DataFrame,
    source: str,
    folder: str,
    counts: Mapping[str, Column] | None = None,
    **flags: Column,
) -> Outcomes:
    """Write marked rows once. On the way ``counts`` are aggregated, and of every flag whether a
    good row has it (null where there is no good row).

    The metrics belong to the last stage of the write, whose tasks count once each, also when
    an executor is lost and a task runs again.
    """
    watch = Observation()
    of_good = [F.bool_or(F.when(F.col(REASON).isNull(), f)).alias(n) for n, f in flags.items()]
    given = [c.alias(n) for n, c in (counts or {}).items()]
    basic = [F.count(F.lit(1)).alias("rows_read"), F.count(REASON).alias("rows_rejected")]
    counted = rows.observe(watch, *basic, *given, *of_good)
    table = staged(counted, folder, source)
    return Outcomes(table, source, watch.get)
