"""Exact group quantiles without holding a group in one task.

``percentile`` keeps every distinct value of a group in one buffer. Here values are counted
first, counts are summed into coarse bins, and only the bins that hold a wanted rank are
looked at value by value.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BINS_PER_E = 512


def coarse_bin(value: Column) -> Column:
    """Non-decreasing in ``value``; bins are about 0.2 percent wide, on either side of zero.

    Doubles have at most some 700,000 such bins; amounts below a billion have 21,000.
    """
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * _BINS_PER_E)


def value_counts_of(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, copies), nulls left out; copies of a value are summed before the shuffle."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(group), F.col(value).cast("double").alias("value"))
        .agg(F.count("*").alias("copies"))
    )


def exact_quantiles(counts: DataFrame, group: str, wanted: Mapping[str, float]) -> DataFrame:
    """One row per group with the interpolated quantiles ``wanted``, named by their keys.

    Groups must not be null. ``counts`` is the result of :func:`value_counts_of`. A quantile ``p`` of ``n`` values
    lies between the ranks below and above ``p * (n - 1)``, both counted from zero.
    """
    binned = counts.withColumn("bin", coarse_bin(F.col("value")))
    bins = binned.groupBy(group, "bin").agg(F.sum("copies").alias("size"))
    upto = Window.partitionBy(group).orderBy("bin")
    ranked = bins.withColumns(
        {
            "until": F.sum("size").over(upto.rowsBetween(Window.unboundedPreceding, 0)),
            "n": F.sum("size").over(Window.partitionBy(group)),
        }
    ).withColumn("from", F.col("until") - F.col("size"))

    spots = [
        F.struct(
            F.lit(name).alias("name"),
            (F.lit(float(p)) * (F.col("n") - 1)).alias("spot"),
        )
        for name, p in wanted.items()
    ]
    ranks = ranked.select("*", F.inline(F.array(*spots)))
    ends = F.array(
        F.struct(F.lit("low").alias("end"), F.floor("spot").alias("rank")),
        F.struct(F.lit("high").alias("end"), F.ceil("spot").alias("rank")),
    )
    targets = (
        ranks.select(group, "bin", "from", "until", "name", "spot", F.inline(ends))
        .where((F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("until")))
        .select(group, "bin", "from", "name", "spot", "end", "rank")
    )

    # running count of the values inside a wanted bin: distinct values only, one bin per key
    wanted_bins = targets.select(group, "bin", "from").distinct()
    inside = Window.partitionBy(group, "bin").orderBy("value")
    running = F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    stepped = (
        binned.join(wanted_bins, [group, "bin"])
        .withColumn("value_until", F.col("from") + running)
        .select(group, "bin", "value", "copies", "value_until")
    )
    found = targets.join(stepped, [group, "bin"]).where(
        (F.col("rank") >= F.col("value_until") - F.col("copies"))
        & (F.col("rank") < F.col("value_until"))
    )

    end = lambda name, which: F.max(
        F.when((F.col("name") == name) & (F.col("end") == which), F.col("value"))
    )
    part = lambda name: F.max(F.when(F.col("name") == name, F.col("spot") - F.floor("spot")))
    return found.groupBy(group).agg(
        *(
            (end(n, "low") + part(n) * (end(n, "high") - end(n, "low"))).alias(n)
            for n in wanted
        )
    )
