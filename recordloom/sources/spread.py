"""Spreading rows of files that Spark cannot split."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out evenly when a scan has fewer tasks than the cluster has cores.

    A multi-line document or a file with a single row group is one task however large it
    is, and everything up to the next shuffle would run in that task. Scans with enough
    tasks are left alone, so large inputs do not pay for a shuffle here.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
