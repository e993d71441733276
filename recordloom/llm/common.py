"""Helpers of all operators: input tables, shared scratch tables, runs of sorted rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share.

    Where the setting is absent a local session gets a folder of its own; a cluster must name
    one, as executors don't see each other's disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"{tempfile.gettempdir()}/recordloom-scratch"
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame, partitions_by: int | None = None) -> DataFrame:
    """Written and read again: lineage ends, readers prune columns, sizes are known to the planner."""
    spark = df.sparkSession
    path = scratch(spark)
    (df if partitions_by is None else df.repartition(partitions_by)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    """Partitions for a shuffle that states its number, as the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame doesn't have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of all rows that share a key, from batches sorted by it. Runs of one row are kept."""
    import numpy as np

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and keys[lo] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = keys[lo]
    if held:
        yield pa.Table.from_batches(held)


def whole_runs(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[pa.Table]:
    """Tables of at least ``least`` rows, but for the last, that cut no run of equal keys."""
    import numpy as np

    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and keys[0] != last:
            starts = np.concatenate([[0], starts])
        done = 0
        for cut in starts.tolist():
            if size + cut - done >= least:
                yield pa.Table.from_batches([*held, batch.slice(done, cut - done)])
                held, size, done = [], 0, cut
        held.append(batch.slice(done))
        size, last = size + batch.num_rows - done, keys[-1]
    if held:
        yield pa.Table.from_batches(held)
