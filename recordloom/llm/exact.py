"""Exact duplicates by content sort.

Sampled splitters range-partition the rows by their normalised bytes, Spark's external sort
puts equal texts next to each other, and neighbours are compared in full. Splitters and sort
keys hold a prefix of the normalised text, its 64-bit hash and the id, so a splitter is small
however long the texts are, and the copies of one text may span many partitions: such a run is
put together from one line for each partition it touches.

Cases: a null text counts as empty, and all empty texts are equal. Rows that are equal in text
and id are one group of which exactly one stays. A null id is the smallest. Other columns, of
any name, pass through untouched. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.common import staged, table, width

PREFIX = 32  # code points of the normalised text in a sort key
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: str | F.Column) -> F.Column:
    """Null as empty, A-Z lower-cased, nothing else."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def _sorted(df: DataFrame, id_col: str, text_col: str, keep: str, partitions: int) -> DataFrame:
    """Rows as ``__row`` with ``__id`` and ``__norm``; the one to keep leads the run of its text."""
    order = F.col("__id").desc_nulls_last() if keep == "largest" else F.col("__id").asc_nulls_first()
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    keyed = df.select(F.col(f"`{id_col}`").alias("__id"), normalised(F.col(f"`{text_col}`")).alias("__norm"), whole.alias("__row"))
    keyed = keyed.select("__id", "__row", F.substring("__norm", 1, PREFIX).alias("__head"), F.xxhash64("__norm").alias("__hash"))
    spread = keyed.repartitionByRange(partitions, F.col("__head"), F.col("__hash"), order)
    norm = normalised(F.col("__row").getField(text_col))
    return spread.withColumn("__norm", norm).sortWithinPartitions("__head", "__hash", "__norm", order)


class _Runs:
    """Goes through sorted batches and gives, per batch, where a new text or a new id begins."""

    def __init__(self):
        self.text = self.key = self.first = None

    def marks(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        norms, n = batch.column("__norm"), batch.num_rows
        keys = batch.column("__hash").to_pylist()
        new = np.ones(n, bool)
        for i in range(n):
            if self.text is not None and keys[i] == self.key and norms[i].as_py() == self.text:
                new[i] = False
            else:
                self.key, self.text = keys[i], norms[i].as_py()
                if self.first is None:
                    self.first = self.key
        return new, np.array(keys, np.int64)


_DECISION = T.StructType(
    [
        T.StructField("__id", T.LongType()),
        T.StructField("keep", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("leads", T.BooleanType()),
        T.StructField("digest", T.StringType()),
        T.StructField("edge", T.BooleanType()),
        T.StructField("part", T.IntegerType()),
    ]
)


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One line per row; a run's lines are held until it ends, as ids only."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    state = _Runs()
    held: list[np.ndarray | list] = []
    digest, first_key, waiting = None, None, []

    def lines(ids: list, digest: str, key: int, edge: bool):
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([ids[0]] * n, pa.int64()),
                pa.array(np.full(n, n), pa.int64()),
                pa.array(np.arange(n) == 0),
                pa.array([digest] * n, pa.string()),
                pa.array(np.full(n, edge)),
                pa.array(np.full(n, part), pa.int32()),
            ],
            names=[f.name for f in _DECISION],
        )

    run_key = None
    for batch in batches:
        new, keys = state.marks(batch)
        norms, ids = batch.column("__norm"), batch.column("__id").to_pylist()
        cuts = [0, *np.flatnonzero(new[1:]).__add__(1).tolist(), batch.num_rows] if batch.num_rows else []
        for lo, hi in zip(cuts, cuts[1:]):
            if new[lo]:
                if held:
                    waiting.append((held, digest, run_key))
                held, run_key = [], int(keys[lo])
                digest = hashlib.sha256(norms[lo].as_py().encode("utf-8", "surrogatepass")).hexdigest()
                if first_key is None:
                    first_key = run_key
            held.extend(ids[lo:hi])
        # a run is an edge if its key is the partition's first or last; the last isn't known before the end
        ready = [w for w in waiting if w[2] != run_key]
        waiting = [w for w in waiting if w[2] == run_key]
        for ids_, digest_, key in ready:
            yield lines(ids_, digest_, key, key == first_key)
    if held:
        waiting.append((held, digest, run_key))
    for ids_, digest_, key in waiting:
        yield lines(ids_, digest_, key, True)


def decisions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", partitions: int | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``keep`` says whether the smallest or the largest id of equal texts stays.
    """
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    parts = partitions or width(df.sparkSession)
    lines = staged(_sorted(slim, "id", "text", keep, parts).select("__id", "__norm", "__hash").mapInArrow(_decide, _DECISION))
    # at most the runs at both ends of each partition
    best = F.max("keep") if keep == "largest" else (F.when(F.max(F.col("keep").isNull()), None).otherwise(F.min("keep")))
    edges = lines.where("edge and leads").groupBy(F.col("digest").alias("seen")).agg(best.alias("all_keep"), F.sum("size").alias("all_size"), F.min("part").alias("first_part"))
    got = lines.join(F.broadcast(edges), F.col("edge") & (F.col("digest") == F.col("seen")), "left")
    whole = F.col("all_size").isNotNull()
    return got.select(
        F.col("__id").alias("id"),
        F.when(whole, F.col("all_keep")).otherwise(F.col("keep")).alias("keep_id"),
        F.when(whole, F.col("all_size")).otherwise(F.col("size")).alias("group_size"),
        (F.col("leads") & (~whole | (F.col("part") == F.col("first_part")))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First rows of the runs; in a partition's first run the text may have begun before it."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    state = _Runs()
    for batch in batches:
        new, keys = state.marks(batch)
        at = np.flatnonzero(new)
        if len(at):
            got = batch.take(pa.array(at))
            doubt = keys[at] == state.first
            digests = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in got.column("__norm").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [got.column("__row"), pa.array(digests, pa.binary()), pa.array(doubt), pa.array(np.full(len(at), part), pa.int32())],
                names=["__row", "digest", "doubt", "part"],
            )


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", partitions: int | None = None) -> DataFrame:
    """The rows that stay, with their columns as they came."""
    parts = partitions or width(df.sparkSession)
    ordered = _sorted(df, id_col, text_col, keep, parts).select("__row", "__norm", "__hash")
    schema = T.StructType([ordered.schema["__row"], T.StructField("digest", T.BinaryType()), T.StructField("doubt", T.BooleanType()), T.StructField("part", T.IntegerType())])
    first = staged(ordered.mapInArrow(_leaders, schema))
    # one text per partition can be in doubt, so this side has no more rows than there are partitions
    doubts = first.where("doubt").select(F.col("digest").alias("seen")).distinct()
    repeats = first.join(F.broadcast(doubts), F.col("digest") == F.col("seen")).groupBy("digest").agg(F.min("part").alias("first_part"))
    late = repeats.select(F.col("digest").alias("seen"), "first_part")
    kept = first.join(F.broadcast(late), (F.col("digest") == F.col("seen")) & (F.col("part") > F.col("first_part")), "left_anti")
    return kept.select("__row.*")


def op3(spark, sf_dir: str) -> DataFrame:
    found = decisions(table(spark, sf_dir, "documents"), keep="largest")
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


OP3_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
