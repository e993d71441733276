"""Files read in byte ranges, cut at a separator, with the state of a parser carried across ranges.

Spark's text reader splits a file of any size into ranges and gives the pieces between separators.
What a range means depends on where the text before it stopped: inside a quoted cell, inside a
string, at some depth. So every range first reports how it changes each state that it may begin
in; the driver composes these lines, one per range, in file order, and the ranges are then cut
with their true first state. A piece that crosses ranges is put together from its parts.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: kinds of rows that a cut gives
WHOLE, HEAD, TAIL, OUTSIDE, LINE = range(5)
CUT_SCHEMA = "file string, block long, row long, kind int, text binary, valid boolean"
SUMMARY_SCHEMA = "file string, block long, size long, line string"
_NAMES = ["file", "block", "row", "kind", "text", "valid"]
_ROWS = 2000

Key = tuple[str, int, int]  # file, first byte of the range, bytes of the file


def read_pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(piece, file, block, size); the pieces of one range come in order, in one task."""
    found = spark.read.option("lineSep", separator).text(path)
    return found.select(
        F.col("value").cast("binary").alias("piece"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
    )


def empty_files(spark: SparkSession, path: str, seen: set[str]) -> list[str]:
    """Files of a path that gave no piece at all."""
    known = {unquote(f).removeprefix("file:").lstrip("/") for f in seen}
    files = spark.read.text(path).inputFiles()
    return [f for f in files if unquote(f).removeprefix("file:").lstrip("/") not in known]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Key, list[bytes], bool]]:
    """(range, some of its pieces in order, whether these are its last)."""
    import numpy as np

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column(1).dictionary_encode()
        name = files.indices.to_numpy(zero_copy_only=False)
        block = batch.column(2).to_numpy(zero_copy_only=False)
        new = np.flatnonzero((name[1:] != name[:-1]) | (block[1:] != block[:-1])) + 1
        for lo, hi in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
            key = (files.dictionary[int(name[lo])].as_py(), int(block[lo]), batch.column(3)[lo].as_py())
            if held:
                yield *held, held[0] != key
            held = key, batch.column(0).slice(lo, hi - lo).to_pylist()
    if held:
        yield *held, True


def summaries(batches: Iterator[pa.RecordBatch], start: Callable, feed: Callable, finish: Callable):
    """One line per range: ``finish`` of the states that ``feed`` made of its pieces."""
    state, at = None, None
    for key, pieces, last in chunks(batches):
        if at != key:
            state, at = start(), key
        feed(state, pieces, last)
        if last:
            line = json.dumps(finish(state))
            columns = [pa.array([x], t) for x, t in zip((*key, line), (pa.string(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "size", "line"])


def rows_out(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Tuples as batches of ``CUT_SCHEMA``."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()]
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=_NAMES)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=_NAMES)


def by_file(lines) -> dict[str, list]:
    """Collected summary or cut lines per file, in the order of their ranges."""
    files: dict[str, list] = {}
    for row in sorted(lines, key=lambda r: (r.file, r.block)):
        files.setdefault(row.file, []).append(row)
    return files


def stitched(cut: DataFrame, joiner: bytes = b"") -> DataFrame:
    """(file, block, row, text) of the texts that cross ranges, each under the range it begins in.

    A LINE row tells whether its range has an end of a text in it. The driver gets these lines,
    one per range, and gives each part the range that its text begins in.
    """
    spark = cut.sparkSession
    owners = []
    for file, rows in by_file(cut.where(F.col("kind") == LINE).collect()).items():
        owner = None
        for row in rows:
            told = json.loads(row.text)
            if owner is not None and told["head"]:
                owners.append((file, row.block, HEAD, owner))
            if owner is None or told["ends"]:
                owner = row.block
            if told["tail"]:
                owners.append((file, row.block, TAIL, owner))
            else:
                owner = None
    table = spark.createDataFrame(owners, "file string, block long, kind int, owner long")
    # at most two lines per range
    parts = cut.where(F.col("kind").isin(HEAD, TAIL)).join(F.broadcast(table), ["file", "block", "kind"])
    ordered = F.array_sort(F.collect_list(F.struct("block", "kind", "text")))
    texts = F.transform(ordered, lambda p: p["text"])
    glued = F.aggregate(
        F.slice(texts, 2, F.size(texts)), texts[0], lambda a, b: F.concat(a, F.lit(joiner), b)
    )
    return parts.groupBy("file", F.col("owner").alias("block")).agg(glued.alias("text")).select(
        "file", "block", F.lit((1 << 62)).cast("long").alias("row"), "text"
    )
