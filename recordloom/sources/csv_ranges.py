"""Records of large CSV files, read by many tasks, line breaks inside quotes included.

Texts are cut at line ends. A line may begin inside a quoted cell, so each range reports where it
ends for a beginning inside and outside quotes; see ``pieces``. As in common CSV readers a quote
opens a cell only at its beginning, is doubled inside, and text behind a closing quote belongs to
the cell. A record whose quotes never close takes the rest of its file and counts as over-long.
"""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.plans.staging import stage_folder, staged
from recordloom.sources.pieces import (
    CUT_SCHEMA,
    HEAD,
    LINE,
    SUMMARY_SCHEMA,
    TAIL,
    WHOLE,
    by_file,
    chunks,
    read_pieces,
    rows_out,
    stitched,
    summaries,
)

_SENTINEL = "\u0002"
_REST = rb'(?:[^"]++|"")*+"[^,]*+'  # of a quoted cell, behind its opening quote
_CELL = rb'(?:"' + _REST + rb'|(?!")[^,]*+)'
_LINE = re.compile(_CELL + rb"(?:," + _CELL + rb")*+")
_CLOSE = re.compile(_REST)


class HeaderMismatch(RuntimeError):
    """Files of one source have different headers."""


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a line that begins inside or outside of quotes ends inside."""
    if b'"' not in line:
        return inside
    at = 0
    if inside:
        closed = _CLOSE.match(line)
        if closed is None:
            return True
        at = closed.end() + 1
        if at > len(line):
            return False
    cells = _LINE.match(line, at)
    return cells is None or cells.end() < len(line)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def feed(state: list[bool], pieces: list[bytes], last: bool) -> None:
        for line in pieces:
            if b'"' in line:
                state[:] = [ends_inside(line, s) for s in state]

    return summaries(batches, lambda: [False, True], feed, lambda state: state)


def _starts(lines) -> dict[tuple[str, int], bool]:
    """Whether each range begins inside quotes."""
    starts = {}
    for file, rows in by_file(lines).items():
        inside = False
        for row in rows:
            starts[file, row.block] = inside
            inside = json.loads(row.line)[inside]
    return starts


def _cut(starts):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at = None
        for key, pieces, last in chunks(batches):
            if at != key:
                at, row, held = key, 0, []
                began = inside = starts.value[key[:2]]
                ended = False
            for line in pieces:
                if not held and not inside and not line.rstrip(b"\r"):
                    ended = True
                    continue
                inside = ends_inside(line, inside)
                held.append(line)
                if not inside:
                    text, held, row = b"\n".join(held), [], row + 1
                    text = text.removesuffix(b"\r")
                    yield *key[:2], row, HEAD if began and not ended else WHOLE, text, None
                    ended = True
            if last:
                if held or inside:
                    yield *key[:2], row + 1, TAIL, b"\n".join(held), None
                told = {"head": began and ended, "ends": ended, "tail": bool(held or inside)}
                yield *key[:2], row + 2, LINE, json.dumps(told).encode(), None

    return lambda batches: rows_out(rows(batches))


@dataclass(frozen=True)
class Records:
    """``rows``: the header's names as text columns, line, too_long and _pos."""

    names: list[str]
    rows: DataFrame


def _names(cells: Iterable[str]) -> list[str]:
    """Blank names become ``_c<place>``; of equal ones the later get their place as well."""
    names: list[str] = []
    for i, cell in enumerate(cells):
        name = cell if cell.strip() else f"_c{i}"
        names.append(f"{name}{i}" if name.lower() in {n.lower() for n in names} else name)
    return names


def split_cells(line: Column, names: Sequence[str]) -> tuple[list[Column], Column]:
    """The record's cells, and whether it has more than there are names.

    A sentinel cell is added at the end; it is among the first cells exactly when the record has
    no more than its share.
    """
    fields = [f"f{i}" for i in range(len(names) + 1)]
    ddl = ", ".join(f"{f} string" for f in fields)
    parsed = F.from_csv(F.concat(line, F.lit("," + _SENTINEL)), ddl, {"quote": '"', "escape": '"'})
    ours = [F.coalesce(parsed[f] == _SENTINEL, F.lit(False)) for f in fields]
    too_long = ~F.greatest(*ours) if len(ours) > 1 else ~ours[0]
    return [F.when(~end, parsed[f]).alias(n) for f, n, end in zip(fields, names, ours)], too_long


def read_records(spark: SparkSession, path: str, encoding: str = "UTF-8", folder: str | None = None) -> Records:
    """All records of the files of one source, without their headers.

    Two jobs read the files' bytes, in as many tasks as there are ranges; the records are then a
    written table in ``folder``. The driver gets a line per range and a header per file, which
    must all be equal, as cells are bound by position.
    """
    folder = folder or stage_folder(spark)
    pieces = read_pieces(spark, path, "\n")
    starts = _starts(pieces.mapInArrow(_summarise, SUMMARY_SCHEMA).collect())
    known = spark.sparkContext.broadcast(starts)  # one entry per range
    cut = staged(pieces.mapInArrow(_cut(known), CUT_SCHEMA), folder, "records")
    whole = cut.where(F.col("kind") == WHOLE).select("file", "block", "row", "text")
    if any(starts.values()):
        whole = whole.unionByName(stitched(cut, b"\n"))
    elif cut.where(F.col("kind") == TAIL).limit(1).count():  # quotes left open at the end of a file
        whole = whole.unionByName(stitched(cut, b"\n"))
    # the first record of a file is in its first range
    first = whole.where("block = 0").groupBy("file").agg(F.min_by("text", "row").alias("text"), F.min("row").alias("row"))
    headers = {r.file: (bytes(r.text), r.row) for r in first.collect()}
    if not headers:
        return Records([], spark.createDataFrame([], "line string, too_long boolean, _pos struct<file:string,block:bigint,row:bigint>"))
    lists = {f: next(csv.reader([t.decode(encoding, "replace").removeprefix("﻿")]), []) for f, (t, _) in headers.items()}
    sample = min(lists)
    for file, cells in lists.items():
        if cells != lists[sample]:
            raise HeaderMismatch(f"the header of {file} differs from that of {sample}")
    names = _names(lists[sample])
    heads = spark.createDataFrame([(f, 0, r) for f, (_, r) in headers.items()], "file string, block long, row long")
    # one line per file
    body = whole.join(F.broadcast(heads), ["file", "block", "row"], "left_anti")
    raw = F.col("text")
    line = F.decode(raw, encoding) if encoding.upper() != "UTF-8" else F.make_valid_utf8(raw.cast("string"))
    texts = body.select(line.alias("line"), F.struct("file", "block", "row").alias("_pos"))
    cells, too_long = split_cells(F.col("line"), names)
    return Records(names, texts.select(*cells, "line", too_long.alias("too_long"), "_pos"))
