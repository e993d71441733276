"""The elements of a large JSON document's top-level array, read by many tasks.

Texts are cut at closing braces. A brace may lie in a string and at any depth, so each range
reports, for a beginning inside and outside a string, whether it ends inside one, how deep it
went down and up, and whether the wanted array is left open. See ``pieces`` for the rest.

A file holds one UTF-8 document whose root is an object. It is unreadable as a whole, as for a
plain parser, when its brackets don't match, an element or what is around the array isn't JSON, or
the key holds no array. Several arrays under the same key are read one after the other.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.plans.staging import stage_folder, staged
from recordloom.sources.pieces import (
    CUT_SCHEMA,
    HEAD,
    LINE,
    OUTSIDE,
    SUMMARY_SCHEMA,
    TAIL,
    WHOLE,
    by_file,
    chunks,
    empty_files,
    read_pieces,
    rows_out,
    stitched,
    summaries,
)

#: Bytes beside the array that a document may have; they are put together in one row.
AROUND = 64 << 20
_QUOTE, _SLASH, _COMMA, _OPEN = b'"\\,['
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(b"[]{},")] = True
_STEP = np.zeros(256, np.int64)
_STEP[list(b"[{")] = 1
_STEP[list(b"]}")] = -1


def _marks(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of brackets and commas, their kinds, the parity of quotes before each, of all quotes."""
    text = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(text == _QUOTE)
    if b"\\" in data:
        slash = np.flatnonzero(text == _SLASH)
        first = np.flatnonzero(np.diff(slash, prepend=-2) != 1)
        length = np.diff(first, append=len(slash))
        escaped = (slash[first] + length)[length % 2 == 1]  # behind an odd run of backslashes
        quotes = quotes[~np.isin(quotes, escaped)]
    at = np.flatnonzero(_IS_MARK[text])
    return at, text[at], np.searchsorted(quotes, at) & 1, len(quotes) & 1


def _opening(array: str) -> re.Pattern[bytes]:
    return re.compile(rb"(?<!\\)" + re.escape(json.dumps(array, ensure_ascii=False).encode()) + rb"\s*:\s*\[")


@dataclass
class _Walk:
    """How a range changes a state, for one state that it may begin in."""

    string: int
    depth: int = 0
    low: int = 0
    open: list[int] = field(default_factory=list)  # depth around each wanted array left open

    def feed(self, marks, wanted: list[int]) -> None:
        at, kind, parity, odd = marks
        real = parity == self.string
        at, depth = at[real], self.depth + np.cumsum(_STEP[kind[real]])
        if len(at):
            low = int(depth.min())
            self.open = [r for r in self.open if low > r]
            for place in wanted:
                i = int(np.searchsorted(at, place))
                if i < len(at) and at[i] == place and depth[i:].min() >= depth[i]:
                    self.open.append(int(depth[i]) - 1)
            self.low, self.depth = min(self.low, low), int(depth[-1])
        self.string ^= odd

    def line(self) -> list:
        return [self.string, self.depth, self.low, self.open]


def _summary(array: str):
    opening = _opening(array)

    def start():
        return {"walks": [_Walk(0), _Walk(1)], "bytes": 0, "lines": None}

    def feed(state, pieces: list[bytes], last: bool):
        data = b"}".join(pieces)
        for part in (data, b"}"):
            marks, wanted = _marks(part), [m.end() - 1 for m in opening.finditer(part)]
            if last and part == b"}":  # without the separator, as a file may end so
                state["lines"] = [w.line() for w in state["walks"]]
            for walk in state["walks"]:
                walk.feed(marks, wanted)
        state["bytes"] += len(data) + 1

    def finish(state):
        return [state["bytes"], [w.line() for w in state["walks"]], state["lines"]]

    return lambda batches: summaries(batches, start, feed, finish)


@dataclass(frozen=True)
class _Start:
    """The state a range begins in; ``short`` when its last piece has no separator behind it."""

    string: int
    depth: int
    inside: bool
    short: bool


def _starts(lines) -> tuple[dict[tuple[str, int], _Start], dict[str, bool]]:
    """First state of every range, and whether the brackets and strings of each file match."""
    starts, fits = {}, {}
    for file, rows in by_file(lines).items():
        told = [json.loads(r.line) for r in rows]
        short = sum(t[0] for t in told) > rows[0].size
        string, depth, inside, good = 0, 0, False, True
        for row, (_, after, without) in zip(rows, told):
            cut = short and row is rows[-1]
            starts[file, row.block] = _Start(string, depth, inside, cut)
            end, delta, low, open_ = (without if cut else after)[string]
            good = good and depth + low >= 0
            inside = (inside and depth + low >= 2) or any(depth + r == 1 for r in open_)
            string, depth = end, depth + delta
        fits[file] = good and not string and depth == 0
    return starts, fits


def _is_json(text: bytes) -> bool:
    try:
        json.loads(text.decode("utf-8"))
    except (ValueError, RecursionError):
        return False
    return True


class _Cut:
    """Goes through one range and gives its elements, their parts at its ends, and the rest."""

    def __init__(self, file: str, block: int, start: _Start, opening: re.Pattern[bytes]):
        self.file, self.block, self.opening = file, block, opening
        self.walk = _Walk(start.string, start.depth)
        self.inside = self.began = start.inside
        self.ended = False  # a text ended or the array began in this range
        self.fresh = False  # the array began here and has no comma yet
        self.held: list[bytes] = []
        self.row = self.around = 0

    def _give(self, kind: int, text: bytes, valid: bool | None = None) -> tuple:
        self.row += 1
        return self.file, self.block, self.row, kind, text, valid

    def _end(self, closing: bool) -> Iterator[tuple]:
        text, self.held = b"".join(self.held), []
        if self.began and not self.ended:
            yield self._give(HEAD, text)
        elif not (closing and self.fresh and not text.strip()):
            yield self._give(WHOLE, text, _is_json(text))
        self.ended, self.fresh = True, False

    def feed(self, data: bytes) -> Iterator[tuple]:
        at, kind, parity, odd = _marks(data)
        real = parity == self.walk.string
        at, kind = at[real], kind[real]
        depth = self.walk.depth + np.cumsum(_STEP[kind])
        wanted = np.isin(at, [m.end() - 1 for m in self.opening.finditer(data)]) & (depth == 2)
        event = ((kind == _COMMA) & (depth == 2)) | ((_STEP[kind] < 0) & (depth == 1)) | wanted
        done = 0
        for place, what in zip(at[event].tolist(), kind[event].tolist()):
            if self.inside:
                self.held.append(data[done:place])
                yield from self._end(what != _COMMA)
                self.inside = what == _COMMA
                done = place + 1 if self.inside else place
            elif what == _OPEN:
                yield from self._outside(data[done : place + 1])
                self.inside = self.ended = self.fresh = True
                done = place + 1
        if self.inside:
            self.held.append(data[done:])
        else:
            yield from self._outside(data[done:])
        if len(depth):
            self.walk.depth = int(depth[-1])
        self.walk.string ^= odd

    def _outside(self, text: bytes) -> Iterator[tuple]:
        self.around += len(text)
        yield self._give(OUTSIDE, text)

    def close(self) -> Iterator[tuple]:
        if self.inside:
            yield self._give(TAIL, b"".join(self.held))
        head = self.began and self.ended
        told = {"head": head, "ends": self.ended, "tail": self.inside, "around": self.around}
        yield self._give(LINE, json.dumps(told).encode())


def _cut(array: str, starts):
    opening = _opening(array)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        cut = at = None
        for key, pieces, last in chunks(batches):
            if at != key:
                at, start = key, starts.value[key[:2]]
                cut = _Cut(*key[:2], start, opening)
            yield from cut.feed(b"}".join(pieces) + (b"" if last and start.short else b"}"))
            if last:
                yield from cut.close()

    return lambda batches: rows_out(rows(batches))


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks which of the texts in the last column are JSON."""
    for batch in batches:
        good = [_is_json(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(good, pa.bool_())], names=[*batch.schema.names, "valid"])


@dataclass(frozen=True)
class Documents:
    """``docs``: _file, the wanted fields beside the array, actual_records, readable.
    ``elements``: _file, _block, _pos, element, for readable documents only."""

    docs: DataFrame
    elements: DataFrame


def read_array(spark: SparkSession, path: str, array: str, extra: str, folder: str | None = None) -> Documents:
    """Elements of the top-level ``array`` of every file, and one row per file.

    Two jobs read the file's bytes, in as many tasks as it has ranges; the elements are then a
    written table in ``folder``. The driver gets a line per range and one per file.
    """
    folder = folder or stage_folder(spark)
    pieces = read_pieces(spark, path, "}")
    starts, fits = _starts(pieces.mapInArrow(_summary(array), SUMMARY_SCHEMA).collect())
    known = spark.sparkContext.broadcast(starts)  # one entry per range
    cut = staged(pieces.mapInArrow(_cut(array, known), CUT_SCHEMA), folder, "elements")
    whole = cut.where(F.col("kind") == WHOLE).select("file", "block", "row", "text", "valid")
    crossing = stitched(cut).mapInArrow(_checked, "file string, block long, row long, text binary, valid boolean")
    elements = whole.unionByName(staged(crossing, folder, "crossing"))

    told = by_file(cut.where(F.col("kind") == LINE).collect())
    around = {f: sum(json.loads(r.text)["around"] for r in rows) for f, rows in told.items()}
    small = [f for f in fits if fits[f] and around[f] <= AROUND]
    files = [*((f, f in set(small)) for f in fits), *((f, False) for f in empty_files(spark, path, set(fits)))]
    listed = spark.createDataFrame(files, "file string, fits boolean")
    counts = elements.groupBy("file").agg(F.count("*").alias("n"), F.bool_and("valid").alias("valid"))
    text = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("block", "row", "text"))), lambda p: p["text"].cast("string")))
    # what is around the array is small, and one row per file
    outside = cut.where(F.col("kind") == OUTSIDE).join(F.broadcast(listed.where("fits")), "file")
    document = outside.groupBy("file").agg(text.alias("text"))
    root = F.try_parse_json("text")
    has_array = F.coalesce(F.schema_of_variant(F.try_variant_get(root, f"$.{array}", "variant")).startswith("ARRAY"), F.lit(False))
    joined = listed.join(document, "file", "left").join(counts, "file", "left")
    docs = joined.select(
        F.col("file").alias("_file"),
        F.from_json("text", extra).alias("fields"),
        F.coalesce("n", F.lit(0)).cast("long").alias("actual_records"),
        (F.col("fits") & F.col("text").isNotNull() & has_array & F.coalesce("valid", F.lit(True))).alias("readable"),
    ).select("_file", "fields.*", "actual_records", "readable")
    docs = staged(docs, folder, "documents")
    lost = [(r["_file"],) for r in docs.where(~F.col("readable")).collect()]
    if lost:
        gone = spark.createDataFrame(lost, "file string")
        elements = elements.join(F.broadcast(gone), "file", "left_anti")  # one line per file
    return Documents(
        docs,
        elements.select(
            F.col("file").alias("_file"),
            F.col("block").alias("_block"),
            F.col("row").alias("_pos"),
            F.btrim(F.col("text").cast("string"), F.lit(" \t\r\n")).alias("element"),
        ),
    )
