"""Elements of large XML files, read by many tasks in one pass.

Texts are cut at the closing tag of the wanted element, so every piece holds one element at its
end and perhaps other text before it. What lies outside the elements must be a document of its own,
so that a file cut short is noticed; it goes through a parser in the order of the file, in parts, so
there may be any amount of it. Files are UTF-8. Closing tags inside
comments or CDATA, and wanted elements inside each other, make a file broken.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.plans.staging import stage_folder, staged
from recordloom.sources.pieces import chunks, empty_files, read_pieces

#: Characters of a row of what is outside the elements (thousands are read at once), and of such rows in a batch.
PART, PARTS = 1 << 12, 1 << 24
_SCHEMA = "file string, block long, row long, record map<string,string>, broken boolean, outside string, plain boolean"


#: What may be told without a parser: names, texts without references, spaces between elements.
_NAME = "[A-Za-z_][A-Za-z0-9_.-]*"
_TEXT = "[^<>&\x00-\x08\x0b-\x1f\ufffe\uffff]*"
_SPACE = "[ \t\r\n]*"
_CHILD = re.compile(f"<({_NAME})>({_TEXT})<")


def _record(element: ET.Element) -> dict[str, str | None]:
    """Child tags and their trimmed texts; empty ones are null."""
    return {child.tag: (child.text or "").strip() or None for child in element}


class _Rows:
    """Rows of one range, kept as columns.

    Elements with exactly the wanted fields are ``plain``: they have cells and no record. The keys
    and values of other records go to flat lists.
    """

    def __init__(self, fields: Sequence[str]) -> None:
        self.fields = fields
        self.cells: list[tuple] = []
        self.offsets: list[int | None] = []
        self.keys: list[str] = []
        self.values: list[str | None] = []
        self.broken: list[bool] = []
        self.outside: list[str | None] = []
        self.plain: list[bool] = []
        self.size = 0  # of what is outside
        self._none = (None,) * len(fields)

    def add(self, record: dict[str, str | None] | None, broken: bool, outside: str | None = None) -> None:
        self._row(self._none, None if record is None else len(self.keys), broken, outside, False)
        if record:
            self.keys += record
            self.values += record.values()

    def add_outside(self, text: str) -> None:
        for lo in range(0, len(text), PART):
            self.add(None, False, text[lo : lo + PART])
        self.size += len(text)

    def add_plain(self, cells: tuple) -> None:
        self._row(cells, None, False, None, True)

    def _row(self, cells, offset, broken, outside, plain) -> None:
        self.cells.append(cells)
        self.offsets.append(offset)
        self.broken.append(broken)
        self.outside.append(outside)
        self.plain.append(plain)

    def batch(self, file: str, block: int, first: int) -> pa.RecordBatch:
        n = len(self.broken)
        offsets = pa.array([*self.offsets, len(self.keys)], pa.int32())
        columns = {
            "file": pa.repeat(pa.scalar(file, pa.string()), n),
            "block": pa.repeat(pa.scalar(block, pa.int64()), n),
            "row": pa.array(range(first, first + n), pa.int64()),
            "record": pa.MapArray.from_arrays(offsets, pa.array(self.keys, pa.string()), pa.array(self.values, pa.string())),
            "broken": pa.array(self.broken, pa.bool_()),
            "outside": pa.array(self.outside, pa.string()),
            "plain": pa.array(self.plain, pa.bool_()),
        }
        cells = {f"f_{f}": pa.array(c, pa.string()) for f, c in zip(self.fields, zip(*self.cells))}
        return pa.RecordBatch.from_pydict(columns | cells)


def _pieces_to_rows(tag: str, fields: Sequence[str]):
    opening = re.compile(rf"<{re.escape(tag)}(?=[\s>/])[^>]*>")
    closing = f"</{tag}>"
    # elements of simple children only: with exactly the fields, or with any others
    start = f"{_SPACE}<{re.escape(tag)}>{_SPACE}"
    usual = "".join(f"<{re.escape(f)}>({_TEXT})</{re.escape(f)}>{_SPACE}" for f in fields)
    exact = re.compile(start + usual).fullmatch if fields and tag not in fields else None
    simple = re.compile(f"{start}((?:<({_NAME})>{_TEXT}</\\2>{_SPACE})*)").fullmatch

    def of_piece(piece: bytes, rows: _Rows) -> None:
        try:
            text = piece.decode("utf-8")
        except UnicodeDecodeError:
            rows.add(None, True)
            return
        found = exact and exact(text)
        if found:
            rows.add_plain(tuple([cell.strip() or None for cell in found.groups()]))
            return
        found = simple(text)
        if found:
            record = {name: value.strip() or None for name, value in _CHILD.findall(found[1])}
            rows.add(record, tag in record)
            return
        outside, at = [], 0
        for found in opening.finditer(text):
            outside.append(text[at : found.start()])
            if found.group().endswith("/>"):
                rows.add({}, False)
                at = found.end()
                continue
            try:
                element = ET.fromstring(text[found.start() :] + closing)
                rows.add(_record(element), element.find(f".//{tag}") is not None)
            except ET.ParseError:
                rows.add(None, True)
            at = len(text)
            break
        outside.append(text[at:])
        rest = "".join(outside)
        if rest.strip():
            rows.add_outside(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 1  # grows within each range
        for (file, block, _), pieces, _ in chunks(batches):
            rows = _Rows(fields)
            for piece in pieces:
                of_piece(piece, rows)
                if len(rows.broken) >= 2000 or rows.size >= PARTS:
                    yield rows.batch(file, block, row)
                    row += len(rows.broken)
                    rows = _Rows(fields)
            if rows.broken:
                yield rows.batch(file, block, row)
                row += len(rows.broken)

    return run


class _Ignored:
    """Keeps nothing of what a parser finds."""

    def close(self) -> None:
        return None


class _Document:
    """Whether texts that follow one another are one document; they are parsed as they come and not kept."""

    def __init__(self) -> None:
        self.parser = ET.XMLParser(target=_Ignored())
        self.good = True
        self.start: str | None = ""  # until it is known whether a declaration states the encoding
        self.declared = False

    def _parse(self, text: str) -> None:
        for lo in range(0, len(text) if self.good else 0, PART):
            part = text[lo : lo + PART]
            try:
                self.parser.feed(part.encode() if self.declared else part)
            except (ET.ParseError, LookupError):
                self.good = False
                return

    def _begin(self) -> None:
        text, self.start = self.start, None
        self.declared = text.lstrip("\ufeff").startswith("<?xml")
        self._parse(text.lstrip("\ufeff") if self.declared else text)

    def feed(self, text: str) -> None:
        if self.start is None:
            self._parse(text)
            return
        self.start += text
        if len(self.start.lstrip("\ufeff")) >= len("<?xml"):
            self._begin()

    def whole(self) -> bool:
        if self.start is not None:
            self._begin()
        if self.good:
            try:
                self.parser.close()
            except (ET.ParseError, LookupError):
                self.good = False
        return self.good


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per file, whether its texts are a document; the texts of a file follow one another in order."""

    def told(file: str, document: _Document) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": pa.array([file], pa.string()), "whole": pa.array([document.whole()], pa.bool_())})

    file, document = None, None
    for batch in batches:
        for name, text in zip(batch.column("file").to_pylist(), batch.column("outside")):
            if document is None or name != file:
                if document is not None:
                    yield told(file, document)
                file, document = name, _Document()
            document.feed(text.as_py())
    if document is not None:
        yield told(file, document)


@dataclass(frozen=True)
class Elements:
    """``rows``: record (tag to text) and _pos, of whole files; ``broken``: the other files.

    With fields, rows also have the text ``f_<field>`` and ``has_<field>``, whether there is such a tag.
    """

    rows: DataFrame
    broken: list[str]


def read_elements(
    spark: SparkSession, path: str, tag: str, folder: str | None = None, fields: Sequence[str] = ()
) -> Elements:
    """Every ``tag`` element of the files that are well formed.

    One pass reads the files; its result is a written table in ``folder``. The driver gets the
    names of the broken files. Elements that hold exactly the ``fields``, in their order, are
    written as cells, others as maps; the records are the same.
    """
    folder = folder or stage_folder(spark)
    shape = _SCHEMA + "".join(f", `f_{f}` string" for f in fields)
    read = read_pieces(spark, path, f"</{tag}>").mapInArrow(_pieces_to_rows(tag, tuple(fields)), shape)
    table = staged(read, folder, "elements")
    outside = table.where(F.col("outside").isNotNull())
    dealt = outside.select("file", "block", "row", "outside").repartition("file").sortWithinPartitions("file", "block", "row")
    whole = dealt.mapInArrow(_documents, "file string, whole boolean")
    files = table.groupBy("file").agg(F.bool_or("broken").alias("broken")).join(whole, "file", "left")
    told = files.select("file", (F.col("broken") | ~F.coalesce("whole", F.lit(False))).alias("broken")).collect()
    broken = [r.file for r in told if r.broken] + empty_files(spark, path, {r.file for r in told})
    kept, plain, record = table.where(F.col("plain") | F.col("record").isNotNull()), F.col("plain"), F.col("record")
    cells = {f: F.col(f"`f_{f}`") for f in fields}
    whole_record = record
    if fields:
        whole_record = F.when(plain, F.create_map(*(c for f in fields for c in (F.lit(f), cells[f])))).otherwise(record)
    rows = kept.select(
        whole_record.alias("record"),
        F.struct("file", "block", "row").alias("_pos"),
        *(F.when(plain, c).otherwise(record[f]).alias(f"f_{f}") for f, c in cells.items()),
        *((plain | F.map_contains_key(record, f)).alias(f"has_{f}") for f in fields),
    )
    if broken:
        gone = spark.createDataFrame([(f,) for f in broken], "file string")
        rows = rows.join(F.broadcast(gone), rows["_pos.file"] == gone["file"], "left_anti")  # one line per file
    return Elements(rows, broken)
