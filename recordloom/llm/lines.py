"""Repeated lines are dropped from all documents but one, with two Bloom filters as a sieve.

Every line's key is hashed once. A task gathers the places that its hashes set in a filter of
once-seen hashes, and those of hashes it saw twice; only these places travel, a few bytes a line.
Where the places of two tasks meet, a bit of the filter of twice-seen hashes is set. A hash with
all its bits in that filter may repeat, and only such suspects are shuffled: their digests are
counted exactly, and the largest id that holds one keeps it. A filter can only suspect too much,
so no repeat is missed whatever its size.

A filter is cut into slices, each sized by the places set in it, up to ``SLICE_BITS``. So what is
broadcast, the twice-seen filter, has at most ``SLICES * SLICE_BITS / 8`` bytes (64 MB). Beyond
about a hundred million different lines it fills up and more and more lines are suspects, which
costs shuffled digests (60 bytes for each block and line) but changes no result.

Documents are numbered in blocks of rows. A key that many documents share is counted once a block
before it is shuffled, and what is to be dropped comes back to the blocks, not to single keys, so
a line that a third of all documents hold makes no long group.

Cases: a null or empty text is one empty line. Rows are documents of their own: the copies of a
row with the largest id all keep the line, and each counts. A null id is the smallest. Keys are
told apart by their SHA-256. An empty table gives an empty result. Other columns pass through
``deduplicated`` untouched, of any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.common import free_name, runs, staged, table, width

LEAST = 20  # code points of a key that may be dropped
DOCUMENTS = 3  # documents that must hold it
SLICES = 128
SLICE_BITS = 1 << 22
PROBES = 3
ROOM = 4  # bits of a slice for each place set in it
BLOCK_ROWS = 512
LONG_TEXT = 1 << 17  # a text with more code points is a block of its own
_SPACE = b" \t\n\x0b\x0c\r"
_SPAN = SLICES * SLICE_BITS


def keys(data: bytes) -> Iterator[tuple[bytes, bytes | None]]:
    """(line, its key or None where it may not be dropped) for each line of a text."""
    for line in data.split(b"\n"):
        key = line.strip(_SPACE).lower()
        yield line, key if len(key) >= LEAST and (key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= LEAST) else None


def places(hashes: np.ndarray) -> np.ndarray:
    """Places of 64-bit hashes in the full span of a filter, one row per probe."""
    high, low = hashes >> np.uint64(32), (hashes & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return np.stack([(high + np.uint64(i) * low) % np.uint64(_SPAN) for i in range(PROBES)]).astype(np.int64)


def _hashes(digests: list[bytes]) -> np.ndarray:
    """The first eight bytes of each digest."""
    whole = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
    return np.ascontiguousarray(whole[:, :8]).view("<u8").ravel()


def _with_digests(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows in blocks, each with the digests of its different keys; a written table."""
    row = F.monotonically_increasing_id()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # the low 33 bits count the rows of a partition, so blocks don't cross partitions
    block = F.when(F.length(text) > LONG_TEXT, -1 - row).otherwise(F.shiftright(row, BLOCK_ROWS.bit_length() - 1))
    slim = df.select(block.alias("block"), F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), F.struct(*(F.col(f"`{c}`") for c in df.columns if c != text_col)).alias("rest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                list({hashlib.sha256(k).digest() for _, k in keys(text.encode("utf-8", "surrogatepass")) if k is not None})
                for text in batch.column(2).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.binary()))], names=[*batch.schema.names, "digests"])

    return staged(slim.mapInArrow(run, T.StructType([*slim.schema, T.StructField("digests", T.ArrayType(T.BinaryType()))])))


_PLACES = "slice int, once binary, twice binary"


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's places by slice: those of all its hashes, and those of hashes it has repeatedly."""
    held = [h for batch in batches for h in [_hashes(batch.column(0).flatten().to_pylist())] if len(h)]
    if not held:
        return
    seen, times = np.unique(np.concatenate(held), return_counts=True)
    once, twice = (np.unique(places(h)) for h in (seen, seen[times > 1]))
    cuts = np.arange(SLICES + 1) * SLICE_BITS
    rows: list[tuple] = []
    ends = zip(np.searchsorted(once, cuts[:-1]), np.searchsorted(once, cuts[1:]), np.searchsorted(twice, cuts[:-1]), np.searchsorted(twice, cuts[1:]))
    for i, (a, b, c, d) in enumerate(ends):
        if b > a:
            rows.append((i, *((p - cuts[i]).astype("<u4").tobytes() for p in (once[a:b], twice[c:d]))))
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["slice", "once", "twice"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both filters of each slice from all tasks' places; gives the bits of the second."""
    for part in runs(batches, "slice"):
        ones, twos = part.column("once"), part.column("twice")
        total = sum(len(x.as_py()) // 4 for x in ones)
        bits = 1024
        while bits < min(ROOM * total, SLICE_BITS):
            bits *= 2
        shrink = SLICE_BITS // bits
        once, twice = np.zeros(bits, bool), np.zeros(bits, bool)
        for one, two in zip(ones, twos):
            at = np.unique(np.frombuffer(one.as_py(), "<u4") // shrink)
            twice[at[once[at]]] = True
            once[at] = True
            twice[np.frombuffer(two.as_py(), "<u4") // shrink] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array([part.column("slice")[0].as_py()], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.binary())], names=["slice", "bits"]
        )


class Twice:
    """The filter of twice-seen hashes."""

    def __init__(self, slices: dict[int, bytes]):
        empty = bytes(128)
        parts = [slices.get(i, empty) for i in range(SLICES)]
        self.shrink = np.array([SLICE_BITS // (8 * len(p)) for p in parts])
        self.first = np.cumsum([0, *(8 * len(p) for p in parts[:-1])])
        self.bits = np.frombuffer(b"".join(parts), np.uint8)

    def __contains__(self, hash_: int) -> bool:
        return bool(self.holds(np.array([hash_], np.uint64))[0])

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = places(hashes)
        piece = at // SLICE_BITS
        bit = self.first[piece] + at % SLICE_BITS // self.shrink[piece]
        return ((self.bits[bit >> 3] >> (7 - (bit & 7))) & 1).all(axis=0)


def twice_seen(digests: DataFrame) -> Twice:
    """The filter over a table of digest lists, one list per document without repeats."""
    gathered = digests.select("digests").mapInArrow(_gather, _PLACES)
    wide = min(width(digests.sparkSession), SLICES)
    merged = gathered.repartition(wide, "slice").sortWithinPartitions("slice").mapInArrow(_merge, "slice int, bits binary")
    return Twice({r["slice"]: bytes(r["bits"]) for r in merged.collect()})  # SLICES lines


_SUSPECT = "block long, digest binary, n long, largest long"


def _suspects(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice: Twice = known.value
        for batch in batches:
            lists = batch.column(2)
            digests = lists.flatten().to_pylist()
            if not digests:
                continue
            rows = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            at = np.flatnonzero(twice.holds(_hashes(digests)))
            blocks, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found: dict[tuple[int, bytes], list] = {}
            for i, row in zip(at.tolist(), rows[at].tolist()):
                entry = found.setdefault((blocks[row], digests[i]), [0, None])
                entry[0] += 1
                if ids[row] is not None and (entry[1] is None or ids[row] > entry[1]):
                    entry[1] = ids[row]
            if found:
                columns = [[k[0] for k in found], [k[1] for k in found], [v[0] for v in found.values()], [v[1] for v in found.values()]]
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["block", "digest", "n", "largest"])

    return run


def _to_drop(rows: DataFrame, documents: int) -> DataFrame:
    """(block, digest, keeper): repeated keys of each block, and the largest id that holds them."""
    filter_ = rows.sparkSession.sparkContext.broadcast(twice_seen(rows))
    suspects = staged(rows.select("block", "id", "digests").mapInArrow(_suspects(filter_), _SUSPECT))
    repeats = suspects.groupBy("digest").agg(F.sum("n").alias("all"), F.max("largest").alias("keeper")).where(F.col("all") >= documents)
    # a key of many blocks is met in as many tasks as there are salts
    salts = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt")
    salted = repeats.select("digest", "keeper", salts)
    here = suspects.select("block", "digest", F.pmod(F.xxhash64("block"), F.lit(16)).cast("int").alias("salt"))
    return here.join(salted, ["digest", "salt"]).select("block", "digest", "keeper")


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents: int = DOCUMENTS) -> DataFrame:
    """The rows of ``df`` with their other columns, ``text_col`` without repeated lines, and two new
    columns: lines before, and lines dropped."""
    rows = _with_digests(df, id_col, text_col)
    drop = _to_drop(rows, documents)
    count, gone = free_name(df, "n_lines"), free_name(df, "n_dropped")
    slim = rows.select("block", "id", "text", "rest")
    schema = T.StructType([*slim.schema.fields[1:], T.StructField(count, T.LongType()), T.StructField(gone, T.LongType())])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        keeper = dict(zip(right.column("digest").to_pylist(), right.column("keeper").to_pylist()))
        texts, lines, dropped = [], [], []
        for i, text in zip(left.column("id").to_pylist(), left.column("text").to_pylist()):
            kept, n = [], 0
            for line, key in keys(text.encode("utf-8", "surrogatepass")):
                n += 1
                digest = hashlib.sha256(key).digest() if key is not None and keeper else None
                if digest not in keeper or keeper[digest] == i:
                    kept.append(line)
            texts.append(b"\n".join(kept).decode("utf-8", "surrogatepass"))
            lines.append(n)
            dropped.append(n - len(kept))
        return pa.table([left.column("id"), pa.array(texts, pa.string()), left.column("rest"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=schema.names)

    got = slim.groupBy("block").cogroup(drop.groupBy("block")).applyInArrow(cut, schema)
    others = [F.col("text").alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in df.columns]
    return got.select(*others, count, gone)


def op11(spark, sf_dir: str) -> DataFrame:
    got = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
repeats AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone FROM keyed k LEFT JOIN repeats r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
