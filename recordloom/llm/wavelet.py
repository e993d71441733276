"""Token files: a wavelet matrix per shard.

Documents are encoded whole, in ascending id order, with an end id after each. A shard holds
about ``SHARD`` ids as bit-planes, highest bit first; each plane orders the ids stably by the bit
above it, so one plane per bit suffices for the id at a place, the count of an id in a range
and the place of its k-th occurrence. Planes carry a directory of counts and are compressed one
by one, all in one block of bytes that starts with a table of documents. A file is one such
block; they are stored as rows of a Parquet table, since that is what every store that Spark
reaches can write and read, and ``WaveletMatrix.from_bytes`` opens a block anywhere.

Cases: a null text is empty, its document is the end id alone. Null ids come first; equal ids
follow one another, ordered by text. A document is never cut, so one longer than a shard makes
a larger shard. Extra columns are ignored. An empty table gives no files and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm import tokens
from recordloom.llm.common import scratch, table, width

SHARD = 1 << 20
END = 2
_BLOCK = 512  # bits between two entries of a plane's directory
_MAGIC = b"RLWM1\0"


class WaveletMatrix:
    """Succinct sequence of unsigned integers below ``2**levels``."""

    def __init__(self, size: int, planes: list[np.ndarray], ids: np.ndarray, bounds: np.ndarray):
        """planes: packed bits, highest first; ids and bounds: the documents and where they start."""
        self.size, self.planes, self.ids, self.bounds = size, planes, ids, bounds
        self.counts = [self._directory(p) for p in planes]
        self.zeros = [size - int(c[-1]) for c in self.counts]

    @staticmethod
    def _directory(plane: np.ndarray) -> np.ndarray:
        step = _BLOCK // 8
        padded = np.zeros(-(-len(plane) // step) * step, np.uint8)
        padded[: len(plane)] = plane
        per = np.bitwise_count(padded.reshape(-1, step)).sum(1, dtype=np.int64)
        return np.concatenate([[0], np.cumsum(per)]).astype(np.uint32)

    @classmethod
    def build(cls, values: np.ndarray, levels: int, ids=None, bounds=None) -> WaveletMatrix:
        if len(values) and int(values.max()) >> levels:
            raise ValueError(f"id {int(values.max())} doesn't fit into {levels} levels")
        kind = np.uint16 if levels <= 16 else np.uint32
        rest, planes = values.astype(kind), []
        for level in range(levels):
            bit = (rest & kind(1 << (levels - 1 - level))) != 0
            planes.append(np.packbits(bit))
            rest = rest.take(np.concatenate([np.flatnonzero(~bit), np.flatnonzero(bit)]))
        none = np.empty(0, np.int64)
        return cls(len(values), planes, none if ids is None else ids, np.array([0, len(values)]) if bounds is None else bounds)

    def _bit(self, level: int, i: int) -> int:
        return (int(self.planes[level][i >> 3]) >> (7 - (i & 7))) & 1

    def _ones(self, level: int, i: int) -> int:
        """Set bits of a plane before place i."""
        block = i // _BLOCK
        part = self.planes[level][block * (_BLOCK // 8) : (i + 7) >> 3]
        n = int(self.counts[level][block])
        if len(part):
            n += int(np.bitwise_count(part[:-1]).sum()) + int(int(part[-1]) >> (-i & 7)).bit_count()
        return n

    def access(self, i: int) -> int:
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value = value * 2 + bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _narrow(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(len(self.planes)):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if value >> (len(self.planes) - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        if value >> len(self.planes):
            return 0
        lo, hi = self._narrow(value, lo, self.size if hi is None else hi)
        return hi - lo

    def select(self, value: int, k: int) -> int:
        """Place of the k-th occurrence, from 0."""
        lo, hi = self._narrow(value, 0, self.size) if not value >> len(self.planes) else (0, 0)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level in reversed(range(len(self.planes))):
            one = value >> (len(self.planes) - 1 - level) & 1
            i = self._place(level, i - self.zeros[level], True) if one else self._place(level, i, False)
        return i

    def _place(self, level: int, k: int, one: bool) -> int:
        """Place of a plane's k-th set or clear bit: directory first, then one block."""
        edges = np.arange(len(self.counts[level]), dtype=np.int64) * _BLOCK
        before = self.counts[level].astype(np.int64) if one else edges - self.counts[level]
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * (_BLOCK // 8) : (block + 1) * (_BLOCK // 8)])
        return block * _BLOCK + int(np.flatnonzero(bits == one)[k - int(before[block])])

    def values(self) -> np.ndarray:
        """All ids at once, from the lowest plane up."""
        levels = len(self.planes)
        kind = np.uint16 if levels <= 16 else np.uint32
        out = np.zeros(self.size, kind)
        for level in reversed(range(levels)):
            bit = np.unpackbits(self.planes[level], count=self.size).view(bool)
            above = np.empty_like(out)
            zeros = self.zeros[level]
            above[np.flatnonzero(~bit)] = out[:zeros]
            above[np.flatnonzero(bit)] = out[zeros:] | kind(1 << (levels - 1 - level))
            out = above
        return out

    def to_bytes(self) -> bytes:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        parts = [squeeze(x.tobytes()) for x in (self.ids.astype("<i8"), self.bounds.astype("<i8"), *self.planes)]
        head = _MAGIC + struct.pack("<QQQ", self.size, len(self.ids), len(self.planes)) + struct.pack(f"<{len(parts)}Q", *map(len, parts))
        return head + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        import zstandard

        if data[: len(_MAGIC)] != _MAGIC:
            raise ValueError("not a token file")
        size, docs, levels = struct.unpack_from("<QQQ", data, len(_MAGIC))
        at = len(_MAGIC) + 24
        lengths = struct.unpack_from(f"<{levels + 2}Q", data, at)
        at += 8 * len(lengths)
        parts, open_ = [], zstandard.ZstdDecompressor().decompress
        for n in lengths:
            parts.append(open_(data[at : at + n]))
            at += n
        planes = [np.frombuffer(p, np.uint8) for p in parts[2:]]
        return cls(size, planes, np.frombuffer(parts[0], "<i8"), np.frombuffer(parts[1], "<i8"))


def levels_of(path: str) -> int:
    """Planes that hold every id of a vocabulary file and the end id."""
    return max(len(tokens.encoder(path).opens) - 1, END).bit_length()


def _write(path: str, levels: int, shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, base = TaskContext.get().partitionId(), 0, 0
        encoder = tokens.encoder(path)
        ids: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def flush():
            bounds = np.cumsum([0, *map(len, held)])
            docs = np.array([0 if i is None else i for i in ids], np.int64)
            data = WaveletMatrix.build(np.concatenate(held), levels, docs, bounds).to_bytes()
            nulls = sum(i is None for i in ids)  # they come first
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "base": pa.array([base], pa.int64()), "size": pa.array([size], pa.int64()), "nulls": pa.array([nulls], pa.int64()), "content": pa.array([data], pa.binary())}
            )

        end = np.array([END], "<u4")
        for batch in batches:
            doc_ids = batch.column("id").to_pylist()
            for lo, texts in tokens.small_parts(batch.column("text")):
                for i, x in enumerate(encoder.encode(texts)):
                    ids.append(doc_ids[lo + i])
                    held.append(np.concatenate([x, end]))
                    size += len(x) + 1
                    if size >= shard:
                        yield flush()
                        block, base, size, ids, held = block + 1, base + size, 0, [], []
        if held:
            yield flush()

    return run


def write_files(df: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD, levels: int | None = None, partitions: int | None = None) -> None:
    """Token files of a corpus as rows (part, block, base, size, nulls, content) under ``folder``.

    There are as many ``levels`` as the vocabulary needs; an id beyond stated ones fails the job.
    """
    levels = levels or levels_of(path)
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    ordered = slim.repartitionByRange(partitions or width(df.sparkSession), "id").sortWithinPartitions("id", "text")
    schema = "part int, block int, base long, size long, nulls long, content binary"
    ordered.mapInArrow(_write(path, levels, shard), schema).write.option("compression", "none").parquet(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            matrix = WaveletMatrix.from_bytes(batch.column("content")[row].as_py())
            ids, bounds = matrix.values().astype("<u4"), matrix.bounds.tolist()
            docs = matrix.ids.tolist()
            for k in range(batch.column("nulls")[row].as_py()):
                docs[k] = None
            n, base = len(docs), batch.column("base")[row].as_py()
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(docs, pa.int64()),
                    "part": pa.array([batch.column("part")[row].as_py()] * n, pa.int32()),
                    "at": pa.array([base + b for b in bounds[:-1]], pa.int64()),
                    "n_tokens": pa.array(np.diff(matrix.bounds), pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in zip(bounds, bounds[1:])], pa.int64()),
                }
            )


def read_files(spark, folder: str) -> DataFrame:
    """Per document: id, start, n_tokens, ids_crc32, all from the files."""
    files = spark.read.parquet(folder)
    docs = files.mapInArrow(_read, "id long, part int, at long, n_tokens long, ids_crc32 long")
    # one row per partition that wrote files
    sizes = files.groupBy("part").agg(F.sum("size").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return docs.join(F.broadcast(starts), "part").select("id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op2(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch(spark)
    write_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_files(spark, folder).withColumnRenamed("id", "doc_id")
