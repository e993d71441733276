"""Best-fit packing with hierarchical residuals.

Documents become pieces of at most ``capacity`` ids. Pieces are dealt out by hash, so every
partition sees the corpus's mix of lengths, and packed there best-fit, longest first. Bins that
are nearly full are done. Underfull bins become items of the next round: groups of partitions,
``fan`` at a time, pack them best-fit again, up to one group.

Two bins that were packed together never fit together afterwards, so every partition has at most
one bin that is half empty or more, and only these bins, at most one a partition, can still move
into another. Each needs one host, and the emptiest bins of a group take whatever others take;
so a round that passes on the emptiest bins of a group, as many as there are partitions, loses
nothing, and no group's size grows with the corpus.

Cases: a null or empty text is the end id alone. Documents of up to ``capacity`` ids are never
cut; longer ones are cut so that only their first piece may be shorter. Rows may repeat and ids
may be null; each row is packed. Extra columns are ignored. An empty table gives no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import tokens
from recordloom.llm.common import staged, table, width

CAPACITY = 1024
END = 2
FAN = 8
NEARLY = 8  # free places of a bin that is done
#: Bytes that a worker's remembered pieces may take: less than in ``tokens``, as other stages share its memory.
REMEMBERED = 64 << 20
_FULL = 1 << 62  # marks the bins of pieces that fill a sequence


def _cut(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, bin_ = tokens.encoder(path, REMEMBERED), _FULL + (TaskContext.get().partitionId() << 36)
        end = np.array([END], "<u4")
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for lo, texts in tokens.small_parts(batch.column("text")):
                rows = []
                for i, x in enumerate(encoder.encode(texts)):
                    x = np.concatenate([x, end])
                    first = len(x) % capacity or min(len(x), capacity)
                    for piece, start in enumerate([0, *range(first, len(x), capacity)]):
                        part = x[start : first if piece == 0 else start + capacity]
                        if len(part) == capacity:
                            bin_ += 1
                        rows.append((ids[lo + i], piece, start, len(part), zlib.crc32(part), bin_ if len(part) == capacity else None, part.tobytes() if with_ids else None))
                if rows:
                    cols = list(zip(*rows))
                    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                    names = ["id", "piece", "start", "length", "ids_crc32", "bin", "ids"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
        tokens.give_back()

    return run


class BestFit:
    """Open bins by free places; the fullest that still takes an item gets it."""

    def __init__(self, capacity: int):
        self.capacity, self.free, self.mask = capacity, [[] for _ in range(capacity + 1)], 0

    def put(self, length: int, fresh: int) -> tuple[int, int]:
        """Bin and offset of an item; a new bin is called ``fresh``."""
        fits = self.mask >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            bin_ = self.free[room].pop()
            if not self.free[room]:
                self.mask &= ~(1 << room)
        else:
            room, bin_ = self.capacity, fresh
        if room > length:
            self.free[room - length].append(bin_)
            self.mask |= 1 << (room - length)
        return bin_, self.capacity - room


def _pack(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins, fresh = BestFit(capacity), TaskContext.get().partitionId() << 36
        for batch in batches:
            placed = []
            for length in batch.column("length").to_pylist():
                fresh += 1
                placed.append(bins.put(length, fresh))
            if placed:
                got, offsets = zip(*placed)
                yield batch.set_column(batch.schema.get_field_index("bin"), "bin", pa.array(got, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return run


def _merge(capacity: int, carry: int, nearly: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["fill", "bin"], ascending=[False, True])
        bins, fill = BestFit(capacity), {}
        hosts, bases = [], []
        for bin_, length in zip(rows["bin"].tolist(), rows["fill"].tolist()):
            host, base = bins.put(length, bin_)
            hosts.append(host)
            bases.append(base)
            fill[host] = base + length
        out = pd.DataFrame({"bin": rows["bin"], "host": hosts, "base": bases, "home": rows["home"]})
        out["fill"] = [fill[b] if b == h else 0 for b, h in zip(out["bin"], hosts)]
        own = out[(out["bin"] == out["host"]) & (out["fill"] < capacity - nearly)].sort_values(["fill", "bin"])
        out["on"] = out["bin"].isin(own["bin"].head(carry))
        return out

    return run


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, partitions: int | None = None, fan: int = FAN, carry: int | None = None, nearly: int = NEARLY, with_ids: bool = False) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence, offset, and its ids if asked for.

    ``carry`` bounds the bins that a group passes on; as many as partitions are enough.
    """
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = "id long, piece int, start long, length long, ids_crc32 long, bin long, ids binary"
    pieces = staged(slim.mapInArrow(_cut(path, capacity, with_ids), schema))
    parts = partitions or width(df.sparkSession)
    short = pieces.where("bin is null").repartition(parts, F.xxhash64("id", "piece", "ids_crc32", "length"))
    short = short.sortWithinPartitions(F.col("length").desc(), "id", "piece", "ids_crc32")
    local = staged(short.mapInArrow(_pack(capacity), f"{schema}, offset long"))
    bins = local.groupBy("bin").agg(F.sum("length").alias("fill")).where(F.col("fill") < capacity - nearly)
    bins = bins.withColumn("home", F.shiftright("bin", 36))
    moved = None
    groups = parts
    while groups > 1:
        groups = -(-groups // fan)
        bins = bins.withColumn("home", F.floor(F.col("home") / F.lit(fan)))
        done = staged(bins.groupBy("home").applyInPandas(_merge(capacity, carry or parts, nearly), "bin long, host long, base long, home long, fill long, on boolean"))
        step = done.where("bin <> host").select("bin", "host", "base")
        if moved is None:
            moved = step
        else:
            later = step.select(F.col("bin").alias("host"), F.col("host").alias("to"), F.col("base").alias("by"))
            moved = moved.join(later, "host", "left").select("bin", F.coalesce("to", "host").alias("host"), (F.col("base") + F.coalesce("by", F.lit(0))).alias("base")).unionByName(step)
        bins = done.where("on").select("bin", "fill", "home")
    if moved is not None:
        local = local.join(staged(moved), "bin", "left").withColumn("offset", F.col("offset") + F.coalesce("base", F.lit(0))).withColumn("bin", F.coalesce("host", "bin"))
    full = pieces.where("bin is not null").withColumn("offset", F.lit(0).cast("long"))
    keep = ["id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence"), "offset", *["ids"] * with_ids]
    return local.select(*keep).unionByName(full.select(*keep))


def sequences(packed: DataFrame) -> DataFrame:
    """Rows of ``pack(with_ids=True)`` as sequences: sequence, length, ids (little-endian u32)."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` entries
    joined = F.aggregate(inside, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence").agg(F.sum("length").alias("length"), joined.alias("ids"))


def op5(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    got = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return got.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", F.col("sequence").alias("sequence_id"), "offset")
