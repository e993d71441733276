"""Importance resampling towards a target: documents drawn as if they came from it.

Texts become runs of one or two words, hashed into buckets. A bucket's gain is the logarithm of
how much more frequent it is in the target, a document's weight the mean of its gains, all looked
up in arrays. Random noise of extreme-value form is added, and the highest scores are a sample
without replacement that follows the weights.

The cutoff between drawn and other documents is found exactly, without a sort of all: in each
round every partition gives the median of its remaining keys, the median of these weighted by
the partitions' remaining rows splits the keys, and the side that can't hold the cutoff (at least
a quarter of the rows) is left out. Only the drawn rows are sorted, for their ranks.

Cases: a null text has no words, no features and weight 0. A null id counts as the largest one in
ties and as an empty text in the noise. Rows of equal score and id are ordered by their place in
the scored table. An empty table, target or share gives no drawn rows. Other columns, of any
name, pass through ``resampled`` untouched.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.common import free_name, scratch, staged, table
from recordloom.llm.words import blocks
from recordloom.operators.ordinal import with_place

BUCKETS = 10_000
SCALE = 1000  # weights and scores are whole thousandths
LEAST_WORDS = 20
SEED = 7
PERCENT = 25
#: Keys that the driver sorts itself once no more than these remain: 24 bytes each.
FEW = 4096
#: Bytes of words whose checksums a worker remembers; beyond it the memory starts anew.
REMEMBERED_BYTES = 32 << 20
_SHORT = 40  # words up to this length are joined by table, longer ones byte by byte
_LAST = 2**63 - 1


class Buckets:
    """Buckets of words and of pairs of words; checksums of pairs come from those of words.

    The checksum is linear: that of a text followed by n bytes is the text's, moved by n zero
    bytes through a table of its four bytes, and that of the n bytes, added without carry.
    """

    def __init__(self, buckets: int = BUCKETS):
        self.buckets = np.uint32(buckets)
        self.move = np.empty((_SHORT + 2, 4, 256), np.uint32)
        for n in range(_SHORT + 2):
            zeros = bytes(n)
            base = zlib.crc32(zeros)
            for k in range(4):
                self.move[n, k] = [zlib.crc32(zeros, v << 8 * k) ^ base for v in range(256)]
        self.forget()

    def forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.held = 0
        self.known = np.empty((3, 0), np.uint32)

    def _look_up(self, words: list[bytes]) -> np.ndarray:
        """Rows of (checksum, checksum behind a space, length), one column per word."""
        if self.held > REMEMBERED_BYTES:
            self.forget()
        fresh = list(set(words).difference(self.places))
        if fresh:
            space = zlib.crc32(b" ")
            new = np.array(
                [[zlib.crc32(w) for w in fresh], [zlib.crc32(w, space) for w in fresh], [len(w) for w in fresh]],
                np.uint32,
            )
            first = len(self.places)
            self.places.update(zip(fresh, range(first, first + len(fresh))))
            self.held += sum(map(len, fresh)) + 100 * len(fresh)
            self.known = np.concatenate([self.known, new], axis=1)
        at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        return self.known[:, at]

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the words, and of each word with the next one."""
        one, behind, size = self._look_up(words)
        left, gap = one[:-1], size[1:] + np.uint32(1)
        short = np.minimum(gap, _SHORT + 1)
        two = behind[1:].copy()
        for k in range(4):
            two ^= self.move[short, k, (left >> np.uint32(8 * k)) & np.uint32(255)]
        for i in np.flatnonzero(gap > _SHORT + 1).tolist():
            two[i] = zlib.crc32(b" " + words[i + 1], int(left[i]))
        return one % self.buckets, two % self.buckets


def _features(texts, maker: Buckets) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block (word buckets, their texts, pair buckets, their texts)."""
    last = None  # word and text that the block before ended with
    for words, owners in blocks(texts):
        carried = int(last is not None and last[1] == owners[0])
        if carried:
            words, owners = [last[0], *words], np.concatenate([owners[:1], owners])
        last = words[-1], owners[-1]
        one, two = maker(words)
        same = owners[1:] == owners[:-1]
        yield one[carried:], owners[carried:], two[same], owners[1:][same]


def bucket_counts(df: DataFrame, text_col: str, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; every task sends each bucket once at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for one, _, two, _ in _features(batch.column(0), maker):
                total += np.bincount(one, minlength=buckets) + np.bincount(two, minlength=buckets)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    texts = df.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket from two tables of counts, which have no more rows than buckets."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for into, counts in ((s, raw), (t, target)):
        for bucket, n in counts.collect():
            into[bucket] = n
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    made = [math.floor(SCALE * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t))) for a, b in zip(s.tolist(), t.tolist())]
    return np.array(made, np.int64)


def _noise(i: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


_SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def scored(df: DataFrame, id_col: str, text_col: str, gain: np.ndarray, seed: int = SEED, rest: bool = False) -> DataFrame:
    """One row per document with its weight and score; ``rest`` adds the whole row as ``row``."""
    size = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Buckets(size)
        for batch in batches:
            n = batch.num_rows
            words, features, total = (np.zeros(n, np.int64) for _ in range(3))
            for one, own, two, both in _features(batch.column(1), maker):
                words += np.bincount(own, minlength=n)
                for bucket, text in ((one, own), (two, both)):
                    features += np.bincount(text, minlength=n)
                    if len(text):  # texts come in order, so each one's gains are a run
                        cuts = np.flatnonzero(np.diff(text, prepend=-1))
                        total[text[cuts]] += np.add.reduceat(gain[bucket], cuts)
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            noise = np.array([_noise(i, seed) for i in batch.column(0).to_pylist()], np.int64)
            columns = [batch.column(0), *map(pa.array, (words, features, weight, weight + noise)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T._parse_datatype_string(_SCORED)
    slim = df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        *([F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")] if rest else []),
    )
    if rest:
        schema = T.StructType([*schema, slim.schema["row"]])
    names = schema.names
    return slim.mapInArrow(score, schema)


@dataclass(frozen=True, order=True)
class Key:
    """A row's place in the draw: negated score, id, number of the row. Smaller is drawn first."""

    low: int
    doc: int
    row: int


def _key_columns(rows: DataFrame) -> DataFrame:
    return rows.select((-F.col("score")).alias("low"), F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.col("place_in_table").alias("row"))


def _upto(key: Key, or_equal: bool = True):
    """Column condition that a row's key comes before ``key`` (or is it)."""
    low, doc, row = F.col("low"), F.col("doc"), F.col("row")
    end = row <= key.row if or_equal else row < key.row
    return (low < key.low) | ((low == key.low) & ((doc < key.doc) | ((doc == key.doc) & end)))


_MEDIANS = "n_before long, b_low long, b_doc long, b_row long, n_after long, a_low long, a_doc long, a_row long"


def _medians(pivot: Key | None):
    """Per partition: how many keys are up to the pivot or after it, and the median of each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        low, doc, row = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in got]) for i in range(3))
        if pivot is None:
            before = np.ones(len(low), bool)
        else:
            before = (low < pivot.low) | ((low == pivot.low) & ((doc < pivot.doc) | ((doc == pivot.doc) & (row <= pivot.row))))
        line: list[int | None] = []
        for part in (before, ~before):
            at = np.flatnonzero(part)
            line.append(len(at))
            if len(at):
                middle = at[np.lexsort((row[at], doc[at], low[at]))[(len(at) - 1) // 2]]
                line += [int(low[middle]), int(doc[middle]), int(row[middle])]
            else:
                line += [None] * 3
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in line], names=[c.split()[0] for c in _MEDIANS.split(", ")])

    return run


def cutoff(keys: DataFrame, wanted: int, few: int = FEW) -> Key | None:
    """The key of place ``wanted`` in the order of (low, doc, row), found without sorting all.

    ``keys`` must be a written table: every round reads the rows between the bounds found so far.
    The driver gets one line per partition and round, and at last no more than ``few`` keys.
    """
    if wanted <= 0:
        return None
    above: Key | None = None  # all keys up to it are drawn
    below: Key | None = None  # the wanted key is not after it
    pivot: Key | None = None
    while True:
        left = keys
        if above:
            left = left.where(~_upto(above) & (F.col("low") >= above.low))
        if below:
            left = left.where(_upto(below) & (F.col("low") <= below.low))
        lines = left.mapInArrow(_medians(pivot), _MEDIANS).collect()
        before = sum(r.n_before for r in lines)
        if pivot is None and wanted > before:
            raise ValueError(f"place {wanted} of {before} keys")
        if pivot and wanted > before:
            wanted, above = wanted - before, pivot
            medians = sorted((Key(r.a_low, r.a_doc, r.a_row), r.n_after) for r in lines if r.n_after)
        else:
            below = pivot or below
            medians = sorted((Key(r.b_low, r.b_doc, r.b_row), r.n_before) for r in lines if r.n_before)
        remaining = sum(n for _, n in medians)
        if remaining <= few:
            if above:
                keys = keys.where(~_upto(above))
            if below:
                keys = keys.where(_upto(below))
            return sorted(Key(*r) for r in keys.collect())[wanted - 1]
        seen = 0
        for pivot, n in medians:  # the weighted median of medians
            seen += n
            if 2 * seen >= remaining:
                break


def draw(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, few: int = FEW) -> DataFrame:
    """Scored rows with ``rank``: 1, 2, 3... for the drawn ones, null for the others."""
    table_ = staged(rows.withColumn("place_in_table", F.monotonically_increasing_id()))
    able = F.col("n_words") >= least_words
    keys = _key_columns(table_.where(able))
    last = cutoff(keys, percent * table_.where(able).count() // 100, few)
    keyed = table_.withColumns({"low": -F.col("score"), "doc": F.coalesce("doc_id", F.lit(_LAST)), "row_": F.col("place_in_table")})
    if last is None:
        return table_.withColumn("rank", F.lit(None).cast("long")).drop("place_in_table")
    end = (F.col("doc") < last.doc) | ((F.col("doc") == last.doc) & (F.col("row_") <= last.row))
    taken = able & ((F.col("low") < last.low) | ((F.col("low") == last.low) & end))
    won = keyed.where(taken)
    places = with_place(won.select("low", "doc", "row_") if "row" in rows.columns else won, [F.col("low"), F.col("doc"), F.col("row_")], "rank", scratch(rows.sparkSession))
    if "row" in rows.columns:  # the texts themselves need no sorting
        places = won.join(places.select("row_", "rank"), "row_")
    lost = keyed.where(~taken).withColumn("rank", F.lit(None).cast("long"))
    return places.unionByName(lost).drop("place_in_table", "low", "doc", "row_")


def _gain_of(docs: DataFrame, target: DataFrame, text_col: str, target_text: str, buckets: int) -> np.ndarray:
    return gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text, buckets), buckets)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The drawn documents, with their columns as they came and their place in a new column."""
    gain = _gain_of(docs, target, text_col, target_text, buckets)
    drawn = draw(scored(docs, id_col, text_col, gain, seed, rest=True), percent, least_words)
    return drawn.where("rank IS NOT NULL").select("row.*", F.col("rank").alias(free_name(docs, "draw_rank")))


def op13(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    gain = _gain_of(docs, table(spark, sf_dir, "benchmark"), "text", "text", BUCKETS)
    return draw(scored(docs, "doc_id", "text", gain)).select("doc_id", "n_features", "weight", "score", "rank")


# crc32 of distinct features by its table, which is made by the rule of the polynomial
OP13_SQL = r"""
WITH RECURSIVE step(v, i, c) AS (
    SELECT range, 0, range::UBIGINT FROM range(256)
    UNION ALL SELECT v, i + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END FROM step WHERE i < 8),
crc AS (SELECT list(c ORDER BY v) AS t FROM step WHERE i = 8),
texts AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
split AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
grams AS (
    SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM split),
each AS (SELECT DISTINCT f, hex(encode(f)) AS x FROM grams),
hashed AS (
    SELECT f, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, len(x) // 2 + 1),
        lambda i: (16 * (instr('0123456789ABCDEF', substr(x, 2 * i - 1, 1)) - 1) + instr('0123456789ABCDEF', substr(x, 2 * i, 1)) - 1)::UBIGINT)),
        lambda a, b: xor(a // 256, t[(xor(a, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) % 10000 AS bucket
    FROM each, crc),
tagged AS (SELECT side, id, bucket FROM grams JOIN hashed USING (f)),
totals AS (SELECT count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM tagged),
counts AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM tagged GROUP BY bucket),
gain AS (
    SELECT bucket, floor(1000 * ln(((c.t + 1) * (totals.s + 10000))::DOUBLE / ((c.s + 1) * (totals.t + 10000))::DOUBLE))::BIGINT AS g
    FROM counts c, totals),
weighed AS (SELECT id, sum(g)::BIGINT AS total, count(*) AS n FROM tagged JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
noise AS (
    SELECT id, len(w) AS n_words,
        list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 9), lambda i: (instr('0123456789abcdef', substr(sha256('7:' || id), i, 1)) - 1)::BIGINT)), lambda a, b: a * 16 + b) AS h
    FROM split WHERE side = 'd'),
scores AS (
    SELECT id AS doc_id, n_words, coalesce(n, 0)::BIGINT AS n_features,
        coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
        coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score
    FROM noise LEFT JOIN weighed USING (id)),
able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, (25 * count(*) OVER ()) // 100 AS most FROM scores WHERE n_words >= 20)
SELECT s.doc_id, n_features, weight, score, rank
FROM scores s LEFT JOIN (SELECT doc_id, rank FROM able WHERE rank <= most) a ON s.doc_id = a.doc_id
"""
