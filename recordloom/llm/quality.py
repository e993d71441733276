"""Quality by nearest neighbours in a latent space.

Terms of a text are its hashed words, hashed n-grams of its byte classes (letters by case, digits,
white space, single marks, bytes beyond ASCII) and of its rhythm of words (repeats of the word
before and of the one before that, lengths). Term shares, weighted by rarity, are projected by
the leading singular vectors of the labelled texts. Every text is compared with every labelled
vector by exact cosine products, in blocks; the nearest vote with a weight that grows with
similarity.

The model is fitted on at most ``LABELLED`` labelled texts, one an id, the first in a hash order
of their ids. Products of their terms are summed in tasks; the driver gets the sums, a square
matrix of ``TERMS``, and the labelled vectors of ``RANK`` numbers. A matrix of ``TERMS`` by
``RANK`` and these vectors are all that is broadcast. Scoring reads the text alone, whole.

Cases: texts without terms (null, empty) get the mean label. Rows with a null label teach
nothing; without any labelled text the score is 1. A null id is not held out. Of several texts of
one labelled id the least one teaches. Ids that repeat are scored row by row; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import textops
from recordloom.llm.common import staged, table

#: Places and weights of hashed words, byte classes and rhythm.
PLACES = {"words": (512, 0.3), "classes": (512, 1.0), "rhythm": (512, 1.0)}
TERMS = sum(size for size, _ in PLACES.values())
RANK = 64
LABELLED = 4000
NEAREST = 25
SHARPNESS = 8
KEEP = 0.3
TASKS = 8  # that sum products; each holds a square matrix of ``TERMS``
_ROWS = 64

_CLASS = np.full(256, 31, np.uint64)
for _i, _span in enumerate((range(97, 123), range(65, 91), range(48, 58), range(128, 256))):
    _CLASS[list(_span)] = _i
for _i, _mark in enumerate(b" \n.,!?#%&$*|-_/@=<>;:'\"()", 4):
    _CLASS[_mark] = min(_i, 30)


def _counted(code: np.ndarray, doc: np.ndarray, docs: int, places: int, seed: int) -> np.ndarray:
    """Per text the shares of its codes over ``places`` hashed places."""
    at = (textops.mix(code + np.uint64(seed)) % np.uint64(places)).astype(np.int64)
    out = np.bincount(doc * places + at, minlength=docs * places).reshape(-1, places).astype(np.float32)
    return out / np.maximum(out.sum(1, keepdims=True), 1)


def term_shares(texts: list[bytes], cache: dict, places: dict[str, tuple[int, float]] = PLACES) -> np.ndarray:
    """Weighted square roots of the shares of each text's terms; zeros for texts without any."""
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = {"classes": none, "rhythm": none}
    kinds = _CLASS[np.frombuffer(b"".join(texts), np.uint8)]
    if len(kinds) >= 4:
        doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        code = ((kinds[:-3] * np.uint64(32) + kinds[1:-2]) * np.uint64(32) + kinds[2:-1]) * np.uint64(32) + kinds[3:]
        inside = doc[:-3] == doc[3:]
        codes["classes"] = code[inside], doc[:-3][inside]
    words = textops.Words(texts, cache)
    h, d = words.hashes, words.doc
    codes["words"] = h, d
    if len(h):
        back = lambda k: np.concatenate([np.zeros(min(k, len(h)), bool), (h[k:] == h[:-k]) & (d[k:] == d[:-k])])
        long = np.minimum(words.ends - words.starts, 15).astype(np.uint64)
        state = long * np.uint64(4) + back(1) * np.uint64(2) + back(2)
        same = d[:-1] == d[1:]
        codes["rhythm"] = (state[:-1] * np.uint64(64) + state[1:])[same], d[:-1][same]
    parts = enumerate(places.items())
    return np.hstack([np.sqrt(_counted(*codes[name], len(texts), size, seed)) * np.float32(weight) for seed, (name, (size, weight)) in parts])


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache: dict = {}
    for batch in batches:
        for first, texts in textops.chunks(batch.column("text")):
            rows = term_shares(texts, cache)
            yield pa.RecordBatch.from_arrays([batch.column("quality").slice(first, len(texts)), pa.array([r.tobytes() for r in rows], pa.binary())], names=["quality", "shares"])


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and, by term, texts that have it, of a task's rows."""
    texts, seen = 0, np.zeros(TERMS, np.int64)
    for batch in batches:
        shares = _matrix(batch.column("shares"))
        texts, seen = texts + len(shares), seen + (shares > 0).sum(0)
    if texts:
        yield pa.RecordBatch.from_pydict({"texts": pa.array([texts], pa.int64()), "seen": pa.array([seen.tobytes()], pa.binary())})


def _products(rarity: np.ndarray):
    """Sums of a task's products of terms, in blocks of rows of the square matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((TERMS, TERMS))
        for batch in batches:
            shares = _matrix(batch.column("shares"))
            for lo in range(0, len(shares), 512):
                part = (shares[lo : lo + 512] * rarity).astype(np.float64)
                gram += part.T @ part
        if gram.any():
            for lo in range(0, TERMS, _ROWS):
                yield pa.RecordBatch.from_pydict({"block": pa.array([lo], pa.int32()), "sums": pa.array([gram[lo : lo + _ROWS].tobytes()], pa.binary())})

    return run


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    sums = np.sum([np.frombuffer(x) for x in rows["sums"].sort_values()], axis=0)
    return pd.DataFrame({"block": rows["block"][:1], "sums": [sums.tobytes()]})


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1)


class Model:
    def __init__(self, rarity, axes, vectors, labels):
        self.rarity, self.axes, self.vectors, self.labels = rarity, axes, vectors, labels

    @classmethod
    def fit(cls, shares: DataFrame) -> Model:
        """From rows (quality, shares), few enough for ``TASKS`` tasks."""
        shares = shares.coalesce(TASKS)
        counts = shares.mapInArrow(_seen, "texts long, seen binary").collect()
        if not counts:
            return cls(None, None, None, np.empty(0, np.float32))
        seen = np.sum([np.frombuffer(r.seen, np.int64) for r in counts], axis=0)
        rarity = np.log((1 + sum(r.texts for r in counts)) / (1 + seen)).astype(np.float32) + 1
        blocks = shares.mapInArrow(_products(rarity), "block int, sums binary").groupBy("block").applyInPandas(_summed, "block int, sums binary").collect()
        gram = np.concatenate([np.frombuffer(r.sums) for r in sorted(blocks, key=lambda r: r.block)]).reshape(TERMS, TERMS)
        axes = np.ascontiguousarray(np.linalg.eigh(gram)[1][:, ::-1][:, :RANK].astype(np.float32))
        model = cls(rarity, axes, None, None)

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    rows = model.project(_matrix(batch.column("shares")))
                    yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["quality", "vector"])

        rows = sorted((r.vector, r.quality) for r in shares.mapInArrow(project, "quality double, vector binary").toLocalIterator())
        model.vectors = np.frombuffer(b"".join(v for v, _ in rows), np.float32).reshape(-1, RANK)
        model.labels = np.array([q for _, q in rows], np.float32)
        return model

    def project(self, shares: np.ndarray) -> np.ndarray:
        z = (shares * self.rarity) @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, shares: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.ones(len(shares))
        out = np.empty(len(shares))
        k = min(NEAREST, len(self.labels))
        for lo in range(0, len(shares), 256):
            near = self.project(shares[lo : lo + 256]) @ self.vectors.T
            best = np.argpartition(near, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(near, best, 1), 0).astype(np.float64) ** SHARPNESS
            votes = (weight * self.labels[best]).sum(1)
            total = weight.sum(1)
            out[lo : lo + 256] = np.where(total > 1e-12, votes / np.maximum(total, 1e-12), self.labels.mean())
        out[~(shares > 0).any(1)] = self.labels.mean()
        return np.clip(out, 0.0, 1.0)


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = LABELLED) -> Model:
    """``most`` bounds the labelled texts, and so all that reaches the driver and executors."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("double").alias("quality"))
    chosen = chosen.where("id is not null and quality is not null").where(~held_out("id"))
    chosen = chosen.groupBy("id").agg(F.max("quality").alias("quality"))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    present = texts.select("id").join(chosen, "id", "left_semi").distinct().orderBy(F.xxhash64("id"), "id").limit(most)
    sample = staged(present.join(chosen, "id"))
    texts = texts.join(F.broadcast(sample), "id").groupBy("id").agg(F.max("quality").alias("quality"), F.min("text").alias("text"))
    return Model.fit(staged(texts.select("quality", "text").mapInArrow(_shares, "quality double, shares binary")))


def scored(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", rest: bool = False) -> DataFrame:
    """id and score per row; with ``rest`` the row as it came and its score."""
    shipped = df.sparkSession.sparkContext.broadcast((model.rarity, model.axes, model.vectors, model.labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = Model(*shipped.value), {}
        for batch in batches:
            column = batch.column("row").field(place) if rest else batch.column("text")
            got = [own.score(term_shares(texts, cache)) for _, texts in textops.chunks(column)]
            kept = [batch.column(c) for c in batch.schema.names if c != "text"]
            if got:
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(got))], names=[*(c for c in batch.schema.names if c != "text"), "score"])

    if rest:  # the text goes to the workers once, inside its row
        place = df.columns.index(text_col) if text_col in df.columns else [c.lower() for c in df.columns].index(text_col.lower())
        whole = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
        shape = df.select(whole, F.lit(0.0).alias("score")).schema
        return df.select(whole).mapInArrow(run, shape)
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "id long, score double")


def op8(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return got.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))
