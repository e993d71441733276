"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Vectors are compared only with vectors of the same label and length. Equal vectors are counted
once. Random projections cut at random offsets give each vector a cell in each of ``tables``
tables; the projections of a linked pair differ by at most a known spread, so a pair at the
threshold misses all tables with a probability below 1e-4 (``recall``). Inside a cell the rows
are sorted by a projection; around each query a window holds the rows that can be linked, and for
these the windows of ``counted`` more projections are counted. Pairs that collide often enough,
a count that all but 1e-6 of linked pairs at the threshold reach, are verified by the cosine in
double precision.

A pair that meets in several tables counts in the first. A crowded cell is cut into tiles that
meet in pairs, so a hot vector group is spread over tasks; tiles return a count per vector and a
spanning forest of their links, not the pairs.

Cases: a null vector, one with a null, NaN or infinite component, a zero vector, and a null label
link with nothing; these are kept with no links, their own component. Vectors of equal content
are linked with each other. Rows may share an id; their links add up. Extra columns are ignored,
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import textops
from recordloom.llm.common import staged, table, whole_runs, width
from recordloom.llm.components import components

SIMILAR = 0.98
TABLES, CUTS = 16, 10
COUNTED = 32
TILE = 1024
ROWS = 4096  # of whole cells compared at a time
_SEED = 20240131


def cell_width(similar: float) -> float:
    """Of a projection to a unit direction, times the root of the length: 12 spreads of a linked pair."""
    return 12.0 * math.sqrt(2.0 - 2.0 * similar)


def recall(similar: float = SIMILAR, tables: int = TABLES, cuts: int = CUTS) -> float:
    """Chance that a pair at the threshold shares a cell: the difference of its projections is
    nearly normal, and a cut at a random offset separates it in proportion to that."""
    one = 1.0 - math.sqrt(2.0 - 2.0 * similar) * math.sqrt(2.0 / math.pi) / cell_width(similar)
    return 1.0 - (1.0 - one**cuts) ** tables


def needed(counted: int, inside: float = math.erf(2.0 / math.sqrt(2.0)), missed: float = 1e-6) -> int:
    """Largest count that all but ``missed`` of linked pairs reach, windows being two spreads wide."""
    total = 0.0
    for count in range(counted + 1):
        total += math.comb(counted, count) * inside**count * (1 - inside) ** (counted - count)
        if total > missed:
            return count
    return counted


def _directions(length: int, n: int, salt: int) -> np.ndarray:
    got = np.random.default_rng((_SEED, salt, length)).standard_normal((n, length))
    return got / np.linalg.norm(got, axis=1, keepdims=True)


def _units(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the vectors of one length, and these as rows of length one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.list_value_length(column).to_numpy()
    flat = column.flatten().to_numpy()
    starts = np.cumsum(sizes) - sizes
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        x = flat[starts[at][:, None] + np.arange(length)]
        x = x / np.abs(x).max(1, keepdims=True)
        yield at, x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(similar: float, tables: int, cuts: int):
    """Cell of every row in every table, as one array per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict = {}
        for batch in batches:
            out = np.zeros((batch.num_rows, tables), np.uint64)
            for at, x in _units(batch.column("vector")):
                length = x.shape[1]
                if length not in made:
                    wide = cell_width(similar) / math.sqrt(length)
                    made[length] = _directions(length, tables * cuts, 1), wide, np.random.default_rng((_SEED, 2, length)).random(tables * cuts) * wide
                lines, wide, shift = made[length]
                codes = np.floor((x @ lines.T + shift) / wide).astype(np.int64).view(np.uint64)
                key = np.full((len(at), tables), length, np.uint64)
                for c in range(cuts):
                    key = textops.mix(key * np.uint64(textops._BASE) + codes[:, c::cuts])
                out[at] = key
            flat = pa.array(out.view(np.int64).ravel())
            yield batch.append_column("cells", pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables), flat))

    return run


def _joined(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Puts the sets of i and j together; every entry then names the smallest of its set."""
    while True:
        a, b = parent[i], parent[j]
        if (a == b).all():
            return
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


def _links(similar: float, counted: int):
    """Links inside the cells, many cells at a time: every row meets the next one of its cell in
    the order of a projection, then the one after, until all are out of the window."""
    spread = math.sqrt(2.0 - 2.0 * similar) * (1 + 1e-9)
    least = needed(counted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict = {}
        for rows in whole_runs(batches, "cell", ROWS):
            names = ("cell", "rep", "copies", "label", "which", "chunk", "line", "column")
            held = {c: rows.column(c).to_numpy() for c in names}
            shared = rows.column("cells").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
            for at, x in _units(rows.column("vector")):
                length = x.shape[1]
                if length not in made:
                    made[length] = _directions(length, counted + 1, 3)
                places = x @ made[length].T
                order = np.lexsort((places[:, 0], held["cell"][at]))
                x, places, at = x[order], places[order], at[order]
                cell, reps, copies, label, which, chunk, line, column = (held[c][at] for c in names)
                cells, window = shared[at], spread / math.sqrt(length) * 2.0
                found, parent = np.zeros(len(x), np.int64), np.arange(len(x))
                active, step = np.arange(len(x)), 0
                while True:
                    step += 1
                    active = active[active + step < len(x)]
                    later = active + step
                    active = active[(cell[active] == cell[later]) & (places[later, 0] - places[active, 0] <= spread)]
                    if not len(active):
                        break
                    i, j = active, active + step
                    fits = (label[i] == label[j]) & ((line[i] == column[i]) | (chunk[i] != chunk[j]))
                    i, j = i[fits], j[fits]
                    close = (np.abs(places[i, 1:] - places[j, 1:]) <= window).sum(1) >= least
                    i, j = i[close], j[close]
                    near = np.einsum("ij,ij->i", x[i], x[j]) >= similar
                    i, j = i[near], j[near]
                    same = cells[i] == cells[j]  # counted where the pair meets first
                    first = same.any(1) & (same.argmax(1) == which[i])
                    i, j = i[first], j[first]
                    if len(i):
                        found[i] += copies[j]
                        found[j] += copies[i]
                        _joined(parent, i, j)
                at = np.flatnonzero(found)
                if len(at):
                    yield pa.RecordBatch.from_pydict({"a": pa.array(reps[at]), "b": pa.array([None] * len(at), pa.int64()), "n": pa.array(found[at])})
                    at = np.flatnonzero(parent != np.arange(len(x)))
                    yield pa.RecordBatch.from_pydict({"a": pa.array(reps[parent[at]]), "b": pa.array(reps[at]), "n": pa.array(np.zeros(len(at), np.int64))})

    return run


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", similar: float = SIMILAR, tables: int = TABLES, cuts: int = CUTS, counted: int = COUNTED) -> DataFrame:
    """Per row: id, n_links, component_id, kept."""
    spark = df.sparkSession
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector"), F.xxhash64(F.col(f"`{label_col}`").cast("string")).alias("label"), F.col(f"`{label_col}`").isNotNull().alias("labelled"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    good = F.col("labelled") & F.col("vector").isNotNull() & F.forall("vector", fine) & F.exists("vector", lambda x: x != 0)
    good = F.coalesce(good & F.col("id").isNotNull(), F.lit(False))
    usable = rows.where(good).select("id", "label", "vector")
    same = staged(usable.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    celled = staged(same.mapInArrow(_cells(similar, tables, cuts), "label long, vector array<double>, rep long, copies long, cells array<long>"))
    placed = celled.select("label", "vector", "rep", "copies", "cells", F.posexplode("cells").alias("which", "code"))
    placed = placed.withColumn("key", F.xxhash64("label", "which", "code"))
    crowd = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / F.lit(TILE)).cast("int")
    chunk = F.pmod(F.xxhash64("rep"), tiles).cast("int")
    met = placed.join(crowd, "key").withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    line, column = F.least("chunk", "other"), F.greatest("chunk", "other")
    met = met.select("label", "vector", "rep", "copies", "cells", "which", "chunk", line.alias("line"), column.alias("column"), F.xxhash64("key", line, column).alias("cell"))
    spread = met.repartition(width(spark), "cell").sortWithinPartitions("cell")
    out = staged(spread.mapInArrow(_links(similar, counted), "a long, b long, n long"))
    linked = out.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    own = usable.join(same.withColumnRenamed("label", "l"), (F.col("l") == F.col("label")) & (same["vector"] == usable["vector"])).select("id", "rep", "copies")
    own = staged(own)
    counts = own.join(linked, "rep", "left").groupBy("id").agg(F.sum(F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    edges = out.where("b is not null").select("a", "b").unionAll(own.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    found = components(edges).withColumnRenamed("node", "id")
    got = rows.select("id", good.alias("good")).join(counts, "id", "left").join(found, "id", "left")
    home = F.when(F.col("good"), F.coalesce("component", "id")).otherwise(F.col("id"))
    return got.select("id", F.when(F.col("good"), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"), home.alias("component_id"), (F.col("id").isNull() | (F.col("id") == home)).alias("kept"))


def op10(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


OP10_SQL = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), home AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN home USING (vec_id) LEFT JOIN n USING (vec_id)
"""
