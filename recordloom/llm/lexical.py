"""Ranked lexical search with no random access: lists read in order of impact, intervals per document.

The terms of a block of queries are the only ones that matter, so one scan of the corpus keeps,
per document, its length and its counts of these terms. Document frequencies and the mean length
come from that table. Then the documents are searched batch by batch: a term's entries are sorted
by their impact and read from the top, a few more each round. What a document has gained so far
is the lower end of its score; the upper end adds, for each of its terms not met yet, the impact
next in that term's list. Reading goes on until every document whose upper end reaches the k-th
best lower end has a known score, so members, ties and scores are final. Every batch's best rows
are then ranked together.

Queries are taken in blocks whose number of terms is bounded, whatever their number, so what is
broadcast is bounded by ``QUERY_TERMS`` and one query's terms.

Cases: a null or empty text has no terms and is never found; a query without terms finds nothing.
Rows are documents of their own, also where an id repeats; a null id comes after all others in
ties. A repeated or null query id is a query of its own per row. Only documents with a score above
0 are given. Empty tables give an empty result. Extra columns, of any name, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import staged, table
from recordloom.llm.words import blocks

BEST = 10
#: Terms of all queries together that one scan of the corpus serves; a longer query is a block alone.
QUERY_TERMS = 500_000
#: Entries of each list that the first round reads; every round reads as many again as all before.
FIRST_READ = 32
#: Terms times documents whose intervals are held at once in a task.
CELLS = 1 << 21


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(query, item, terms): a number per row, its id, its different terms in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[set] = [set() for _ in range(batch.num_rows)]
            for words, owners in blocks(batch.column(2)):
                for word, i in zip(words, owners.tolist()):
                    found[i].add(word)
            terms = pa.array([sorted(f) for f in found], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), terms], names=["query", "item", "terms"])

    slim = queries.select(F.monotonically_increasing_id().alias("query"), F.col(f"`{id_col}`").cast("long").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return staged(slim.mapInArrow(run, "query long, item long, terms array<binary>"))


def _query_blocks(queries: DataFrame, most: int) -> Iterator[list[tuple[int, int | None, list[bytes]]]]:
    """Queries in blocks; only one partition of them is on the driver at a time."""
    held: list[tuple[int, int | None, list[bytes]]] = []
    size = 0
    for row in queries.where(F.size("terms") > 0).toLocalIterator():
        terms = [bytes(t) for t in row.terms]
        if held and size + len(terms) > most:
            yield held
            held, size = [], 0
        held.append((row["query"], row["item"], terms))
        size += len(terms)
    if held:
        yield held


def counted(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) per document: all its terms, and its counts of the known ones."""
    wide = len(vocabulary)
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = known.value.get
        for batch in batches:
            rows = batch.num_rows
            n = np.zeros(rows, np.int64)
            keys, counts = [], []
            for words, owners in blocks(batch.column(1)):
                n += np.bincount(owners, minlength=rows)
                at = np.fromiter(map(find, words, repeat(-1)), np.int64, len(words))
                hit = at >= 0
                key, times = np.unique(owners[hit] * wide + at[hit], return_counts=True)
                keys.append(key)
                counts.append(times)
            key, back = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_inverse=True)
            times = np.bincount(back, np.concatenate(counts), len(key)).astype(np.int64) if keys else np.empty(0, np.int64)
            cuts = pa.array(np.searchsorted(key, np.arange(rows + 1) * wide).astype(np.int32))
            terms = pa.ListArray.from_arrays(cuts, pa.array((key % wide).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), terms, pa.ListArray.from_arrays(cuts, pa.array(times))], names=["doc_id", "n", "terms", "counts"]
            )

    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return staged(slim.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>").where("n > 0"))


def _impacts(batch: pa.RecordBatch, weight: np.ndarray, docs_all: int, terms_all: int):
    """(term, document, impact) of a batch's entries, by term and then from the highest impact."""
    n = batch.column(1).to_numpy(zero_copy_only=False)
    lists, counts = batch.column(2), batch.column(3)
    term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    tf = counts.flatten().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy(zero_copy_only=False))
    m = 10 + np.array([90 * x * docs_all // terms_all for x in n.tolist()], np.int64)  # whole numbers of any size
    impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
    order = np.lexsort((-impact, term))
    return term[order], doc[order], impact[order]


def resolve(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``best`` documents of some lists of (documents, impacts), the highest impact first.

    Gives (documents, scores) by falling score, equal ones by rising ``ids``. ``ids`` has a number
    for each document of the batch.
    """
    size = len(ids)
    lower = np.zeros(size, np.int64)
    ahead = np.ones((len(lists), size), bool)  # the term's entry of the document isn't read yet
    at, step = 0, FIRST_READ
    while True:
        following = np.zeros(len(lists), np.int64)
        for i, (docs, impacts) in enumerate(lists):
            part = docs[at : at + step]
            lower[part] += impacts[at : at + step]  # a document is in a list once
            ahead[i, part] = False
            if at + step < len(docs):
                following[i] = impacts[at + step]
        at, step = at + step, at + step
        # the k-th best lower end; documents that can't reach it are out
        reached = np.partition(lower, size - best)[size - best] if size > best else 0
        open_ = following > 0
        if open_.any():
            top = int(following.sum())
            maybe = np.flatnonzero(lower + top >= max(reached, 1))
            more = following[open_] @ ahead[np.ix_(open_, maybe)]
            if ((more > 0) & (lower[maybe] + more >= max(reached, 1))).any():
                continue
        found = np.flatnonzero(lower >= max(reached, 1))
        found = found[np.lexsort((ids[found], -lower[found]))][:best]
        return found, lower[found]


def _search(queries, weight, docs_all: int, terms_all: int, best: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = queries.value, weight.value
        for batch in batches:
            if not batch.num_rows:
                continue
            term, doc, impact = _impacts(batch, weights, docs_all, terms_all)
            starts = np.searchsorted(term, np.arange(len(weights) + 1))
            ids = batch.column(0).fill_null(2**63 - 1).to_numpy(zero_copy_only=False)
            out: list[list[np.ndarray]] = [[], [], []]
            for number, (_, _, terms) in enumerate(block):
                spans = [(doc[starts[t] : starts[t + 1]], impact[starts[t] : starts[t + 1]]) for t in terms]
                spans = [s for s in spans if len(s[0])]
                if not spans:
                    continue
                width = max(best + 1, CELLS // len(spans))
                for lo in range(0, len(ids), width):
                    if width >= len(ids):
                        part = spans
                    else:
                        inside = [(d >= lo) & (d < lo + width) for d, _ in spans]
                        part = [(d[x] - lo, v[x]) for (d, v), x in zip(spans, inside) if x.any()]
                    if part:
                        got, score = resolve(part, ids[lo : lo + width], best)
                        for into, values in zip(out, (np.full(len(got), number), got + lo, score)):
                            into.append(values)
            if out[0]:
                number, at, score = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number, pa.int32()), batch.column(0).take(pa.array(at)), pa.array(score)], names=["number", "doc_id", "score"]
                )

    return run


def search(
    docs: DataFrame,
    queries: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
    best: int = BEST,
    query_terms_at_once: int = QUERY_TERMS,
) -> DataFrame:
    """(query, item_id, rank, doc_id, score) of the ``best`` documents of every query."""
    spark = docs.sparkSession
    found = spark.createDataFrame([], "query long, item_id long, rank int, doc_id long, score long")
    for block in _query_blocks(query_terms(queries, query_id, query_text), query_terms_at_once):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, _, terms in block for t in terms}))}
        rows = counted(docs, id_col, text_col, vocabulary)
        all_docs, all_terms = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not all_docs:
            return found
        weight = np.zeros(len(vocabulary), np.int64)
        # one line per term of the block
        for t, df in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect():
            weight[t] = math.floor(1000 * math.log((2.0 * all_docs + 2) / (2.0 * df + 1)))
        numbered = [(q, i, [vocabulary[t] for t in terms]) for q, i, terms in block]
        send = spark.sparkContext.broadcast
        top = rows.mapInArrow(_search(send(numbered), send(weight), all_docs, all_terms, best), "number int, doc_id long, score long")
        order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
        names = spark.createDataFrame([(n, q, i) for n, (q, i, _) in enumerate(numbered)], "number int, query long, item_id long")
        ranked = ranked.join(F.broadcast(names), "number")  # one line per query of the block
        found = found.unionByName(ranked.select("query", "item_id", "rank", "doc_id", "score"))
    return found


def op12(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("query")


OP12_SQL = r"""
WITH words AS (
    SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
    UNION ALL
    SELECT 'q', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) FROM benchmark),
counts AS (SELECT id AS doc_id, term, count(*) AS tf FROM words WHERE side = 'd' GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
items AS (SELECT DISTINCT id AS item_id, term FROM words WHERE side = 'q'),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals),
scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
    FROM items JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id), totals GROUP BY ALL)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
