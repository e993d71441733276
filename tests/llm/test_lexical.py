"""Ranked search against scores of all documents."""

import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import lexical
from recordloom.llm.words import blocks

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))


def brute(docs, items, best):
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = 0
            for t in set(terms_of(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:best], 1)]
    return sorted(out, key=repr)


def made(n, seed):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)] + ["Straße", "ÄB", "x9"]
    odds = 1 / np.arange(1, len(words) + 1)
    return [" ".join(rng.choice(words, rng.integers(1, 40), p=odds / odds.sum())) for _ in range(n)]


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def test_search_equals_scoring_all(spark):
    docs = [*enumerate(made(400, 1)), (500, None), (501, ""), (502, "--- !!"), (None, "w1 w40 w41"), (503, "w1 w40 w41"), (503, "w1 w40 w41"), (504, "w50 " * 30_000)]
    items = [(1, "w1 W40 w41, w41"), (2, None), (3, "nothing here"), (4, made(1, 9)[0]), (5, "w0"), (6, "STRASSE straße äb ÄB x9"), (None, "w50"), (4, "w2")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    queries = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    want = brute(docs, items, 10)
    assert got(lexical.search(df, queries)) == want
    assert got(lexical.search(df, queries, query_terms_at_once=3)) == want  # many blocks of queries


def test_more_queries_terms_than_fit_at_once(spark, monkeypatch):
    docs, items = list(enumerate(made(150, 4))), list(enumerate(made(5, 6)))
    monkeypatch.setattr(lexical, "CELLS", 64)
    df, queries = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(lexical.search(df, queries, best=4)) == brute(docs, items, 4)


def test_no_documents_or_queries(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, score int")
    queries = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(empty, queries).collect() == []
    assert lexical.search(empty.union(spark.createDataFrame([(1, "a", 2)])), queries.limit(0)).collect() == []
    assert lexical.search(spark.createDataFrame([(1, None)], "doc_id long, text string"), queries).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 6), st.integers(1, 300), st.integers(1, 12), st.integers(1, 9))
def test_intervals_give_the_best_with_ties(seed, lists, size, best, values):
    rng = np.random.default_rng(seed)
    ids = rng.permutation(size)
    made_, total = [], np.zeros(size, np.int64)
    for _ in range(lists):
        docs = rng.choice(size, rng.integers(1, size + 1), replace=False)
        impacts = np.sort(rng.integers(0, values, len(docs)))[::-1]
        made_.append((docs, impacts))
        total[docs] += impacts
    found, score = lexical.resolve(made_, ids, best)
    order = [d for d in np.lexsort((ids, -total)) if total[d] > 0][:best]
    assert found.tolist() == order and score.tolist() == total[order].tolist()


def test_words_of_long_texts_come_in_blocks():
    import pyarrow as pa

    text = "Ab " * 50 + "c" * 300 + " é1"
    parts = list(blocks(pa.array([None, text, "", "x", "...", "z Y"]), 64))
    assert len(parts) > 3
    assert [w for words, _ in parts for w in words] == [b"ab"] * 50 + [b"c" * 300, "é1".encode(), b"x", b"z", b"y"]
    assert [i for _, own in parts for i in own.tolist()] == [1] * 52 + [3, 5, 5]
