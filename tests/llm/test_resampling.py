"""Resampling against plain counting and sorting of all scores."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import resampling
from recordloom.llm.words import blocks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))


def features(text):
    w = words_of(text)
    return [zlib.crc32(f.encode()) % 10000 for f in [*w, *(" ".join(p) for p in zip(w, w[1:]))]]


def brute(docs, target):
    s, t = (Counter(b for _, x in rows for b in features(x)) for rows in (docs, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        f = features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in f]
        weight = sum(gains) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text))])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], 2**63 if r[0] is None else r[0]))
    for n, row in enumerate(able[: 25 * len(able) // 100], 1):
        row[4] = n
    return sorted((tuple(r[:5]) for r in out), key=repr)


def made(n, seed):
    rng = np.random.default_rng(seed)
    words = ["Straße", "ÄB", "x9", "a" * 60, *(f"w{i}" for i in range(300))]
    return [" ".join(rng.choice(words, rng.integers(1, 90))) for _ in range(n)]


DOCS = [*enumerate(made(300, 1)), (400, None), (401, ""), (402, "..."), (None, made(1, 2)[0]), (403, "Word " * 40_000), (404, "x" * 100_000)]
TARGET = list(enumerate(made(20, 3)))


def frame(spark, rows, name="doc_id"):
    return spark.createDataFrame(rows, f"{name} long, text string")


def run(spark, docs, target, few=resampling.FEW):
    gain = resampling._gain_of(docs, target, "text", "text", resampling.BUCKETS)
    return resampling.draw(resampling.scored(docs, "doc_id", "text", gain), few=few)


@pytest.mark.parametrize("few", [2, 4096])
def test_draw_equals_sorting_all(spark, few):
    docs, target = frame(spark, DOCS).repartition(5), frame(spark, TARGET, "item_id")
    rows = run(spark, docs, target, few).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, rows), key=repr) == brute(DOCS, TARGET)


def test_drawn_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(i, t, "r", i) for i, t in DOCS], "doc_id long, text string, row string, rank long").repartition(3)
    got = resampling.resampled(docs, frame(spark, TARGET, "item_id"))
    want = {r[4]: r[0] for r in brute(DOCS, TARGET) if r[4]}
    texts = dict(DOCS)
    rows = got.collect()
    assert got.columns[:4] == docs.columns and {r[-1]: r.doc_id for r in rows} == want
    assert all(r.text == texts[r.doc_id] and r["rank"] == r.doc_id and r.row == "r" for r in rows)


def test_repeated_rows_have_ranks_of_their_own(spark):
    text = made(1, 5)[0] + " more" * 20
    rows = run(spark, frame(spark, [(1, text)] * 40).repartition(3), frame(spark, TARGET, "item_id"), few=2).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 11))


def test_empty_tables(spark):
    none = frame(spark, [])
    assert run(spark, none, frame(spark, TARGET, "item_id")).collect() == []
    rows = run(spark, frame(spark, DOCS), none).collect()
    assert len(rows) == len(DOCS) and sum(r["rank"] is not None for r in rows) == 25 * sum(len(words_of(t)) >= 20 for _, t in DOCS) // 100
    assert resampling.resampled(frame(spark, [(1, "a b")]), none).collect() == []


@settings(max_examples=12, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 400), st.integers(1, 5))
def test_cutoff_is_the_wanted_key(spark, seed, size, spread):
    from recordloom.llm.common import staged

    rng = np.random.default_rng(seed)
    keys = [(int(a), int(b), n) for n, (a, b) in enumerate(zip(rng.integers(-spread, spread, size), rng.integers(0, 9, size)))]
    df = staged(spark.createDataFrame(keys, "low long, doc long, row long").repartition(int(rng.integers(1, 9))))
    wanted = int(rng.integers(1, size + 1))
    assert resampling.cutoff(df, wanted, few=2) == resampling.Key(*sorted(keys)[wanted - 1])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab9éÄ", min_size=1, max_size=70), min_size=1, max_size=20))
def test_buckets_are_checksums(words):
    made_ = [w.encode() for w in words]
    one, two = resampling.Buckets()(made_)
    assert one.tolist() == [zlib.crc32(w) % 10000 for w in made_]
    assert two.tolist() == [zlib.crc32(a + b" " + b) % 10000 for a, b in zip(made_, made_[1:])]


def test_pairs_across_blocks(monkeypatch):
    import pyarrow as pa

    texts = ["ab cd " * 30 + "e" * 50, "x", None, "cd ab"]
    monkeypatch.setattr(resampling, "blocks", lambda t: blocks(t, 40))
    made_ = list(resampling._features(pa.array(texts), resampling.Buckets()))
    assert len(made_) > 3
    got = sorted((int(i), int(b)) for one, own, two, both in made_ for x, o in ((one, own), (two, both)) for i, b in zip(o, x))
    assert got == sorted((i, b) for i, t in enumerate(texts) for b in features(t))
