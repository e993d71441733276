"""Groups of near copies around the threshold against all pairs."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import minhash


def classes(n, similar):
    """Smallest member of each one's class, from a matrix of links."""
    label = np.arange(n)
    for i in range(n):
        for j in np.flatnonzero(similar[i]):
            a, b = sorted((label[i], label[j]))
            label[label == b] = a
    return label


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 0.0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 60), st.integers(1, 30), st.sampled_from([3, 2048]))
def test_links_in_a_tile_join_what_all_pairs_join(seed, n, homes, columns):
    rng = np.random.default_rng(seed)
    base = rng.choice(2**60, 60, replace=False)
    sets = [np.unique(np.where(rng.random(60) < rng.choice([0, 0.05, 0.1, 0.3]), rng.integers(0, 2**60, 60), base)).astype(np.uint64) for _ in range(n)]
    sets[0] = sets[0][:0]
    home = rng.integers(0, homes, n)
    old, minhash.COLUMNS = minhash.COLUMNS, columns
    found = minhash.linked(sets, home, 0.8)
    minhash.COLUMNS = old
    real = [set(s.tolist()) for s in sets]
    close = np.array([[jaccard(a, b) >= 0.8 - 1e-9 for b in real] for a in real])
    assert all(close[i, j] for i, j in found) and len(found) < n
    same = home[:, None] == home[None, :]
    given_ = np.zeros((n, n), bool)
    for i, j in found:
        given_[i, j] = given_[j, i] = True
    assert (classes(n, close | same) == classes(n, given_ | same)).all()


def test_groups_around_the_threshold_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 16)
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(4000)]
    rows, k = [], 0
    for _ in range(4):
        base = list(rng.choice(words, 160))
        for _ in range(30):
            text = base.copy()
            for at in rng.choice(160, rng.integers(0, 9), replace=False):
                text[at] = str(rng.choice(words))
            rows.append((k, " ".join(text)))
            k += 1
    rows += [(k + i, " ".join(rng.choice(words, 100))) for i in range(20)]
    shingles = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t in rows]
    close = np.array([[jaccard(a, b) >= 0.8 for b in shingles] for a in shingles])
    got = {r.id: r.component_id for r in minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    want = classes(len(rows), close)
    assert len(set(want)) > 30
    lost = sum(got[i] != w for i, w in enumerate(want.tolist()))
    assert lost == 0
