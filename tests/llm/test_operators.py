"""Every operator against a brute-force version, on rows with nulls, ties, repeats and odd names."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recordloom.llm import exact, hosts, minhash, mixing, packing, passages, quality, secrets, textops, vectors, wavelet
from recordloom.llm.tokens import Encoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RNG = np.random.default_rng(5)


def prose(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdeilmnorst"), rng.integers(3, 8))) for _ in range(n))


BASE = prose(300, 1)
NEAR = BASE.split()
NEAR[150] = "changed"
ROWS = [
    (1, "Same Text here", "a", "x"),
    (2, "same text HERE", "a", "y"),
    (2, "same text HERE", "a", "y"),
    (3, None, "b", None),
    (4, "", None, "z"),
    (None, "same text here", None, "z"),
    (5, "ÄÖ é", "b", "z"),
    (6, "äö é", "b", "z"),
    (7, BASE, "c", "z"),
    (8, " ".join(NEAR), "c", "z"),
    (9, prose(20000, 2), "c", "z"),
    (10, "  a  b \n", "a", "z"),
    (11, "password=hunter22x and AKIA" + "ABCDEFGH01234567", "a", "z"),
    (12, prose(40, 3) + " " + " ".join(BASE.split()[100:180]) + " " + prose(60, 4), "a", "z"),
]
SCHEMA = "doc_id long, text string, source string, kept string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def norm(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_content_sort(docs, nothing):
    got = sorted(map(tuple, exact.decisions(docs, keep="largest", partitions=3).collect()), key=repr)
    want = []
    for i, text, *_ in ROWS:
        group = [r[0] for r in ROWS if norm(r[1]) == norm(text)]
        keep = max(g for g in group if g is not None)
        want.append((i, keep, len(group), hashlib.sha256(norm(text).encode()).hexdigest()))
    assert sorted([(r[0], r[1], r[2], r[4]) for r in got], key=repr) == sorted(want, key=repr)
    texts = {norm(r[1]) for r in ROWS}
    assert sum(r[3] for r in got) == len(texts) and all(r[0] == r[1] for r in got if r[3])
    rows = exact.deduplicated(docs, keep="largest", partitions=3)
    assert rows.columns == docs.columns and {norm(r.text) for r in rows.collect()} == texts and rows.count() == len(texts)
    assert exact.decisions(nothing).count() == 0 and exact.deduplicated(nothing).count() == 0


def test_a_run_over_all_partitions(spark):
    df = spark.range(500).selectExpr("id doc_id", "if(id % 5 = 0, 'Lone' || id, 'Copy') text")
    got = exact.decisions(df, keep="largest", partitions=7).where("group_size > 1").collect()
    assert len(got) == 400 and {(r.keep_id, r.group_size) for r in got} == {(499, 400)} and [r.id for r in got if r.kept] == [499]
    assert exact.deduplicated(df, keep="largest", partitions=7).count() == 101


def test_mixing_meets_targets(spark, nothing):
    rows = [(i, prose(int(RNG.integers(1, 60)), i), [None, "a", "b", "B"][i % 4] if i > 60 else "big") for i in range(200)]
    rows += [(300, None, "a"), (301, "", "empty"), (302, " \t", "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    by = {}
    for i, _, s in rows:
        by[s] = by.get(s, 0) + size[i]
    names = sorted((s for s in by if s is not None)) + [None]
    open_, left, level = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}, 1.5 * sum(by.values()), {}
    while True:
        part = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = [s for s in part if part[s] >= 2 * by[s]]
        if not over:
            level |= part
            break
        for s in over:
            level[s] = 2 * by[s]
            left -= level[s]
            del open_[s]
    source = {i: s for i, _, s in rows}
    assert all(r.size == size[r.id] and r.source_size == by[source[r.id]] and r.target == pytest.approx(level[source[r.id]]) and 0 <= r.taken <= 2 * r.size for r in got)
    for s in by:
        assert abs(sum(r.taken for r in got if source[r.id] == s) - level[s]) <= 60
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(df).collect()))
    assert mixing.mixed_rows(df).count() == sum(r.copies for r in got)
    assert mixing.mix(nothing).count() == 0


def test_rows_without_unique_ids_keep_their_copies(spark):
    """70 copies for 100 rows of one null id, source and length."""
    rows = [(None, f"one two three n{i}", "a") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = [r.text for r in mixing.mixed_rows(df, budget=0.7).collect()]
    assert len(got) == 70 and set(got) <= {r[1] for r in rows}


def test_near_deduplication_keeps_different_texts_of_one_id(spark):
    texts = [prose(60, 90 + i) for i in range(6)]
    rows = [*((1, t) for t in texts), (0, texts[0] + " more"), (2, texts[1]), (None, texts[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(minhash.deduplicated(df).collect(), key=str)
    want = [(1, t) for t in texts[1:]] + [(0, texts[0] + " more"), (None, texts[2])]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def whole(text):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aB1 \n\t.'’éß　\xa0 <|>日")), max_size=40))
def test_pieces_encode_as_the_whole(text):
    if not hasattr(test_pieces_encode_as_the_whole, "own"):
        test_pieces_encode_as_the_whole.own = Encoder(VOCABULARY)
    assert test_pieces_encode_as_the_whole.own.encode([text])[0].tolist() == whole(text)


def test_added_tokens_are_recognised_as_in_a_plain_call():
    plain, own = Tokenizer.from_file(VOCABULARY), Encoder(VOCABULARY)
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|>b c", "<|endoftext |> <|endof text|>", "one two", "x  <|endoftext|> "]
    for _ in range(2):
        assert [x.tolist() for x in own.encode(texts)] == [plain.encode(x, add_special_tokens=False).ids for x in texts]


def test_token_files(spark, docs, nothing, tmp_path):
    wavelet.write_files(docs, str(tmp_path / "files"), VOCABULARY, shard=500, partitions=3)
    got = sorted(wavelet.read_files(spark, str(tmp_path / "files")).collect(), key=lambda r: r.start)
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, row in zip(got, rows, strict=True):
        ids = np.array([*whole(row[1]), 2], "<u4")
        assert (r.id, r.start, r.n_tokens, r.ids_crc32) == (row[0], at, len(ids), zlib.crc32(ids))
        at += len(ids)
    wavelet.write_files(nothing, str(tmp_path / "none"), VOCABULARY)
    assert wavelet.read_files(spark, str(tmp_path / "none")).count() == 0


def test_wavelet_matrix():
    values = RNG.integers(0, 50257, 3000).astype(np.uint32)
    values[::4] = 9
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(values, 16).to_bytes())
    assert (m.values() == values).all() and all(m.access(i) == values[i] for i in range(0, 3000, 11))
    places = np.flatnonzero(values == 9)
    assert m.count(9) == len(places) and m.count(9, 100, 777) == (values[100:777] == 9).sum() and m.count(70000) == 0
    assert all(m.select(9, k) == places[k] for k in range(0, len(places), 13))
    with pytest.raises(IndexError):
        m.select(9, len(places))


def test_packing(docs, nothing):
    packed = packing.pack(docs, VOCABULARY, with_ids=True, partitions=3, fan=2).toPandas()
    lengths = sorted(len(whole(r[1])) + 1 for r in ROWS)
    assert packed.length.sum() == sum(lengths) and packed.length.max() <= 1024
    firsts = packed[packed.piece == 0]
    assert len(firsts) == len(ROWS) and (packed[packed.piece > 0].length == 1024).all()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in packed.itertuples())
    for _, s in packed.sort_values("offset").groupby("sequence"):
        assert (s.offset.to_numpy() == s.length.cumsum().to_numpy() - s.length.to_numpy()).all() and s.length.sum() <= 1024
    assert packed.sequence.nunique() <= -(-sum(lengths) // 1024) + 1
    assert packing.pack(nothing, VOCABULARY).count() == 0
    joined = packing.sequences(packing.pack(docs, VOCABULARY, with_ids=True, partitions=3))
    assert all(len(r.ids) == 4 * r.length for r in joined.collect())


def jaccard_classes(rows, words=5, similar=0.8):
    sets = {}
    for i, text, *_ in rows:
        w = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
        sets[i] = {tuple(w[j : j + words]) for j in range(max(1, len(w) - words + 1))} if w else set()
    home = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b]):
                    home[a] = home[b] = min(home[a], home[b])
    return home


def test_near_duplicates(spark, docs, nothing):
    want = jaccard_classes([r for r in ROWS if r[0] is not None])
    got = minhash.near_classes(docs).collect()
    assert len(got) == len(ROWS)
    assert all(r.component_id == want[r.id] and r.kept == (r.id == want[r.id]) for r in got if r.id is not None)
    assert [(r.component_id, r.kept) for r in got if r.id is None] == [(None, True)]
    rows = minhash.deduplicated(docs)
    assert rows.columns == docs.columns and rows.count() == len(set(want.values())) + 1
    assert minhash.near_classes(nothing).count() == 0


def test_near_duplicates_of_a_chain(spark):
    """Each text is near the next one only, so hubs alone would lose links."""
    words = prose(120, 8).split()
    rows = []
    for i in range(12):
        if i:
            words[i * 9] = f"w{i}"
        rows.append((100 - i, " ".join(words)))
    want = jaccard_classes(rows)
    got = {r.id: r.component_id for r in minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and len(set(want.values())) == 1


def test_near_duplicates_with_other_repetition(spark):
    """Shingle sets are equal to 0.8 and more, but one text has a hundred of them fifty times."""
    rows = []
    for case in range(60):
        words = prose(204, 300 + case).split()
        changed = [*words[:186], *prose(18, 400 + case).split()]
        rows += [(2 * case, " ".join(words)), (2 * case + 1, " ".join(words[:100] * 50 + changed))]
    want = jaccard_classes(rows[:2])
    assert want[1] == 0
    got = {r.id: r.component_id for r in minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == 120 and all(got[i] == i - i % 2 for i in got)


def test_signatures_estimate_weighted_similarity():
    a = np.arange(400, dtype=np.uint64)
    items = textops.mix(a + np.uint64(1))
    left, right = (items[:300], np.ones(300)), (items[100:], np.ones(300))
    got = minhash.signatures([left, right, (items[:300], np.full(300, 7.0))], 4096)
    assert abs((got[0] == got[1]).mean() - 0.5) < 0.04 and (got[0] == got[2]).mean() > 0.999


def test_passages(docs, nothing):
    spans = passages.merged(passages.repeats(docs)).collect()
    by = {r.id: r for r in spans}
    assert {7, 8, 12} <= set(by) and not {1, 3, 4, 5, 9, 10, 11} & set(by)
    assert by[12].low <= 41 and by[12].high >= 119 and by[12].high - by[12].low <= 90
    assert passages.repeats(nothing).count() == 0


@pytest.mark.parametrize("size,count,apart", [(50, 2, 30), (55, 2, 30), (80, 3, 40), (60, 2, 20), (50, 2, 60)])
def test_passages_with_own_words_between(spark, size, count, apart):
    shared = [prose(size, 700 + i) for i in range(count)]
    rows = []
    for doc in (1, 2):
        body = [w for i, part in enumerate(shared) for w in (part, prose(apart, 800 + 10 * doc + i))]
        rows.append((doc, " ".join([prose(30, 900 + doc), *body])))
    spans = passages.merged(passages.repeats(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    for doc in (1, 2):
        covered = {w for r in spans if r.id == doc for w in range(r.low, r.high)}
        for i in range(count):
            assert covered >= set(range(30 + i * (size + apart), 30 + i * (size + apart) + size))


@pytest.mark.parametrize("more", [0, 6])
def test_passages_whose_parts_occur_in_smaller_documents(spark, more):
    """No smaller document has 50 words of the passage, so only the largest two can show it."""
    quotes = [(0, 45), (15, 60), *[(5 * i, 5 * i + 30) for i in range(more)]]
    rows, whole = [], []
    for case in range(5):
        notice = prose(60, 40 + case).split()
        for lo, hi in [*quotes, (0, 60), (0, 60)]:
            rows.append((len(rows), " ".join([prose(20, 2000 + len(rows)), *notice[lo:hi], prose(20, 3000 + len(rows))])))
        whole += [rows[-2][0], rows[-1][0]]
    spans = {r.id: r for r in passages.merged(passages.repeats(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert all(i in spans and spans[i].low <= 22 and spans[i].high >= 78 for i in whole)


def test_changed_passages_whose_phrases_are_in_many_smaller_documents(spark, monkeypatch):
    """Every seed has more than FEW occurrences, and its smallest document is never the partner."""
    monkeypatch.setattr(passages, "OPEN_ROWS", 3)  # several tiles for a seed
    monkeypatch.setattr(passages, "ALL_ROWS", 4)
    rows, whole = [], []
    notices = [prose(64, 4000 + case).split() for case in range(12)]
    for few in range(6):
        phrases = [n[lo : lo + 7] for n in notices for lo in range(0, 64, 8)]
        rows.append((few, " ".join(w for i, p in enumerate(phrases) for w in (*p, *(f"few{few}x{i}x{j}" for j in range(6))))))
    for case, notice in enumerate(notices):
        for copy in range(2):
            body = [f"own{case}x{i}" if copy and i % 8 == 7 else w for i, w in enumerate(notice)]
            whole.append(len(rows))
            rows.append((len(rows), " ".join([prose(40, 5000 + len(rows)), *body, prose(40, 6000 + len(rows))])))
    spans = passages.merged(passages.repeats(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    by = {r.id: r for r in spans}
    assert set(by) == set(whole) and len(spans) == len(by)
    assert all(r.low <= 41 and r.high >= 102 and r.partner == (i + 1 if i % 2 == 0 else i - 1) for i, r in by.items())


def test_words_beside_seeds_never_rule_out_a_passage():
    """50 words around a seed, ten of them replaced or left out, in other texts."""
    for case in range(400):
        rng = np.random.default_rng(case)
        one, two = rng.integers(0, 2**63, (2, 240)).astype(np.uint64)
        seed = int(rng.integers(0, 47))
        changed = set(rng.choice([i for i in range(50) if not seed <= i < seed + 4], 10, replace=False).tolist())
        part = [(i, rng.integers(0, 2**63, dtype=np.uint64) if i in changed else w) for i, w in enumerate(one[100:150]) if case % 2 or i not in changed]
        at = [i for i, _ in part].index(seed)
        two = np.concatenate([two[:80], np.array([w for _, w in part], np.uint64), two[80:]])
        a, b = passages._beside(one, np.array([100 + seed])), passages._beside(two, np.array([80 + at]))
        assert passages._alike(a, b).all()
        unlike = passages._beside(rng.integers(0, 2**63, 240).astype(np.uint64), np.array([100]))
        assert not passages._alike(a, unlike).any()


def test_rows_of_a_tile_are_looked_up_and_not_all_compared():
    """All alike rows of a tile are found, within tiles only, and few others are looked at."""
    rng = np.random.default_rng(5)
    words = np.concatenate([rng.integers(1, 40, (800, 2, passages.WIDE)), rng.integers(1, 256, (800, 2, passages.WIDE))]).astype(np.uint8)
    for k in range(0, 1600, 4):  # a copy with some words changed, or one left out
        words[k + 1] = words[k]
        words[k + 1][rng.random((2, passages.WIDE)) < 0.12] = 255
        if k % 8:
            words[k + 1, 0, 5:-1] = words[k, 0, 6:]
    words[10, 1, 20:] = words[11, 1, 20:] = 0  # texts end there
    words[20:24, :, 30:] = 0
    words[40:60, 0], words[50:60, 1] = 7, 7  # one word over and over
    tile = np.repeat(np.arange(4), 400)
    who, against = np.flatnonzero(np.arange(1600) % 3 != 0), np.arange(1600)
    found = [pairs for pairs in passages._leads(words, tile, who, against)]
    leads = {(int(who[i]), int(against[j])) for one, two in found for i, j in zip(one, two)}
    near = set()
    for i in who.tolist():
        same = np.flatnonzero(tile == tile[i])
        near |= {(i, int(j)) for j in same[passages._alike(np.repeat(words[i][None], len(same), 0), words[same])]}
    assert len(near) > 1500 and near <= leads and all(tile[i] == tile[j] for i, j in leads)
    assert sum(i >= 800 for i, _ in leads) < 0.1 * sum(i >= 800 for i in who.tolist()) * 400


def test_chains_whose_words_disagree_are_told_from_marks():
    rng = np.random.default_rng(6)
    same = rng.random((400, 132)) < rng.uniform(0.1, 0.95, (400, 1))
    same[::3, 60:] &= rng.random((134, 72)) < 0.3

    def whole(row):
        total = np.concatenate([[0], np.cumsum(row)])
        return any(total[hi] - total[lo] >= 0.8 * (hi - lo) - 1e-9 for lo in range(len(row)) for hi in range(lo + 50, len(row) + 1))

    wanted = [whole(row) for row in same]
    assert passages._agree(same).tolist() == wanted and 50 < sum(wanted) < 350


def test_linked_occurrences():
    rows = [(1, 5, 3), (1, 7, 2), (2, 5, 3), (2, 5, 3), (2, 6, 1), (3, 4, 4), (3, 4, 9), (4, 1, 1), (4, 2, 2), (4, 2, 8), (4, 3, 3), (5, 1, 1), (5, 1, 4), (5, 2, 2), (5, 2, 6), (5, 3, 3)]
    batches = [pa.RecordBatch.from_pydict({c: pa.array(v, t) for c, v, t in zip(("seed", "id", "place"), zip(*part), (pa.int64(), pa.int64(), pa.int32()))}) for part in (rows[:4], rows[4:9], rows[9:])]
    got = [tuple(r.values()) for out in passages._linked(iter(batches)) for r in out.to_pylist()]
    few = [(None, 7, 2, 5, 3), (None, 6, 1, 5, 3), (None, 2, 2, 1, 1), (None, 2, 8, 1, 1), (None, 3, 3, 1, 1), (None, 3, 3, 2, 2), (None, 3, 3, 2, 8)]
    many = [(5, 1, 1, None, None), (5, 1, 4, None, None), (5, 2, 2, 1, 1), (5, 2, 6, 1, 1), (5, 3, 3, 1, 1)]
    assert sorted(got, key=str) == sorted(few + many, key=str)


def test_recall_of_changed_passages(spark):
    """60 words, one word in ``every`` changed, or that share of them at random places."""
    rows, home, cases = [], {}, 40
    for every in (5, 8, 13, 20, 0.05, 0.1, 0.15, 0.2):
        for case in range(cases):
            rng = np.random.default_rng(case)
            words = prose(60, len(rows) + 50_000).split()
            changed = [i % every == every // 2 for i in range(60)] if every > 1 else rng.permutation(60) < every * 60
            other = [f"own{i}x" if c else w for i, (w, c) in enumerate(zip(words, changed))]
            for part in (words, other):
                home[len(rows)] = every
                rows.append((len(rows), " ".join([prose(40, len(rows) + 60_000), *part, prose(40, len(rows) + 70_000)])))
    found = {r.id for r in passages.merged(passages.repeats(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    recall = {every: sum(home[i] == every for i in found) / (2 * cases) for every in home.values()}
    assert min(recall.values()) >= 0.95, recall


def test_chains_are_in_order_and_hold_each_match_once():
    for seed in range(30):
        rng = np.random.default_rng(seed)
        x, y = rng.integers(0, 60, (2, 9))
        paths = passages.chain(x, y)
        assert sorted(i for p in paths for i in p) == list(range(9))
        for p in paths:
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(p, p[1:]))


def test_quality(spark, nothing):
    good = [(i, prose(80, i), 1) for i in range(60)]
    bad = [(100 + i, " ".join(f"{w.upper()}!!" for w in prose(80, i).split()), 0) for i in range(60)]
    rows = good + bad + [(300, None, None), (301, "", 1), (None, prose(50, 7), None), (5, prose(80, 5), 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = df.selectExpr("doc_id", "score quality")
    model = quality.fit(df, labels)
    got = quality.scored(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    for r in got:
        if r.id is not None and zlib.crc32(str(r.id).encode()) % 5 == 0 and r.id < 200:
            assert (r.score >= quality.KEEP) == (r.id < 100)
    kept = quality.scored(df, model, rest=True).where("score < 2").select("row.*")
    assert kept.columns == df.columns and kept.count() == len(rows)
    assert quality.scored(df, quality.fit(df, labels.limit(0))).where("score = 1").count() == len(rows)
    assert quality.scored(nothing, model).count() == 0


def test_hosts(spark):
    rows = [
        (1, "http://A.Example.net/en/x?q", '<a href="https://bad.test/x">'),
        (2, "https://example.net/de", None),
        (3, "x.org/fr/", ""),
        (4, None, ""),
        (5, "http://s.example.com/de/", '<a href="//friend.test/">'),
        (6, "http://spam.test/p", "<a href='http://s.example.com/a'><a href='HTTP://t.example.com'>"),
        (7, "http://u.org/fr/#a", "<a href=http://fine.test/q>"),
        (8, "http://fine.test", ""),
        (9, "http://net", ""),
        (10, "http://net/", ""),
        (10, "http://net/", ""),
    ]
    rows += [(100 + i, "http://s.example.com/de/" + str(i), "") for i in range(40)]
    got = hosts.judged(spark.createDataFrame(rows, "page_id long, url string, html string"))
    by = {r.id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert (by[1].host, by[1].path, by[1].rule, by[1].verdict) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert (by[2].rule, by[5].rule, by[7].rule, by[9].rule, by[10].rule) == ("net/", "example.com/de/", "org/fr/", None, "net/")
    assert (by[3].host, by[4].host, by[4].path, by[4].verdict) == ("", "", "", "allow")
    assert by[6].verdict == "block" and by[8].verdict == "allow"  # links to blocked pages; linked from allowed ones
    assert hosts.judged(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_secrets(spark, docs, nothing):
    key = lambda n: "".join(RNG.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"), n))
    texts = [f"é😀 Token: '{key(30)}' then {key(8)} {'internationalisation' * 2} configurationmanager" for _ in range(120)]
    texts += ["password=token:secretvalue", "PASSWD = ab, api_key=" + "0a" * 14 + " AKIAAKIA" + "Z9" * 9, None, "", "AKIA123 " + "f" * 23]
    texts += [f"loose {key(40)}1a and identifiernumber2configuration"] * 2
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.id: r for r in secrets.spans(df).collect()}
    for i, t in enumerate(texts):
        assert [(s.start, s.rank, s.end) for s in got[i].base] == base_spans(t or "")
    extra = [texts[-1][s.start : s.end] for s in got[len(texts) - 1].extra]
    assert extra == [texts[-1].split()[1]]
    assert secrets.spans(nothing).count() == 0 and secrets.spans(docs).count() == len(ROWS)


def test_secrets_of_letters_alone(spark):
    rng = np.random.default_rng(11)
    key = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    texts = [f"token: '{key(24)}' internationalisation configurationmanager misunderstanding" for _ in range(150)]
    texts += [f"see {key(32)} and internationalisation" for _ in range(20)]
    found = secrets.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    extra = {r.id: [texts[r.id][s.start : s.end] for s in r.extra] for r in found}
    assert all(extra[i] == ([] if i < 150 else [t.split()[1]]) for i, t in enumerate(texts))


def test_vectors(spark):
    centre = RNG.standard_normal((6, 16))
    rows = [(i, (centre[i % 6] + 0.03 * RNG.standard_normal(16)).tolist(), [0, 1, None][i // 6 % 3]) for i in range(90)]
    rows += [(200 + i, rows[0][1], 0) for i in range(5)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] * 16, 0), (303, [None] * 16, 0), (304, [1.0, 2.0], 0), (305, [2.0, 4.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.id: r for r in vectors.near_vectors(df).collect()}
    links = {i: set() for i, _, _ in rows}
    for i, a, la in rows:
        for j, b, lb in rows:
            if i != j and la is not None and la == lb and a and b and len(a) == len(b) and None not in a + b and np.isfinite(a + b).all() and np.any(a) and np.any(b):
                if np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                    links[i].add(j)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            fresh = links[todo.pop()] - seen
            seen |= fresh
            todo += fresh
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(links[i]), min(seen), i == min(seen))
    assert len(got) == len(rows) and vectors.recall() > 0.9999
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_pipeline_keeps_what_each_stage_decides(spark):
    import corpus_pipeline

    docs = corpus_pipeline.table(spark, "/root/testdata/sf0.001", "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.staged(stage(spark, seen[-1], "/root/testdata/sf0.001")))
        if name != "packing":
            assert seen[-1].columns == docs.columns
    raw, good, single, apart, mixed, packed = seen
    assert good.count() < raw.count() and good.exceptAll(raw).isEmpty()
    texts = [norm(r.text) for r in single.collect()]
    assert len(texts) == len(set(texts)) == len({norm(r.text) for r in good.collect()})
    want = jaccard_classes([(r.doc_id, r.text) for r in single.collect()])
    assert {r.doc_id for r in apart.collect()} == set(want.values())
    assert packed.where("piece = 0").count() == mixed.count()
