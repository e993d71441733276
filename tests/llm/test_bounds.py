"""Bounds and limits of the operators: none drops rows, stops early or grows with one key."""

import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from recordloom.llm import hosts, packing, quality, secrets, textops, tokens, vectors, wavelet

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def words(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdeilmnorst"), rng.integers(3, 8))) for _ in range(n))


def test_propagation_reaches_the_fixed_point(spark):
    """Twelve hosts in a ring with weak chords, where mass travels for long, and a second kind."""
    rng = np.random.default_rng(3)
    weight = np.zeros((12, 12))
    for i in range(12):
        weight[i, (i + 1) % 12] = 1.0
        weight[i, (i + 5) % 12] = 0.05
    weight[7] = 0  # a host without links
    seed = np.where(rng.random(12) < 0.4, rng.integers(1, 9, 12), 0).astype(float)
    seed[0] = 50
    edges = [(kind, f"h{i}", f"h{j}", float(weight[i, j])) for kind in "ab" for i in range(12) for j in range(12) if weight[i, j]]
    seeds = [("a", f"h{i}", float(s)) for i, s in enumerate(seed) if s] + [("b", "h3", 1.0), ("c", "alone", 2.0)]
    got = hosts.propagate(spark.createDataFrame(seeds, "kind string, host string, seed double"), spark.createDataFrame(edges, "kind string, src string, dst string, weight double"))
    by = {(r.kind, r.host): r.score for r in got.collect()}
    walk = weight / np.maximum(weight.sum(1, keepdims=True), 1e-300)
    for kind, start in (("a", seed), ("b", np.eye(12)[3])):
        want = 0.15 * np.linalg.solve(np.eye(12) - 0.85 * walk.T, start)
        assert sum(abs(by.get((kind, f"h{i}"), 0) - want[i]) for i in range(12)) <= hosts.TOLERANCE * start.sum()
    assert by["c", "alone"] == pytest.approx(0.3)


def test_hosts_take_long_pages_and_clashing_columns(spark):
    page = "<p>x</p>" * 100_000 + "<a href='http://s.example.com/a'>"
    rows = [(1, "http://spam.test/p", page, "a", "b"), *[(2, "http://s.example.com/de/", "", None, "c")] * 40, (None, "http://ok.test", None, "d", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule string")
    assert {(r.id, r.verdict) for r in hosts.judged(df).collect()} == {(1, "block"), (2, "block"), (None, "allow")}


def shares_of(texts):
    return quality.term_shares([(t or "").encode() for t in texts], {})


def test_quality_equals_a_plain_computation(spark):
    good = [(i, words(60, i), 1) for i in range(0, 80)]
    bad = [(100 + i, " ".join(w.upper() + "!" * (i % 4) for w in words(60, 500 + i).split()), 0) for i in range(80)]
    rows = [*good, *bad, (300, None, None), (301, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(5)
    got = {r.id: r.score for r in quality.scored(df, quality.fit(df, df.select("doc_id", "quality"))).collect()}
    teach = [r for r in rows if r[2] is not None and zlib.crc32(str(r[0]).encode()) % 5]
    shares, labels = shares_of([t for _, t, _ in teach]).astype(float), np.array([q for *_, q in teach])
    rarity = np.log((1 + len(teach)) / (1 + (shares > 0).sum(0))) + 1
    axes = np.linalg.svd(shares * rarity, full_matrices=False)[2][: quality.RANK].T

    def placed(x):
        z = (x * rarity) @ axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    for (i, text, _), near in zip(rows, placed(shares_of([t for _, t, _ in rows])) @ placed(shares).T):
        best = sorted(range(len(teach)), key=lambda k: -near[k])[: quality.NEAREST]
        weights = [max(near[k], 0) ** quality.SHARPNESS for k in best]
        want = sum(w * labels[k] for w, k in zip(weights, best)) / sum(weights) if text else labels.mean()
        assert got[i] == pytest.approx(want, abs=2e-3)


def test_one_labelled_id_on_many_rows_teaches_once(spark):
    rows = [(1, words(20, i % 3)) for i in range(3000)] + [(i, words(20, i)) for i in range(2, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)], "doc_id long, quality int")
    model = quality.fit(df, labels, most=10)
    assert len(model.labels) == len(model.vectors) == 10
    assert len(quality.fit(df, labels).labels) <= 29
    again = quality.fit(df.orderBy("text"), labels)
    assert quality.scored(df, again).count() == len(rows)


def test_planes_hold_the_vocabulary():
    assert wavelet.levels_of(VOCABULARY) == (Tokenizer.from_file(VOCABULARY).get_vocab_size() - 1).bit_length()
    ids = np.array([0, 65_535, 65_536, 70_000, 131_071, 65_536], "<u4")
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix.build(ids, 16)
    again = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids, 17).to_bytes())
    assert again.values().tolist() == ids.tolist()


def test_remembered_pieces_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 20_000)
    own, plain = tokens.Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    for i in range(30):
        texts = [words(40, 90 + i), "start " + words(60, i).replace(" ", "") + " 日本語" * 50, "x" * 5000 + " " + "日" * 3000, None]
        want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in own.encode(texts)] == want
        assert max(map(len, own.known)) <= tokens.SHORT and own.held < 40_000


def test_packing_remembers_less_than_a_worker_may(spark, monkeypatch):
    """The bound of a stage that shares its workers' memory holds in place of the general one."""
    own, plain = tokens.Encoder(VOCABULARY, remembered=20_000), Tokenizer.from_file(VOCABULARY)
    for i in range(30):
        texts = [words(40, 90 + i), words(60, i), None]
        assert [x.tolist() for x in own.encode(texts)] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert own.held < 40_000
    assert tokens.encoder(VOCABULARY, packing.REMEMBERED) is tokens.encoder(VOCABULARY)
    assert tokens.encoder(VOCABULARY, packing.REMEMBERED).remembered == packing.REMEMBERED < tokens.REMEMBERED
    assert tokens.encoder(VOCABULARY).remembered is None


def test_scored_rows_send_their_text_once(spark):
    docs = spark.createDataFrame([(1, "a", "some words of a text"), (2, None, None), (2, "b", ""), (None, "c", "Other WORDS, 12")], "doc_id long, lang string, text string")
    model = quality.Model.fit(spark.createDataFrame([(1.0, quality.term_shares([b"some words here"], {})[0].tobytes()), (0.0, quality.term_shares([b"12 #$ 99"], {})[0].tobytes())], "quality double, shares binary"))
    got = quality.scored(docs, model, rest=True)
    assert got._jdf.queryExecution().analyzed().children().head().output().size() == 1
    rows = sorted((r.row.doc_id or 0, r.row.lang or "", r.row.text or "", r.score) for r in got.collect())
    apart = quality.scored(docs.select("doc_id", "lang", F.upper("lang").alias("of"), "text"), model, rest=True, text_col="TEXT").select("row.doc_id", "row.lang", "row.text", "score")
    assert rows == sorted((r.doc_id or 0, r.lang or "", r.text or "", r.score) for r in apart.collect())
    assert sorted(r[3] for r in rows) == sorted(r.score for r in quality.scored(docs, model).collect()) and len(rows) == 4


def test_columns_are_cut_by_bytes_as_the_library_does():
    """Each distinct word once, however signs and line ends stand beside it; all else as a plain call."""
    own, plain = tokens.Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    one = words(500, 7)
    signs = ["{} {}", "{}, {}", "{}.\n{}", "{}!!{}", "{}99{}", "{}_{}"]
    own.encode([one])
    held = len(own.known)
    pairs = list(zip(one.split(), one.split()[1:]))
    joined = [" " + sign.format(*pair) for sign in signs for pair in pairs]
    assert [x.tolist() for x in own.encode(joined)] == [plain.encode(x, add_special_tokens=False).ids for x in joined]
    assert len(own.known) <= held + 500 + 10  # second words stand without a space too; not every pair
    rng = np.random.default_rng(4)
    some = ["ab", "Été", "ñÿÀ", "×", "÷", "ªº", "12", "²", "don't", "'s", "\n", "\n\n", "\t", "\x00", "\x1c", "\x85", "\xa0", "日本", "\u2028", "😀", " ", " ", " ", " ", "  ", "$$", "_", "<|endoftext|>", "<|end"]
    texts = [None, "", *("".join(rng.choice(some, rng.integers(1, 9))) for _ in range(6000))]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    for column in (texts, pa.array(texts, pa.string()), pa.array(["x", *texts], pa.string())[1:]):
        assert [x.tolist() for x in own.encode(column)] == want
    assert [x.tolist() for _, part in tokens.small_parts(pa.array(texts)) for x in own.encode(part)] == want


def test_other_vocabularies_encode_whole_texts(tmp_path):
    plain = Tokenizer.from_file(VOCABULARY)
    plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    plain.save(str(tmp_path / "other.json"))
    texts = ["one two, three", "of the", " a\nb "]
    assert [x.tolist() for x in tokens.Encoder(str(tmp_path / "other.json")).encode(texts)] == [plain.encode(x).ids for x in texts]


def packed_bins(lengths, parts, carry, fan=4, capacity=256, nearly=2):
    """Sequences after local packing and the tree of merges, as ``pack`` does them."""
    rows = []
    for home in range(parts):
        bins, fill = packing.BestFit(capacity), {}
        for k, length in enumerate(sorted(lengths[home::parts], reverse=True)):
            at, offset = bins.put(int(length), (home << 36) + k)
            fill[at] = offset + int(length)
        rows += [(b, f, home) for b, f in fill.items()]
    rows = pd.DataFrame(rows, columns=["bin", "fill", "home"])
    count = len(rows)
    rows = rows[rows["fill"] < capacity - nearly]
    while parts > 1:
        parts = -(-parts // fan)
        rows["home"] //= fan
        done = pd.concat([packing._merge(capacity, carry, nearly)(g) for _, g in rows.groupby("home")])
        count -= int((done["bin"] != done["host"]).sum())
        rows = done[done["on"]][["bin", "fill", "home"]].copy()
    return count


@pytest.mark.parametrize("low,high", [(1, 256), (1, 60), (60, 200), (100, 140)])
def test_carrying_a_bin_for_each_partition_loses_no_sequence(low, high):
    for seed in range(4):
        lengths = np.random.default_rng(seed).integers(low, high, 6000)
        bounded, unbounded = packed_bins(lengths, 32, 32), packed_bins(lengths, 32, 10**9)
        assert bounded <= unbounded


def test_thousands_of_secrets_in_one_text(spark):
    """Lists of spans are joined in order, and spans that overlap base ones are left out."""
    rng = np.random.default_rng(2)
    hex_ = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    text = " ".join(f"é token={hex_(30)}" if i % 3 else hex_(26) for i in range(2500))
    got = secrets.spans(spark.createDataFrame([(1, text), (2, "internationalisation configurationmanager")], "doc_id long, text string")).where("id = 1").first()
    want = [(m.start(), 0, m.end()) for m in re.finditer(r"token=([a-z0-9]+)", text)] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]{24,}", text)]
    assert [(s.start, s.rank, s.end) for s in got.base] == sorted(want)
    assert not got.extra


def test_vectors_with_clashing_columns_and_long_vectors(spark):
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(5000)
    rows = [(i, (centre + 0.01 * rng.standard_normal(5000)).tolist(), 1, i, "x") for i in range(4)] + [(9, None, 1, 3, None)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, component_id int, kept string"))
    assert {(r.id, r.n_links, r.component_id) for r in got.collect()} == {(0, 3, 0), (1, 3, 0), (2, 3, 0), (3, 3, 0), (9, 0, 9)}
