"""Repeated lines against a plain pass over all documents; the filters against sets."""

import hashlib

import numpy as np

from recordloom.llm import lines

LICENCE = "Permission is hereby granted, free of charge"


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))


def brute(rows):
    """(text kept, lines, dropped) per row, in order."""
    holders = {}
    for i, text in rows:
        for key in {key_of(x) for x in (text or "").split("\n")}:
            if len(key) >= 20:
                holders.setdefault(key, []).append(i)
    keeper = {k: max((i for i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= 3}
    out = []
    for i, text in rows:
        parts = (text or "").split("\n")
        kept = [x for x in parts if key_of(x) not in keeper or keeper[key_of(x)] == i]
        out.append((i, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=repr)


ROWS = [
    (1, f"first own line\n  {LICENCE} \nend"),
    (2, f"{LICENCE.upper()}\n\nother"),
    (3, f"{LICENCE}\n{LICENCE}\r\n{LICENCE}x"),
    (3, f"a row with a repeated id\n{LICENCE}"),
    (None, f"\t{LICENCE}\x0c"),
    (4, None),
    (5, ""),
    (6, "short\nshort\nshort"),
    (7, "short"),
    (8, "short\nnineteen characters"),
    (9, "nineteen characters"),
    (10, "nineteen characters"),
    (11, "äöüäöüäöüäöüäöüäöüäö"),
    (12, "äöüäöüäöüäöüäöüäöüäö"),
    (13, "ÄÖÜäöüäöüäöüäöüäöüäö\näöüäöüäöüäöüäöüäöüäö"),
    (14, "äöüäöüäöüäöüäöüäöüä"),
    (15, "\n" * 50_000 + LICENCE + "\n" + "a very long line " * 20_000),
]


def result(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def test_lines_equal_brute_force(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    assert result(lines.deduplicated(df)) == brute(ROWS)


def test_many_blocks_share_one_line(spark, monkeypatch):
    rows = [(i, f"own line of number {i}, long enough\n{LICENCE}\nline of a tenth {i % 10} of all rows") for i in range(700)]
    monkeypatch.setattr(lines, "BLOCK_ROWS", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(lines.deduplicated(df)) == brute(rows)


def test_other_columns_stay_and_names_may_clash(spark):
    df = spark.createDataFrame([(1, "x", "b", 5, "r"), (2, None, "c", None, "s")], "doc_id long, text string, block string, n_lines int, rest string")
    got = lines.deduplicated(df)
    assert got.columns[:5] == df.columns and len(set(got.columns)) == 7
    assert sorted(map(tuple, got.select(*df.columns).collect())) == [(1, "x", "b", 5, "r"), (2, "", "c", None, "s")]


def test_no_rows(spark):
    assert lines.deduplicated(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_filter_misses_no_repeat_even_when_full(spark, monkeypatch):
    rng = np.random.default_rng(3)
    digests = [hashlib.sha256(rng.bytes(8)).digest() for _ in range(3000)]
    docs = [[d for d in digests if rng.random() < 0.001 or d[0] < 25] + digests[i * 15 : i * 15 + 15] for i in range(200)]
    docs = [list(dict.fromkeys(d)) for d in docs]
    often = {d for d in digests if sum(d in x for x in docs) > 1}
    df = spark.createDataFrame([(d,) for d in docs], "digests array<binary>").repartition(5)
    twice = lines.twice_seen(df)
    found = {d for d in digests if lines._hashes([d])[0] in twice}
    assert often <= found and len(found) < len(often) + 0.2 * len(digests)
    for name, value in (("SLICE_BITS", 1024), ("SLICES", 1), ("_SPAN", 1024)):
        monkeypatch.setattr(lines, name, value)
    full = lines.twice_seen(df)
    assert often <= {d for d in digests if lines._hashes([d])[0] in full}
