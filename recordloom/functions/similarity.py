"""Token-sorted name similarity.

The score of two names is ``200 * lcs / (len(a) + len(b))`` on their sorted tokens, where
``lcs`` is the length of the longest common subsequence. Spark has no such function, so the
subsequence length of pairs that survived every native filter is counted in Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

_WORD_BITS = 64


def sorted_tokens(name: Column) -> Column:
    """Blank-separated tokens in code point order."""
    return F.array_join(F.sort_array(F.split(name, " ")), " ")


def _code_points(texts: list[str], width: int) -> np.ndarray:
    return np.array(texts, dtype=f"<U{max(width, 1)}").view(np.uint32).reshape(len(texts), -1)


def _lcs_long(a: str, b: str) -> int:
    """Bit-parallel count on one Python integer, for texts over one machine word."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """Longest common subsequence length of every pair, all pairs of a batch at a time."""
    out = np.zeros(len(left), dtype=np.int64)
    lengths = np.fromiter(map(len, left), dtype=np.int64, count=len(left))
    short = np.flatnonzero(lengths <= _WORD_BITS)
    for i in np.flatnonzero(lengths > _WORD_BITS):
        out[i] = _lcs_long(left[i], right[i])
    if not len(short):
        return out
    a = _code_points([left[i] for i in short], int(lengths[short].max(initial=0)))
    b_texts = [right[i] for i in short]
    b = _code_points(b_texts, max(map(len, b_texts)))
    bits = np.uint64(1) << np.arange(a.shape[1], dtype=np.uint64)
    row = np.full(len(short), ~np.uint64(0), dtype=np.uint64)
    for j in range(b.shape[1]):
        # padding is code point 0 on both sides: ignore it
        same = (a == b[:, j : j + 1]) & (b[:, j : j + 1] != 0)
        hit = row & (same * bits).sum(axis=1, dtype=np.uint64)
        row = (row + hit) | (row - hit)
    used = lengths[short]
    mask = np.where(
        used == _WORD_BITS,
        ~np.uint64(0),
        (np.uint64(1) << (used % _WORD_BITS).astype(np.uint64)) - np.uint64(1),
    )
    out[short] = np.bitwise_count(~row & mask)
    return out


@F.pandas_udf(IntegerType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(lcs_lengths(a.tolist(), b.tolist()), dtype="int32")


# The planner would move a filter on the count below a duplicate removal and count twice;
# it leaves a function that it takes for non-deterministic where it was put.
lcs_length = lcs_length.asNondeterministic()


def score_of(lcs: Column, length_a: Column, length_b: Column) -> Column:
    """Similarity in percent with two places."""
    return F.rint(lcs * F.lit(20000.0) / (length_a + length_b)) / 100
