"""Hashes of words and word n-grams, whole batches of texts at a time.

Words are runs of ASCII letters, digits and all non-ASCII bytes, with A-Z lower-cased. Hashes
are 64-bit polynomials of the bytes, mixed; equal words have equal hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C55
_BACK = pow(_BASE, -1, 2**64)
CHUNK_BYTES = 1 << 20

_WORD = np.zeros(256, bool)
for _span in (range(48, 58), range(65, 91), range(97, 123), range(128, 256)):
    _WORD[list(_span)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _BACK, np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def chunks(texts, most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Encoded texts of an Arrow column in groups of about ``most`` bytes, with the place of each
    group's first. Only a few rows at a time become Python objects."""
    first, held, size = 0, [], 0
    for lo in range(0, len(texts), 64):
        for i, text in enumerate(texts.slice(lo, 64).to_pylist(), lo):
            data = (text or "").encode("utf-8", "surrogatepass")
            if held and size + len(data) > most:
                yield first, held
                first, held, size = i, [], 0
            held.append(data)
            size += len(data) + 1
    if held:
        yield first, held


class Words:
    """Hashes of the words of several texts: ``hashes``, ``doc`` of each, ``bounds`` per text."""

    def __init__(self, texts: list[bytes], cache: dict | None = None):
        data = np.frombuffer(b"\0".join(texts).lower() + b"\0", np.uint8)
        cache = {} if cache is None else cache
        if len(cache.get("up", ())) < len(data):
            cache["up"], cache["down"] = powers(max(len(data), CHUNK_BYTES + 1))
        inside = _WORD[data]
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        self.starts, self.ends = edge[::2], edge[1::2]
        total = np.empty(len(data) + 1, np.uint64)
        total[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * cache["up"][: len(data)], out=total[1:])
        self.hashes = mix((total[self.ends] - total[self.starts]) * cache["down"][self.starts])
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.text_at = begins[:-1]
        self.bounds = np.searchsorted(self.starts, begins)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.bounds))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the k words from each word on, and whether all k are of one text."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, bool)
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out = out * np.uint64(_BASE) + self.hashes[j : j + n]
        return mix(out), self.doc[:n] == self.doc[k - 1 :]

    def shingles(self, k: int) -> list[np.ndarray]:
        """Per text the hashes of its k-word shingles in order; a shorter text is one shingle."""
        grams, good = self.grams(k)
        out = []
        for lo, hi in zip(self.bounds[:-1], self.bounds[1:]):
            if hi - lo >= k:
                out.append(grams[lo : hi - k + 1])
            elif hi > lo:
                seed = np.uint64(hi - lo)
                for h in self.hashes[lo:hi]:
                    seed = np.uint64((int(seed) * _BASE + int(h)) & (2**64 - 1))
                out.append(mix(np.array([seed])))
            else:
                out.append(np.empty(0, np.uint64))
        return out
