"""Words of whole texts as bytes, in blocks of bounded size.

A word is a run of ASCII letters, digits and non-ASCII bytes, with A-Z lower-cased. Texts longer
than a block are cut between words, so a block's size doesn't grow with a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_BYTES = 1 << 20

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def _parts(data: bytes, most: int) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        end = data.find(b" ", at + most)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def blocks(texts, most: int = BLOCK_BYTES) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """(words, place of each word's text) of an Arrow column of texts, null as empty.

    A long text's words go on in the next block; texts without words don't show.
    """
    words: list[bytes] = []
    owners: list[int] = []
    counts: list[int] = []
    size = 0
    for lo in range(0, len(texts), 64):
        for i, text in enumerate(texts.slice(lo, 64).to_pylist(), lo):
            data = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
            for part in _parts(data, most):
                found = part.split()
                words += found
                owners.append(i)
                counts.append(len(found))
                size += len(part)
                if size >= most:
                    if words:
                        yield words, np.repeat(np.array(owners, np.int64), counts)
                    words, owners, counts, size = [], [], [], 0
    if words:
        yield words, np.repeat(np.array(owners, np.int64), counts)
