"""Whole texts to token ids with the tokenizers library, each distinct piece encoded once.

Byte-level tokenisation never joins text across a single space that follows a non-space, and it
cuts between letters, digits, other signs and line ends. Whole columns are cut there by their
bytes, and the ids of every piece are remembered. Where a part between two spaces holds more than
ASCII, Latin-1 letters and single line ends, or an apostrophe, it is one piece. Texts with white
space that makes cuts unsafe (runs with a space inside, or at the end) are encoded whole, and so
are texts that hold an added token of the vocabulary, which is recognised as in a plain call. The
result equals encoding the whole text, which the tests check.
"""

from __future__ import annotations

import ctypes
import json
import sys
import types
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that remembered pieces may take in a worker; beyond it the memory starts anew.
REMEMBERED = 192 << 20
#: Longer pieces (bytes without spaces) are encoded anew each time.
SHORT = 64
#: Bytes of text that are cut at once; a longer text goes by itself.
AT_ONCE = 1 << 20
_EACH = 180  # bytes of the two objects of a piece and of its place in the table, without contents
#: A space beside these may lie inside a run of white space. All other white space is named too.
_UNSAFE = ("  ", " \n", " \t", " \r", " \x0b", " \x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0")
_UNSAFE_WIDE = "                　"
#: What the byte-level cuts below hold for; other vocabularies encode whole texts.
_CUTS = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}

_SPACE, _LETTER, _DIGIT, _SIGN, _LINE, _OTHER = range(6)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _SIGN
_KIND[[ord("'"), 32, 10]] = _OTHER, _SPACE, _LINE
_KIND[48:58] = _DIGIT
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_RARE = np.zeros(256, bool)  # bytes that start white space named above
_RARE[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
#: The characters by which byte-level models name bytes; byte 0 stands between names here.
_NAMES = "\0" + "".join(chr(b if b in _PLAIN else 256 + sum(c not in _PLAIN for c in range(b))) for b in range(1, 256))
_SIMPLE, _HARD, _WHOLE = range(3)


class Encoder:
    """``encode(texts)`` gives one little-endian unsigned 32-bit array per text, without end id."""

    def __init__(self, path: str, remembered: int | None = None):
        """remembered: bytes that remembered pieces may take, in place of REMEMBERED."""
        from tokenizers import Tokenizer

        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        stated = json.loads(self.tokenizer.to_str())
        cuts = stated["pre_tokenizer"] or {}
        self.cuts = {k: cuts.get(k) for k in _CUTS} == _CUTS and not any(stated[k] for k in ("normalizer", "truncation", "padding"))
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Pieces joined by spaces must not give an added token that none of their texts holds.
        self.joined = 1 if any(" " in x for x in self.added) else 2000
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(names.values()) + 1, bool)
        self.opens[[i for name, i in names.items() if name.startswith("Ġ")]] = True
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def simple(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces that no further cut divides, so the model takes each by its name."""
        out: list[bytes] = []
        for lo in range(0, len(pieces), 2000):
            names = b"\0".join(pieces[lo : lo + 2000]).decode("latin-1").translate(_NAMES).split("\0")
            found = list(map(self.model.tokenize, names))
            ids = np.array([token.id for part in found for token in part], "<u4").tobytes()
            ends = (4 * np.cumsum(list(map(len, found)))).tolist()
            out += map(ids.__getitem__, map(slice, [0, *ends[:-1]], ends))
        return out

    def hard(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces that follow a space in their texts, so joined they are encoded as there."""
        out: list[bytes] = []
        for lo in range(0, len(pieces), self.joined):
            part = pieces[lo : lo + self.joined]
            ids = np.array(self.tokenizer.encode_batch_fast([b"".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self.opens[ids])
            if len(at) != len(part):
                raise AssertionError("a piece holds a space")
            data, ends = ids.tobytes(), [*(4 * at[1:]).tolist(), 4 * len(ids)]
            out += map(data.__getitem__, map(slice, [0, *ends[:-1]], ends))
        return out

    def whole(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([x.decode() for x in texts], add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def learn(self, pieces: list[bytes], kinds: np.ndarray) -> list[bytes]:
        """Ids of pieces; short ones are remembered."""
        follows = np.array([x.startswith(b" ") for x in pieces])
        ids: list[bytes] = [b""] * len(pieces)
        for way, mine in ((self.simple, kinds == _SIMPLE), (self.hard, (kinds == _HARD) & follows), (self.whole, (kinds == _WHOLE) | (kinds == _HARD) & ~follows)):
            places = np.flatnonzero(mine).tolist()
            for at, got in zip(places, way([pieces[at] for at in places])):
                ids[at] = got
        lengths = list(map(len, pieces))
        short = [n <= SHORT for n in lengths]
        self.known.update(compress(zip(pieces, ids), short))
        self.held += _EACH * sum(short) + sum(compress(lengths, short)) + sum(map(len, compress(ids, short)))
        return ids

    def unsafe(self, text: str) -> bool:
        if text[-1].isspace() or any(x in text for x in _UNSAFE) or any(x in text for x in self.added):
            return True
        return not text.isascii() and any(x in text for x in _UNSAFE_WIDE)

    def uncut(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Places of the texts that are encoded whole."""
        full = np.flatnonzero(np.diff(bounds))
        if not self.cuts:
            return full
        odd = [np.flatnonzero((data[:-1] == 32) & _BLANK[data[1:]]), np.flatnonzero(_RARE[data])]
        raw = data.tobytes()
        for token in map(str.encode, self.added):
            at = raw.find(token)
            while at >= 0:
                odd.append(np.array([at]))
                at = raw.find(token, at + 1)
        held = np.unique(np.searchsorted(bounds, np.concatenate(odd), side="right") - 1)
        held = np.union1d(held, full[_BLANK[data[bounds[full + 1] - 1]]])
        return np.array([i for i in held.tolist() if self.unsafe(raw[bounds[i] : bounds[i + 1]].decode())], np.int64)

    def pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces of texts that follow one another start, and how each is encoded."""
        kind = _KIND[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)  # of Latin-1 letters and two signs
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        texts = bounds[:-1][np.diff(bounds) > 0]
        starts = np.ones(len(data), bool)
        before, here = kind[:-1], kind[1:]
        starts[1:] = (here != before) & (before != _SPACE) | (here == _SPACE) | (here == _LINE)
        starts[texts] = True
        uncut = self.uncut(data, bounds)
        for i in uncut.tolist():
            starts[bounds[i] + 1 : bounds[i + 1]] = False
        other = kind == _OTHER
        inner = np.zeros(len(data) + 2, bool)
        inner[1:-1] = (kind != _SPACE) & (kind != _LINE)
        line = np.flatnonzero(kind == _LINE)
        other[line[~(inner[line] & inner[line + 2])]] = True
        other[texts[kind[texts] == _LINE]] = True
        at = np.flatnonzero(starts)
        opening = data[at] == 32
        opening[np.searchsorted(at, texts)] = True
        first = np.flatnonzero(opening)
        # all of a part between spaces is one piece if any of it is of another kind
        hard = np.repeat(np.logical_or.reduceat(other, at[first]), np.diff(np.append(first, len(at))))
        keep = opening | ~hard
        at, way = at[keep], np.where(hard[keep], _HARD, _SIMPLE)
        way[np.searchsorted(at, bounds[uncut])] = _WHOLE
        return at, way

    def encode(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        if self.held > (self.remembered or REMEMBERED):
            self.known.clear()
            self.held = 0
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        bounds = offsets - offsets[0]
        if not bounds[-1]:
            return [np.empty(0, "<u4")] * len(column)
        data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        at, way = self.pieces(data, bounds)
        ends = pa.py_buffer(np.append(at, len(data)))
        cut = pa.Array.from_buffers(pa.large_binary(), len(at), [None, ends, pa.py_buffer(data)]).dictionary_encode()
        codes, _, names = cut.indices.to_numpy(), *cut.dictionary.buffers()[:2]
        edges = np.frombuffer(names, np.int64, len(cut.dictionary) + 1).tolist()
        pieces = list(map(cut.dictionary.buffers()[2].to_pybytes().__getitem__, map(slice, edges, edges[1:])))
        ids = list(map(self.known.get, pieces))
        new = list(compress(range(len(ids)), [x is None for x in ids]))
        if new:
            ways = np.zeros(len(pieces), np.int64)
            ways[codes] = way
            for k, got in zip(new, self.learn([pieces[k] for k in new], ways[new])):
                ids[k] = got
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, begins = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        each = sizes[codes]
        upto = np.concatenate([[0], np.cumsum(each)])
        out = flat[np.repeat(begins[codes] - upto[:-1], each) + np.arange(upto[-1])]
        edges = upto[np.searchsorted(at, bounds)].tolist()
        return [out[a:b] for a, b in zip(edges, edges[1:])]


def encoder(path: str, remembered: int | None = None) -> Encoder:
    """The worker's encoder for a vocabulary file; what it remembers outlives a task."""
    home = sys.modules.setdefault("_recordloom_encoders", types.ModuleType("_recordloom_encoders"))
    if not hasattr(home, "by_path"):
        home.by_path = {}
    if path not in home.by_path:
        home.by_path[path] = Encoder(path)
    home.by_path[path].remembered = remembered
    return home.by_path[path]


def give_back() -> None:
    """Return freed memory to the system, where the C library can; a worker lives on after its task."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_parts(column: pa.Array):
    """A column of texts in parts of about AT_ONCE bytes, so that buffers stay small."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, lo = np.cumsum(sizes), 0
    while lo < len(column):
        before = total[lo] - sizes[lo]
        hi = max(lo + 1, int(np.searchsorted(total, before + AT_ONCE, side="right")))
        yield lo, column.slice(lo, hi - lo)
        lo = hi
