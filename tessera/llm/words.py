"""Words, shingles and line pieces of UTF-8 texts, as numpy arrays over an Arrow batch.

Words are ``[^\\x20\\x09-\\x0D]+``. Every word gets a 64-bit hash: a polynomial over its bytes,
taken from prefix sums, then mixed. A shingle's hash mixes the hashes of its words in order.
All functions take whole texts; a batch is worked through in slices of ``SLICE_BYTES``, a
longer text is a slice of its own. Work on a slice holds some ten numbers of 8 bytes for each of
its bytes: with small slices these stay in the processor's cache, and a Python worker that is
kept for other tasks keeps little memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 17
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {"p": np.ones(1, _U), "q": np.ones(1, _U)}

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A byte's value in the polynomial, as it is and in lower case.
_VALUE = {lower: (_LOWER if lower else np.arange(256)).astype(_U) + _U(1) for lower in (False, True)}


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS[kind]
    if len(have) < n:
        base = _BASE if kind == "p" else _INVERSE
        have = np.full(max(n, SLICE_BYTES + 1), base, _U)
        have[0] = 1
        have = np.cumprod(have, dtype=_U)
        _POWERS[kind] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bit mixer of 64-bit values (a bijection)."""
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


@dataclass
class Slice:
    """Consecutive texts of a batch: their bytes and word positions."""

    first: int            # index in the batch of the first text
    raw: np.ndarray       # uint8, the texts' bytes one after another
    offsets: np.ndarray   # int64, len = texts + 1
    starts: np.ndarray    # byte position of each word
    ends: np.ndarray
    word_from: np.ndarray  # int64, len = texts + 1: the words of text i are [word_from[i], word_from[i+1])

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.word_from)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.counts())

    def prefix(self, lower: bool) -> np.ndarray:
        """Prefix sums of the polynomial, one longer than the bytes."""
        terms = _VALUE[lower][self.raw]
        terms *= _powers("p", len(terms))
        out = np.zeros(len(terms) + 1, _U)
        np.cumsum(terms, out=out[1:])
        return out

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
        """Hash of the bytes in each [start, end)."""
        if not len(starts):
            return np.zeros(0, _U)
        sums = self.prefix(lower)
        h = (sums[ends] - sums[starts]) * _powers("q", len(self.raw) + 1)[starts]
        return mixed(h + (ends - starts).astype(_U) * _U(0xA24BAED4963EE407))

    def word_hashes(self, lower: bool = True) -> np.ndarray:
        return self.span_hashes(self.starts, self.ends, lower)

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text the mask marks."""
        sums = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def space(self) -> np.ndarray:
        return _SPACE[self.raw]


def slices(texts: pa.Array | pa.ChunkedArray, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Slices of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1
        end = min(max(end, at + 1), len(texts))
        raw = data[offsets[at]: offsets[end]]
        off = (offsets[at: end + 1] - offsets[at]).astype(np.int64)
        space = _SPACE[raw]
        first = ~space
        first[1:] &= space[:-1]
        edge = off[1:-1]
        edge = edge[edge < len(raw)]
        first[edge] = ~space[edge]          # a text's first byte starts a word whatever stands before it
        last = ~space
        last[:-1] &= space[1:]
        edge = off[1:-1]
        edge = edge[edge > 0]
        last[edge - 1] = ~space[edge - 1]   # and its last byte ends one
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        yield Slice(at, raw, off, starts, ends, np.searchsorted(starts, off).astype(np.int64))
        at = end


_TIMES = np.array([0x9FB21C651E98DF25, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAAAAAAAAAAAAAAAB,
                   0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xE7037ED1A0B428DB, 0x589965CC75374CC3], _U)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of words[i:i+size] for each i with that many words left."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for j in range(size):
        out = mixed(out + words[j: j + n] * _TIMES[j % len(_TIMES)])
    return out


def shingle_runs(groups: np.ndarray, words: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of consecutive groups of words: (hashes, bounds), group i's at [bounds[i], bounds[i+1]).

    ``groups``: bounds of the groups in ``words``. A group of fewer than ``size`` words has its
    whole sequence as one shingle; one without words has none.
    """
    n = np.diff(groups)
    runs = run_hashes(words, size)
    per = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    bounds = np.zeros(len(n) + 1, np.int64)
    np.cumsum(per, out=bounds[1:])
    out = np.zeros(bounds[-1], _U)
    long = n >= size
    if long.any():
        begin = np.repeat(groups[:-1][long] - np.concatenate([[0], np.cumsum(per[long])[:-1]]), per[long])
        place = np.repeat(bounds[:-1][long] - np.concatenate([[0], np.cumsum(per[long])[:-1]]), per[long])
        i = np.arange(per[long].sum())
        out[place + i] = runs[begin + i]
    short = np.flatnonzero((n > 0) & ~long)
    h, left = n[short].astype(_U), np.arange(len(short))
    for j in range(size - 1):  # the groups that have a word j
        left = left[n[short[left]] > j]
        h[left] = mixed(h[left] * _TIMES[0] + words[groups[short[left]] + j])
    out[bounds[short]] = h
    return out, bounds


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    if len(values) > 1:
        values = values[np.concatenate([[True], values[1:] != values[:-1]])]
    return values


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted arrays of distinct values."""
    if not len(a) or not len(b):
        return 0
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
