"""Vectorised word scanning for Arrow batches of texts.

A task walks its batch in slices of about ``SLICE`` bytes, so memory follows the slice
(or the longest single text), not the batch.  Texts are scanned as UTF-8 bytes: both word
classes used here keep every non-ASCII byte, so byte runs and code-point runs are the same
words.  Words get 64-bit polynomial hashes from one prefix sum over the slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20

_SPACE = [0x20, *range(0x09, 0x0E)]
#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[_SPACE] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` over lower-cased text: digits, a-z and all non-ASCII
ALNUM = np.ones(256, bool)
ALNUM[:0x30] = False
ALNUM[0x3A:0x61] = False
ALNUM[0x7B:0x80] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_INV = U64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply), so that all output bits depend on all input bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


class _Powers(list):
    """Grows where it is used: it travels empty with the functions that are sent to tasks."""

    def __reduce__(self):
        return _Powers, ([np.ones(1, U64), np.ones(1, U64)],)


_powers = _Powers([np.ones(1, U64), np.ones(1, U64)])


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        m = max(n, SLICE + (SLICE >> 1))
        for k, b in enumerate((_BASE, _INV)):
            p = np.full(m, b, U64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def prefix_hash(b: np.ndarray) -> np.ndarray:
    """Prefix sums of byte values times powers; ``span_hash`` turns two of them into a hash."""
    h = np.empty(len(b) + 1, U64)
    h[0] = 0
    v = _BYTE[b]
    v *= powers(len(b) + 1)[0][: len(b)]
    np.cumsum(v, out=h[1:])
    return h


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hash of ``bytes[start:end]`` for each pair."""
    h = prefix[end] - prefix[start]
    h *= powers(len(prefix))[1][start]
    return mix(h + (end - start).astype(U64) * U64(0xA24BAED4963EE407))


@dataclass
class Slice:
    """Some consecutive texts of a batch as bytes: text i is ``data[bounds[i]:bounds[i + 1]]``."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


def slices(texts: pa.Array, size: int = SLICE) -> Iterator[Slice]:
    """Cut a string array (null: empty text) into slices of about ``size`` bytes, at least one text each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, off, val = texts.buffers()
    off = np.frombuffer(off, np.int64, n + 1, texts.offset * 8)
    val = np.frombuffer(val, np.uint8) if val is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        j = min(j, n)
        yield Slice(i, val[off[i] : off[j]], off[i : j + 1] - off[i])
        i = j


@dataclass
class Words:
    """Words of a slice in order: byte spans, hashes, and ``first[i]:first[i + 1]`` are text i's words."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z become a-z, other bytes stay."""
    return _LOWER[data]


def words(s: Slice, kind: np.ndarray) -> Words:
    """Lower-case A-Z and find the words of ``kind`` (a 256-entry class table) in a slice."""
    low = lower(s.data)
    n = len(low)
    inside = kind[low]
    edge = np.zeros(n + 1, bool)
    edge[s.bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return Words(low, start, end, span_hash(prefix_hash(low), start, end), np.searchsorted(start, s.bounds))


def chain(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes (none when there are fewer words)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, U64)
    p, inv = powers(len(h) + 1)
    c = np.empty(len(h) + 1, U64)
    c[0] = 0
    np.cumsum(h * p[: len(h)], out=c[1:])
    return mix((c[n:] - c[:m]) * inv[:m] + U64(n))


def signed(h: np.ndarray) -> np.ndarray:
    """Same bits as a Spark ``long``."""
    return h.view(np.int64)
