"""Vectorised views of Arrow text columns: bytes, words and rolling hashes.

Helpers for the operators that run inside ``mapInArrow``.  A batch is cut into chunks of about
``CHUNK_BYTES`` (a longer text is a chunk of its own), so a task's memory does not depend on the size
of its partition.  A null text counts as empty everywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
NULL_ID = -(1 << 63)  # a null doc_id sorts first

_U = np.uint64
_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MARK = np.ones(256, bool)  # bytes that are no letter or digit
_MARK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n (kept for the next call)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size <= 4 * CHUNK_BYTES:
            _POWERS[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, so that every bit of a hash depends on every input bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def range_sums(values: np.ndarray, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums for :func:`range_hash_of`; ``values`` are bytes or 64-bit numbers."""
    if values.dtype == np.uint8:
        values = _BYTE_VALUES[values]
    up, down = _powers(_BASES[base], len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return sums, down


def range_hash_of(prepared: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums, down = prepared
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = 0) -> np.ndarray:
    """Hash of ``values[start:end]`` for every pair, from one pass of prefix sums.

    Equal runs of values have equal hashes wherever they stand.  The length is part of the hash.
    """
    return range_hash_of(range_sums(values, base), start, end)


class Chunk:
    """Some rows: their ids, their bytes and the place of each text in the bytes."""

    def __init__(self, ids, data: np.ndarray, off: np.ndarray):
        self.ids, self.data, self.off = ids, data, off
        self.n = len(off) - 1

    def int_ids(self) -> np.ndarray:
        return np.asarray(pc.fill_null(self.ids.cast(pa.int64()), NULL_ID))

    def lower(self) -> np.ndarray:
        """The bytes with A-Z in lower case."""
        return _LOWER[self.data]

    def words(self, lower: bool = False) -> "Words":
        return Words(self.lower() if lower else self.data, self.off)

    def plain_words(self) -> "Words":
        """Lower-cased runs of letters, digits and non-ASCII bytes: marks next to a word are not part of it."""
        return Words(self.lower(), self.off, _MARK)

    def byte_values(self) -> np.ndarray:
        return _BYTE_VALUES[self.data]


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text: byte places, and the words of each row."""

    def __init__(self, data: np.ndarray, off: np.ndarray, blank: np.ndarray = _WS):
        n = len(data)
        inside = ~blank[data]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        opens, closes = inside.copy(), inside.copy()
        if n:
            opens[1:] &= ~inside[:-1] | edge[1:n]
            closes[:-1] &= ~inside[1:] | edge[1:n]
        self.data = data
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.off = np.searchsorted(self.start, off)  # words before each text, one more than texts
        self.n = len(self.start)

    def hashes(self) -> np.ndarray:
        return range_hash(_BYTE_VALUES[self.data], self.start, self.end)

    def windows(self, size: int, whole_if_shorter: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start word, end word and row of every window of ``size`` words inside one text.

        ``whole_if_shorter``: a text with fewer words (but some) is one window.
        """
        counts = np.diff(self.off)
        last = np.repeat(self.off[1:], counts)
        at = np.arange(self.n)
        rows = np.repeat(np.arange(len(counts)), counts)
        full = at + size <= last
        end = np.minimum(at + size, last)
        if whole_if_shorter:
            full |= (at == np.repeat(self.off[:-1], counts)) & (np.repeat(counts, counts) < size)
        return at[full], end[full], rows[full]


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", ids: str = "doc_id",
           limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Chunks of at most ``limit`` bytes of text (or one longer text)."""
    for rb in batches:
        col = rb.column(rb.schema.get_field_index(text))
        if col.null_count:
            col = pc.fill_null(col, "")
        key = rb.column(rb.schema.get_field_index(ids))
        raw, off = _bytes(col)
        i = 0
        while i < len(col):
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
            yield Chunk(key.slice(i, j - i), raw[off[i]:off[j]], off[i:j + 1] - off[i])
            i = j


def _bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    bufs = col.buffers()
    if len(col) == 0 or bufs[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(bufs[1], kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def spans_from(rows: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Unions of the intervals of each row, for input sorted by (row, start)."""
    if not len(rows):
        return rows, start, end
    shift = rows * (int(end.max()) + 2)  # rows apart
    top = np.maximum.accumulate(end + shift)
    new = np.ones(len(rows), bool)
    new[1:] = start[1:] + shift[1:] > top[:-1]
    first = np.flatnonzero(new)
    return rows[first], start[first], np.append(top[first[1:] - 1], top[-1]) - shift[first]
