"""Passages of 50 words that an earlier document already has are removed.

Method: a count-min prefilter and an exact second pass.

1. A window's sketch key is the smallest hash of the 16-word grams inside it.  Equal windows have equal
   keys, so the number of documents with a key is never below the number with any of its windows, and
   neighbouring windows mostly share one key.  Every chunk sends its saturating counters (one or more) as sparse
   cells of a two-row count-min sketch; the cells are summed by slice, and those that reach two
   documents are kept as bits.  A window whose cells lack that bit occurs in one document only.
2. The other windows are grouped exactly by a 64-bit hash of their words.  A chunk first groups its own: it sends a
   window once, from its smallest document, so a passage in a third of all documents costs one row a chunk.
   The smallest document overall keeps the window; the places in the other documents return by a key of id and text.

Scale: the sketch has a fixed number of cells (2 x 2**``bits``), so the broadcast is bounded by
``2 ** bits / 4`` bytes (at most 64 MB).  When more keys than cells exist it lets more windows through, and the
exact pass does more work; the result does not change.

Defined results: null text has no words; a null doc_id sorts before all others; rows of one doc_id (or null), repeated or with
different texts, take nothing from each other, since none has the smaller id, and each loses only its own words; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import doc_key, only, row_key, shuffle_slices
from claimlens.llm.packed import one_row_per_document, pack, schema
from claimlens.llm.textbytes import Chunk, Words, chunks, range_hash

WINDOW = 50
GRAM = 16
MIN_BITS, MAX_BITS = 18, 28
ROWS = 2
FLUSH_BYTES = 24 << 20
_U = np.uint64


def sketch_bits(docs: DataFrame) -> int:
    """Cells per sketch row: about eight for each expected key, within the bounds."""
    chars = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return int(np.clip(np.ceil(np.log2(max(chars, 1) / 10)), MIN_BITS, MAX_BITS))


def _windows(chunk: Chunk, window: int, gram: int):
    """Words, word hashes, window starts, their rows and their sketch keys."""
    w = chunk.words()
    h = w.hashes()
    at, end, rows = w.windows(window)
    if not len(at):
        return w, h, at, rows, np.zeros(0, np.uint64)
    i = np.arange(w.n - gram + 1)
    low = range_hash(h, i, i + gram, 1)
    return w, h, at, rows, _sliding_min(low, window - gram + 1)[at]


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` neighbours, by doubling."""
    have = 1
    while have * 2 <= size:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (size - have)], x[size - have:]) if size > have else x


def _cells(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = _U((1 << bits) - 1)
    return [((keys >> _U(32 * r)) & mask if r == 0 else (keys * _U(0x9FB21C651E98DF25)) >> _U(64 - bits)).astype(np.int64)
            for r in range(ROWS)]


def repeated_cells(docs: DataFrame, bits: int, window: int, gram: int) -> list[np.ndarray]:
    """Per sketch row the packed bits of the cells that two or more documents reach."""
    slices = min(64, shuffle_slices(docs))
    width = -(-(1 << bits) // slices // 8) * 8  # cells per slice

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, limit=FLUSH_BYTES // 4):
            _, _, _, rows, keys = _windows(chunk, window, gram)
            order = np.lexsort((rows, keys))
            keys, rows = keys[order], rows[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
            for r, cell in enumerate(_cells(keys[new], bits)):
                cell, n = np.unique(cell, return_counts=True)
                cut = np.searchsorted(cell, np.arange(slices + 1) * width)
                full = [s for s in range(slices) if cut[s] < cut[s + 1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r * slices + s for s in full], pa.int32()),
                    pa.array([(cell[cut[s]:cut[s + 1]] - s * width).astype("<u4").tobytes() for s in full], pa.binary()),
                    pa.array([np.packbits(n[cut[s]:cut[s + 1]] > 1).tobytes() for s in full], pa.binary()),
                ], ["slice", "cells", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for rb in batches:
            for s, cells, twice in zip(*(rb.column(k).to_pylist() for k in range(3))):
                cell = np.frombuffer(cells, "<u4")
                have = counts.setdefault(s, np.zeros(width, np.uint8))
                more = 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=len(cell))
                have[cell] = np.minimum(2, have[cell] + more)
        for s, have in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([np.packbits(have > 1).tobytes()], pa.binary())],
                                             ["slice", "bits"])

    sent = docs.mapInArrow(part, "slice int, cells binary, twice binary")
    merged = sent.repartition(slices * ROWS, "slice").mapInArrow(merge, "slice int, bits binary")
    out = [np.zeros(slices * width // 8, np.uint8) for _ in range(ROWS)]
    for r in merged.toLocalIterator(prefetchPartitions=True):  # ROWS * 2**bits / 8 bytes in all
        s = r["slice"] % slices
        out[r["slice"] // slices][s * width // 8:(s + 1) * width // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _first_docs(h: np.ndarray, doc: np.ndarray, pos: np.ndarray, row: np.ndarray):
    """Sorted by (hash, doc, row, pos), with the smallest document of each entry's hash."""
    order = np.lexsort((pos, row, doc, h))
    h, doc, pos, row = h[order], doc[order], pos[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    return h, doc, pos, row, doc[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]


def later_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int | None = None) -> DataFrame:
    """``(_key, places)``: start words of windows that a document with a smaller id also has.

    ``_key`` is the ``row_key``; ``places`` holds little-endian 32-bit word numbers; one row per key that has any.
    """
    docs = docs.select(F.struct(doc_key().alias("doc"), row_key().alias("row")).alias("doc_id"), "text")
    bits = bits or sketch_bits(docs)
    repeated = docs.sparkSession.sparkContext.broadcast(repeated_cells(docs, bits, window, gram))
    slices = shuffle_slices(docs)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = turn = 0

        def flush():
            h, doc, pos, key, first = _first_docs(*(np.concatenate([x[k] for x in held]) for k in range(4)))
            send = doc == first  # the others are known to be later
            s = (h >> _U(40)).astype(np.int64) % slices
            for own in (False, True):
                some = np.flatnonzero(~send) if own else np.flatnonzero(send)
                some = some[np.argsort(s[some], kind="stable")]
                cut = np.searchsorted(s[some], np.arange(slices + 1))
                for k in range(slices):
                    i = some[cut[k]:cut[k + 1]]
                    if len(i):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([k], pa.int32()), pa.array([own])]
                            + [pa.array([x[i].tobytes()], pa.binary()) for x in (h, doc, pos, key)],
                            ["slice", "own", "hashes", "docs", "places", "rows"])

        for chunk in chunks(batches):
            w, hashes, at, rows, keys = _windows(chunk, window, gram)
            some = np.ones(len(keys), bool)
            for bitmap, cell in zip(repeated.value, _cells(keys, bits)):
                some &= (bitmap[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0
            at, rows = at[some], rows[some]
            doc, key = (np.asarray(x) for x in chunk.ids.flatten())
            held.append((range_hash(hashes, at, at + window), doc[rows], (at - w.off[rows]).astype(np.int32), key[rows]))
            size += 28 * len(at)
            if size > FLUSH_BYTES:
                yield from flush()
                held, size, turn = [], 0, turn + 1
        if held:
            yield from flush()

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        late = []
        for rb in batches:
            for k, own, h, d, p, r in zip(*(rb.column(x).to_pylist() for x in range(6))):
                doc, pos, key = np.frombuffer(d, np.int64), np.frombuffer(p, np.int32), np.frombuffer(r, np.int64)
                if own:
                    late.append((key, pos))
                else:
                    parts.setdefault(k, []).append((np.frombuffer(h, np.uint64), doc, pos, key))
        for k in list(parts):
            got = parts.pop(k)
            _, doc, pos, key, first = _first_docs(*(np.concatenate([x[j] for x in got]) for j in range(4)))
            late.append((key[doc > first], pos[doc > first]))
        if late:
            key, pos = (np.concatenate([x[j] for x in late]) for j in range(2))
            yield from pack(slices, key, ["places"], [pos])

    sent = docs.mapInArrow(candidates, "slice int, own boolean, hashes binary, docs binary, places binary, rows binary")
    found = sent.repartition(slices // 4, "slice").mapInArrow(decide, schema(["places"]))
    return one_row_per_document(found, slices, ["places"], ["<i4"])


def covered_words(w: Words, places: list, window: int) -> np.ndarray:
    """Which words of the chunk lie in one of each row's windows; no place reaches into the next row."""
    edge = np.zeros(w.n + 1, np.int64)
    for row, raw in enumerate(places):
        if raw is not None:
            p = np.unique(np.frombuffer(raw, "<i4")) + w.off[row]
            p = p[p + window <= w.off[row + 1]]
            edge[p] += 1
            edge[p + window] -= 1
    return np.cumsum(edge)[:-1] > 0


def joined_words(w: Words, keep: np.ndarray) -> list[bytes]:
    """The kept words of each row, joined by one space."""
    i = np.flatnonzero(keep)
    n = w.end[i] - w.start[i] + 1
    stop = np.cumsum(n)
    total = int(stop[-1]) if len(stop) else 0
    src = np.repeat(w.start[i] - (stop - n), n) + np.arange(total)
    out = np.append(w.data, np.uint8(32))[src] if total else np.zeros(0, np.uint8)
    out[stop - 1] = 32
    raw = out.tobytes()
    place = np.concatenate([[0], stop])[np.searchsorted(i, w.off)]
    return [raw[a:b - 1] if b > a else b"" for a, b in zip(place[:-1].tolist(), place[1:].tolist())]


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int | None = None,
                   keep_text: bool = True) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256[, kept])`` for every row of ``docs``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = later_windows(docs, window, gram, bits)
    rows = only(docs, "doc_id", "text", row_key().alias("_key")).join(found, "_key", "left").select("doc_id", "text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            places, done = rb.column(2), 0
            for chunk in chunks([rb]):
                w = chunk.words()
                gone = covered_words(w, places.slice(done, chunk.n).to_pylist(), window)
                done += chunk.n
                kept = joined_words(w, ~gone)
                lost = np.concatenate([[0], np.cumsum(gone)])[w.off]
                out = [chunk.ids, pa.array(np.diff(w.off), pa.int64()), pa.array(np.diff(lost), pa.int64()),
                       pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                if keep_text:
                    out.append(pa.array(kept, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"][:len(out)])

    return rows.mapInArrow(cut, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text)
