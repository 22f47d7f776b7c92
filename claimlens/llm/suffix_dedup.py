"""Bytes in any 400-byte string that starts twice are removed, by sorting suffixes.

A suffix array of all text needs all text in one place, so the windows are first dealt out such that equal
ones meet:

1. The key of a 400-byte window is the smallest hash of the 64-byte grams inside it.  A *piece* is a run of
   windows of one text with the same key; every window lies in exactly one piece, and equal windows have equal keys.
   Pieces travel as (key, hash of their bytes, place).  A key with one piece that has its gram once cannot repeat.
   Pieces with the same bytes are one piece with a multiplicity: it is told within a chunk before the shuffle,
   so thousands of copies cost one row a chunk.
2. The bytes of one piece of each content are cut from the texts, meet by key, and their windows are put in order by
   two-stage suffix sorting (:mod:`suffix_sort`).  Neighbours with a common prefix of 400 bytes repeat.
3. The repeated intervals return by a key of id and text; the texts join them once (the same exchange as in step 2).

Defined results: null text is empty; a repeated row is another place, so a text of 400 bytes or more loses
everything in both; rows that share an id, or have none, are documents of their own; shorter texts cannot repeat; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import row_key, shuffle_slices, write_table
from claimlens.llm.packed import one_row_per_document, pack, schema
from claimlens.llm.substring_dedup import _sliding_min
from claimlens.llm.suffix_sort import SuffixSort
from claimlens.llm.textbytes import Chunk, chunks, range_hash_of, range_sums, spans_from

LENGTH = 400
GRAM = 64
FLUSH_PIECES = 400_000
SORT_BYTES = 3 << 20
_U = np.uint64
_PLACE_BITS = 22
_LOW = _U((1 << _PLACE_BITS) - 1)
_I64, _I32 = np.dtype("<i8"), np.dtype("<i4")


def pieces(chunk: Chunk, length: int, gram: int):
    """Row, first window, number of windows (places in the row), key, content hash and whether the gram recurs."""
    data, off = chunk.data, chunk.off
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    sums = range_sums(data)
    at = np.arange(len(data) - gram + 1)
    g = range_hash_of(sums, at, at + gram) & ~_LOW
    place = at.astype(np.uint64) & _LOW
    low = _sliding_min(g | place, length - gram + 1)      # smallest gram, its first place
    high = _sliding_min(g | (_LOW - place), length - gram + 1)  # the same gram, its last place
    n_win = np.maximum(np.diff(off) - length + 1, 0)
    rows = np.repeat(np.arange(chunk.n), n_win)
    start = np.arange(len(rows)) + np.repeat(off[:-1] - (np.cumsum(n_win) - n_win), n_win)
    key = low[start] >> _U(_PLACE_BITS)
    new = np.ones(len(rows), bool)
    new[1:] = (key[1:] != key[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    end = np.append(first[1:], len(rows))
    count = end - first
    a, b, row = start[first], start[end - 1], rows[first]
    recurs = (count > length - gram + 1) | ((low[a] & _LOW) != (_LOW - (high[b] & _LOW)))
    return row, a - off[row], count, key[first], range_hash_of(sums, a, b + length), recurs


def _runs(*sorted_by: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    new = np.ones(len(sorted_by[0]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in sorted_by])
    return new


_FIELDS = ["slice", "keys", "contents", "docs", "starts", "counts", "flags"]
_TYPES = [np.uint64, np.uint64, _I64, _I32, _I32, np.uint8]
SETTLED, RECURS = 1, 2


def _row(k: int, arrays: list) -> pa.RecordBatch:
    """One packed row; arrays that are None are null."""
    return pa.RecordBatch.from_arrays(
        [pa.array([k], pa.int32())] + [pa.array([None if x is None else x.astype(t).tobytes()], pa.binary()) for x, t in zip(arrays, _TYPES)], _FIELDS)


def _ordered(parts: list) -> list[np.ndarray]:
    """Concatenated (key, content, doc, start, count, flag), sorted."""
    cols = [np.concatenate([x[k] for x in parts]) for k in range(6)]
    order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
    return [x[order] for x in cols]


COVER, FETCH = 0, 1
_NAMES = ["starts", "counts", "keys"]
_BY_DOC = schema(_NAMES) + ", kind int"


def _entries(slices: int, kind: int, doc: np.ndarray, start: np.ndarray, count: np.ndarray, key: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    cols = [start.astype(_I32), count.astype(_I32)] + ([] if key is None else [key])
    for rb in pack(slices, doc, _NAMES[:len(cols)], cols):
        if key is None:
            rb = rb.append_column("keys", pa.nulls(rb.num_rows, pa.binary()))
        yield rb.append_column("kind", pa.array([kind] * rb.num_rows, pa.int32()))


def meeting_pieces(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Per document of ``docs(_key, text)``, intervals known to repeat (COVER) and pieces whose bytes must be sorted (FETCH)."""
    slices = shuffle_slices(docs)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = turn = 0

        def flush():
            key, content, doc, start, count, flag = _ordered(held)
            new = _runs(key, content)
            many = ~new | np.append(~new[1:], False)
            # equal pieces all repeat; one of them is sent, as settled
            yield _row(turn % slices, [None, None, doc[many], start[many], count[many], None])
            cols = [x[new] for x in (key, content, doc, start, count, flag | np.where(many, SETTLED, 0).astype(np.uint8))]
            s = (cols[0] % _U(slices)).astype(np.int64)
            order = np.argsort(s, kind="stable")
            cut = np.searchsorted(s[order], np.arange(slices + 1))
            for k in range(slices):
                if cut[k] < cut[k + 1]:
                    yield _row(k, [x[order[cut[k]:cut[k + 1]]] for x in cols])

        for chunk in chunks(batches, ids="_key"):
            row, start, count, key, content, recurs = pieces(chunk, length, gram)
            held.append((key, content, chunk.int_ids()[row], start, count, np.where(recurs, RECURS, 0).astype(np.uint8)))
            size += len(row)
            if size > FLUSH_PIECES:
                yield from flush()
                held, size, turn = [], 0, turn + 1
        if held:
            yield from flush()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_slice: dict[int, list] = {}
        covers: list = []
        fetches: list = []
        for rb in batches:
            for s, *raw in zip(*(rb.column(x).to_pylist() for x in range(7))):
                cols = [None if x is None else np.frombuffer(x, t) for x, t in zip(raw, _TYPES)]
                if cols[0] is None:  # settled by its sender
                    covers.append(cols[2:5])
                else:
                    by_slice.setdefault(s, []).append(cols)
        for s in list(by_slice):
            key, content, doc, start, count, flag = _ordered(by_slice.pop(s))
            new = _runs(key, content)
            many = ~new | np.append(~new[1:], False)
            cover = many & (flag & SETTLED == 0)
            covers.append((doc[cover], start[cover], count[cover]))
            # contents per key: with two, or a gram that recurs, bytes must be compared
            group = np.cumsum(_runs(key)) - 1
            contents = np.bincount(group, weights=new)[group] if len(group) else group
            fetch = new & ((contents > 1) | (flag & RECURS > 0))
            fetches.append((doc[fetch], start[fetch], count[fetch], key[fetch]))
        for kind, found in ((COVER, covers), (FETCH, fetches)):
            if found:
                yield from _entries(slices, kind, *(np.concatenate([x[j] for x in found]) for j in range(len(found[0]))))

    sent = docs.mapInArrow(send, ", ".join(["slice int"] + [f"{x} binary" for x in _FIELDS[1:]]))
    return sent.repartition(slices // 4, "slice").mapInArrow(settle, _BY_DOC)


def sorted_repeats(texts: DataFrame, fetch: DataFrame, length: int) -> DataFrame:
    """COVER rows for the windows that suffix sorting finds repeated among the fetched pieces.

    ``texts`` has (_key, text, doc_id), all of which travel, so that the last join can use the same exchange; ``fetch`` has FETCH rows.
    """
    slices = shuffle_slices(texts)
    wanted = one_row_per_document(fetch, slices, _NAMES, [_I32, _I32, np.uint64])
    rows = texts.join(wanted, "_key").select("_key", "text", *_NAMES, "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            want, done = [rb.column(2 + k) for k in range(3)], 0
            for chunk in chunks([rb], ids="_key"):
                raw, ids = chunk.data.tobytes(), chunk.int_ids().tolist()
                by_slice: dict[int, list] = {}
                for row, lists in enumerate(zip(*(w.slice(done, chunk.n).to_pylist() for w in want))):
                    base = int(chunk.off[row])
                    for s, n, k in zip(*(np.frombuffer(x, t).tolist() for x, t in zip(lists, (_I32, _I32, np.uint64)))):
                        by_slice.setdefault(k % slices, []).append((k, ids[row], s, n, raw[base + s:base + s + n + length - 1]))
                done += chunk.n
                for s, got in by_slice.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s], pa.int32())] + [pa.array([np.array([g[j] for g in got], t).tobytes()], pa.binary())
                                                       for j, t in ((0, np.uint64), (1, _I64), (2, _I32), (3, _I32))]
                        + [pa.array([b"".join(g[4] for g in got)], pa.binary())],
                        ["slice", "keys", "docs", "starts", "counts", "bytes"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_slice: dict[int, list] = {}
        found: list = []
        for rb in batches:
            for s, k, d, st, n, raw in zip(*(rb.column(x).to_pylist() for x in range(6))):
                by_slice.setdefault(s, []).append((np.frombuffer(k, np.uint64), np.frombuffer(d, _I64), np.frombuffer(st, _I32).astype(np.int64),
                                                   np.frombuffer(n, _I32).astype(np.int64), np.frombuffer(raw, np.uint8)))
        for s in list(by_slice):
            key, doc, start, count, raw = (np.concatenate([g[j] for g in by_slice[s]]) for j in range(5))
            del by_slice[s]
            size = count + length - 1
            place = np.cumsum(size) - size
            order = np.argsort(key, kind="stable")
            group = np.flatnonzero(_runs(key[order]))
            ends = np.append(group[1:], len(order))
            upto = np.cumsum(size[order])[ends - 1]
            i = 0
            while i < len(group):  # whole keys, about SORT_BYTES at a time
                j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + SORT_BYTES, side="right")))
                some = order[group[i]:ends[j - 1]]
                n = size[some]
                begin = np.cumsum(n) - n
                text = raw[np.repeat(place[some] - begin, n) + np.arange(int(n.sum()))]
                hit = _repeating(text, begin, count[some], length)
                piece = np.searchsorted(begin, hit, side="right") - 1
                d, a = doc[some][piece], start[some][piece] + hit - begin[piece]
                turn = np.lexsort((a, d))
                d, a = d[turn], a[turn]
                new = _runs(d, a - np.arange(len(a)))
                first = np.flatnonzero(new)
                found.append((d[first], a[first], np.diff(np.append(first, len(a)))))
                i = j
        if found:
            yield from _entries(slices, COVER, *(np.concatenate([x[j] for x in found]) for j in range(3)))

    sent = rows.mapInArrow(cut, "slice int, keys binary, docs binary, starts binary, counts binary, bytes binary")
    return sent.repartition(slices // 4, "slice").mapInArrow(compare, _BY_DOC)


def _repeating(text: np.ndarray, begin: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Places of the windows that equal another one, ascending."""
    order = SuffixSort(text, begin, count, length)
    like = order.reaches_depth()
    both = like | np.append(like[1:], False)
    return np.sort(order.sa[both])


def repeated_intervals(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``(_key, starts, counts)``: per document the runs of windows whose bytes also start elsewhere.

    ``texts`` has (_key, text, doc_id).  The places of meeting pieces are written to the shared folder, since two branches read them.
    """
    met = write_table(meeting_pieces(texts.select("_key", "text"), length, gram), "pieces")
    both = met.where(F.col("kind") == COVER).union(sorted_repeats(texts, met.where(F.col("kind") == FETCH), length))
    return one_row_per_document(both, shuffle_slices(texts), _NAMES[:2], [_I32, _I32])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_bytes: bool = True) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept])`` for every row; ``kept`` is binary."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(row_key().alias("_key"), "text", "doc_id")
    rows = texts.join(repeated_intervals(texts, length, gram), "_key", "left").select("doc_id", "text", "starts", "counts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            done = 0
            for chunk in chunks([rb]):
                starts, counts = (rb.column(k).slice(done, chunk.n).to_pylist() for k in (2, 3))
                spans = [(row, np.frombuffer(x, _I32), np.frombuffer(y, _I32)) for row, (x, y) in enumerate(zip(starts, counts)) if x is not None]
                done += chunk.n
                row = np.repeat(np.array([s[0] for s in spans], np.int64), [len(s[1]) for s in spans])
                a = np.concatenate([s[1] for s in spans]).astype(np.int64) if spans else np.zeros(0, np.int64)
                b = a + (np.concatenate([s[2] for s in spans]) if spans else 0) + length - 1
                inside = b <= np.diff(chunk.off)[row]  # no place may reach into the next text
                row, a, b = row[inside], a[inside], b[inside]
                order = np.lexsort((a, row))
                row, a, b = spans_from(row[order], a[order], b[order])
                edge = np.zeros(len(chunk.data) + 1, np.int8)
                edge[chunk.off[row] + a] += 1
                np.add.at(edge, chunk.off[row] + b, -1)
                keep = np.cumsum(edge[:-1], dtype=np.int8) == 0
                left = chunk.data[keep].tobytes()
                place = np.append(0, np.cumsum(keep))[chunk.off]
                kept = [left[x:y] for x, y in zip(place[:-1].tolist(), place[1:].tolist())]
                n = np.diff(chunk.off)
                out = [chunk.ids, pa.array(n, pa.int64()), pa.array(n - np.diff(place), pa.int64()),
                       pa.array(np.bincount(row, minlength=chunk.n), pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                if keep_bytes:
                    out.append(pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:len(out)])

    return rows.mapInArrow(
        cut, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes)
