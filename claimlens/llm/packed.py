"""Many small (document, values) entries as few packed rows.

Tasks return entries for documents spread over the whole table.  Packed by a hash of the document, a task returns at
most one row per slice instead of one per document, and one reduce turns them into one row per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimlens.llm.textbytes import mix


def schema(names: list[str]) -> str:
    return ", ".join(["slice int", "docs binary"] + [f"{n} binary" for n in names])


def pack(slices: int, doc: np.ndarray, names: list[str], cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows ``(slice, docs, *names)`` of equally long little-endian arrays."""
    s = (mix(doc.astype(np.uint64)) % np.uint64(slices)).astype(np.int64)
    order = np.argsort(s, kind="stable")
    cut = np.searchsorted(s[order], np.arange(slices + 1))
    full = np.flatnonzero(cut[1:] > cut[:-1]).tolist()
    parts = [[c[order[cut[k]:cut[k + 1]]].tobytes() for k in full] for c in (doc.astype("<i8"), *cols)]
    yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32())] + [pa.array(p, pa.binary()) for p in parts], ["slice", "docs", *names])


def one_row_per_document(packed: DataFrame, slices: int, names: list[str], types: list) -> DataFrame:
    """``(_key, *names)``: the entries of each document in one row, its arrays in one order."""
    kinds = [np.dtype(t) for t in types]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_slice: dict[int, list] = {}
        for rb in batches:
            for s, *raw in zip(*(rb.column(k).to_pylist() for k in range(2 + len(names)))):
                by_slice.setdefault(s, []).append([np.frombuffer(x, t) for x, t in zip(raw, ["<i8", *kinds])])
        for s in list(by_slice):
            got = by_slice.pop(s)
            doc, *cols = (np.concatenate([g[k] for g in got]) for k in range(1 + len(names)))
            order = np.argsort(doc, kind="stable")
            ids, first = np.unique(doc[order], return_index=True)
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids)] + [pa.array([x.tobytes() for x in np.split(c[order], first[1:])], pa.binary()) for c in cols], ["_key", *names])

    dealt = packed.select("slice", "docs", *names).repartition(max(1, slices // 4), "slice")
    return dealt.mapInArrow(run, ", ".join(["_key long"] + [f"{n} binary" for n in names]))
