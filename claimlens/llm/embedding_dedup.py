"""Near-duplicate vectors by int8 tile products with rigorous quantisation error bounds.

Every vector x of length 1 is stored as int8 numbers q with one scale s; its error e = |x - s q| is known exactly.  For two vectors
|x.y - s t (q.r)| <= e + f + e f.  A tile multiplies two blocks of int8 numbers (sums stay below 2**24, so the product in
single precision is exact); only pairs whose product plus error reaches the threshold are computed again in double precision, and only
these decide.  No pair is lost and none is guessed.

* Equal vectors are one class: they enter the tiles once and are counted by their number of rows.
* Classes are dealt to the nearest of at most ``MAX_CELLS`` pivots (fitted on ``SAMPLE`` classes), a cell's classes by hash to blocks of
  at most about ``block`` vectors.  Two cells whose angles prove that no pair reaches the threshold have no tiles.  On data without any
  clusters nothing can be excluded, and all pairs of blocks are compared: exact search in many dimensions has no cheaper rigorous bound.
* A tile returns one row for each class that has a link there: the number of linked rows, and one link of a spanning forest.
  So a large group of near copies returns as many rows as it has members, never its pairs.  The forests are joined by ``components``.

Scale: a task holds two blocks and one product of ``PART`` x ``PART``; the driver holds the pivots and one count per cell.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing (0 links, their own component); vectors
of different lengths link with nothing; rows with equal vectors are linked; repeated rows count as vectors of their own; a null id is its own
component's smallest id and shows as null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import NULL_ID, components, doc_key, groups_for, write_table

THRESHOLD = 0.9
BLOCK, MAX_CELLS, SAMPLE = 8192, 64, 4096
BLOCK_BYTES = 32 << 20  # of double-precision numbers: longer vectors get smaller blocks
PART = 2048
EXACT_PAIRS = 1 << 14
SLACK = 1e-9  # above the rounding of all double-precision steps
EXACT_DIMS = (1 << 24) // 127 ** 2  # so many int8 products sum exactly in single precision


def usable(v: str) -> Column:
    """Vectors that can link: all components are finite numbers, one of them is not zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 numbers, scale and error of every row of unit vectors."""
    s = np.abs(x).max(axis=1) / 127
    q = np.rint(x / s[:, None])
    err = x - q * s[:, None]
    return q.astype(np.int8), s, np.sqrt((err * err).sum(1)) + SLACK


def _product(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    kind = np.float32 if q.shape[1] <= EXACT_DIMS else np.float64
    return q.astype(kind) @ r.astype(kind).T


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (rows of x, rows of y) with cosine >= threshold; ``same``: x is y, each pair once, without itself."""
    (q, s, e), (r, t, f) = quantise(x), quantise(y)
    for i in range(0, len(x), PART):
        for j in range(i if same else 0, len(y), PART):
            si, ei, tj, fj = s[i:i + PART], e[i:i + PART], t[j:j + PART], f[j:j + PART]
            g = _product(q[i:i + PART], r[j:j + PART])
            gap = threshold - (ei + fj.max() + ei * fj.max())  # least product that can reach the threshold, for the block's worst scale
            need = np.where(gap > 0, gap / (si * tj.max()), gap / (si * tj.min()))
            a, b = np.nonzero(g >= np.nextafter(need.astype(g.dtype), g.dtype.type(-np.inf))[:, None])
            keep = si[a] * tj[b] * g[a, b] + ei[a] + fj[b] + ei[a] * fj[b] >= threshold - SLACK
            if same:
                keep &= i + a < j + b
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            if len(a) > g.size // 32:  # a dense part: one product in double precision
                ok = (x[i:i + PART] @ y[j:j + PART].T)[a, b] >= threshold
            else:
                ok = np.concatenate([np.einsum("ij,ij->i", x[i + a[c:c + EXACT_PAIRS]], y[j + b[c:c + EXACT_PAIRS]]) >= threshold
                                     for c in range(0, len(a), EXACT_PAIRS)])
            yield i + a[ok], j + b[ok]


def _join_labels(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest node reachable by the links so far, for every node."""
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return label
        u, v = u[apart], v[apart]
        low = np.minimum(a, b)[apart]
        np.minimum.at(label, np.maximum(a, b)[apart], low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


def _tile(threshold: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        ids = [np.frombuffer(x, "<i8") for x in pdf["ids"]]
        rows = [np.frombuffer(x, "<i8") for x in pdf["rows"]]
        vecs = [unit(np.frombuffer(x, "<f8").reshape(len(i), -1)) for x, i in zip(pdf["vectors"], ids)]
        same = len(ids) == 1
        base = 0 if same else len(ids[0])
        label = np.arange(sum(map(len, ids)))
        links = np.zeros(len(label), np.int64)
        for a, b in tile_links(vecs[0], vecs[-1], threshold, same):
            links[:len(ids[0])] += np.bincount(a, weights=rows[-1][b], minlength=len(ids[0])).astype(np.int64)
            links[base:base + len(ids[-1])] += np.bincount(b, weights=rows[0][a], minlength=len(ids[-1])).astype(np.int64)
            label = _join_labels(label, a, base + b)
        every = np.concatenate(ids)
        some = links > 0
        return pd.DataFrame({"cls": every[some], "root": every[label[some]], "links": links[some]})

    return run


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block as one row."""
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "cell": [int(pdf["cell"].iloc[0])], "ids": [pdf["cls"].to_numpy("<i8").tobytes()],
                         "rows": [pdf["rows"].to_numpy("<i8").tobytes()],
                         "vectors": [np.stack(pdf["vector"].to_list()).astype("<f8").tobytes()]})


def fit_pivots(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """``k`` unit pivots of unit vectors: far-apart starts, then means."""
    at, near = [0], x @ x[0]
    while len(at) < k:
        at.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[at[-1]])
    p = x[at]
    for _ in range(rounds):
        own = np.argmax(x @ p.T, axis=1)
        sums = np.zeros_like(p)
        np.add.at(sums, own, x)
        size = np.sqrt((sums * sums).sum(1, keepdims=True))
        p = np.where(size > SLACK, sums / np.maximum(size, SLACK), p)
    return p


def _assign(shared):
    """Cell of every class (its dimension and nearest pivot) and the cosine to the pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, pivots = shared.value
        for rb in batches:
            dims = np.asarray(rb.column("dim"))
            cell, cos = np.zeros(len(dims), np.int64), np.zeros(len(dims))
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                x = unit(np.asarray(rb.column("vector").take(pa.array(at)).flatten(), np.float64).reshape(len(at), d))
                for c in range(0, len(at), PART):
                    g = x[c:c + PART] @ pivots[d].T
                    own = np.argmax(g, axis=1)
                    cell[at[c:c + PART]] = first[d] + own
                    cos[at[c:c + PART]] = g[np.arange(len(own)), own]
            yield pa.RecordBatch.from_arrays([rb.column("cls"), pa.array(cell), pa.array(cos)], ["cls", "cell", "cos"])

    return run


def _cells(classes: DataFrame, block: int) -> tuple[DataFrame, list[dict]]:
    """``(cls, cell, cos)`` of every class, and per cell its pivot, dimension, size and radius."""
    dims = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one row per vector length
    first, pivots, cells = {}, {}, []
    for d, n in sorted(dims.items()):
        rows = classes.where(F.col("dim") == d).orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).select("vector").collect()
        x = unit(np.array([r["vector"] for r in rows], np.float64))
        first[d] = len(cells)
        pivots[d] = fit_pivots(x, min(MAX_CELLS, groups_for(n, 4 * block), len(x)))
        cells += [{"dim": d, "pivot": p, "n": 0, "radius": 0.0} for p in pivots[d]]
    shared = classes.sparkSession.sparkContext.broadcast((first, pivots))
    dealt = write_table(classes.mapInArrow(_assign(shared), "cls long, cell long, cos double"), "vector-cells")
    for r in dealt.groupBy("cell").agg(F.count("*").alias("n"), F.min("cos").alias("cos")).collect():  # one row per cell
        cells[r["cell"]] |= {"n": r["n"], "radius": math.acos(max(-1.0, min(1.0, r["cos"] - SLACK)))}
    return dealt, cells


def _near_cells(cells: list[dict], threshold: float) -> list[list[int]]:
    """For every cell the cells that can hold a partner of its members."""
    reach = math.acos(max(-1.0, min(1.0, threshold))) + 1e-6

    def near(a: dict, b: dict) -> bool:
        if a["dim"] != b["dim"] or not a["n"] or not b["n"]:
            return False
        return math.acos(max(-1.0, min(1.0, float(a["pivot"] @ b["pivot"])))) <= a["radius"] + b["radius"] + reach

    return [[j for j, b in enumerate(cells) if i == j or near(a, b)] for i, a in enumerate(cells)]


def class_links(classes: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``(cls, root, links)`` per tile: the class's linked rows there, and the smallest class it reaches inside the tile."""
    spark = classes.sparkSession
    dealt, cells = _cells(classes, block)
    parts = [groups_for(c["n"], max(1, min(block, BLOCK_BYTES // (8 * c["dim"])))) for c in cells]
    start = np.concatenate([[0], np.cumsum(parts)]).tolist()
    near = _near_cells(cells, threshold)
    plan = spark.createDataFrame([(i, start[i], parts[i], [start[j] for j in near[i]], [start[j] + parts[j] - 1 for j in near[i]])
                                  for i in range(len(cells))] or [], "cell long, first long, parts long, lo array<long>, hi array<long>")
    rows = dealt.join(F.broadcast(plan.select("cell", "first", "parts")), "cell").withColumn(
        "block", F.col("first") + F.pmod(F.xxhash64("cls"), F.col("parts")))
    rows = rows.join(classes, "cls").select("block", "cell", "cls", "rows", "vector")
    blocks = write_table(rows.groupBy("block").applyInPandas(
        _pack, "block long, cell long, ids binary, rows binary, vectors binary"), "vector-blocks")
    partners = F.flatten(F.transform(F.arrays_zip("lo", "hi"), lambda r: F.sequence(r["lo"], r["hi"])))
    tiles = blocks.join(F.broadcast(plan.select("cell", partners.alias("partners"))), "cell").withColumn("other", F.explode("partners"))
    tiles = tiles.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    return write_table(tiles.groupBy("low", "high").applyInPandas(_tile(threshold), "cls long, root long, links long"), "vector-links")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding)``."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine above 0")
    rows = vectors.select(doc_key("vec_id").alias("_key"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.withColumn("vector", F.when(usable("vector"), F.col("vector")))
    classes = rows.where("vector is not null").groupBy("vector").agg(F.min("_key").alias("low"), F.count("*").alias("rows"))
    classes = write_table(classes.select(F.monotonically_increasing_id().alias("cls"), "vector", F.size("vector").alias("dim"), "low", "rows"),
                          "vector-classes")
    links = class_links(classes.select("cls", "vector", "dim", "rows"), threshold, block)
    found = components(links.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("cls").agg(F.sum("links").alias("links"))
    known = classes.select("cls", "vector", "low", "rows").join(found.withColumnRenamed("node", "cls"), "cls", "left").join(counts, "cls", "left")
    known = known.withColumn("root", F.coalesce("root", "cls"))
    lowest = known.groupBy("root").agg(F.min("low").alias("component"))
    known = known.join(lowest, "root").select("vector", "component", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"))
    out = rows.join(known, "vector", "left").withColumn("component", F.coalesce("component", "_key"))

    def shown(c: str) -> Column:
        return F.when(F.col(c) != NULL_ID, F.col(c))

    return out.select(shown("_key").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      shown("component").alias("component_id"), (F.col("_key") == F.col("component")).alias("kept"))
