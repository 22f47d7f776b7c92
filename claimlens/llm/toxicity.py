"""Toxicity scores by FTRL-proximal logistic regression on hashed word n-grams and skip-grams.

Features are the distinct words, word pairs and pairs that skip one word of a text (lower-cased, marks
stripped), hashed into 2**``BITS`` coordinates.  FTRL-proximal keeps a learning rate per coordinate and an L1
threshold that leaves most weights exactly zero.  A bounded sample of the labelled rows is dealt into ``SHARDS`` groups; in each of
``ROUNDS`` rounds every group goes on learning from the shared state in its own task, and the changes are averaged (parameter mixing).
The few non-zero weights, at most 2**``BITS``
floats (1 MB), are broadcast, and every whole text is scored in one pass without a shuffle.

``MAX_TRAIN`` bounds the labelled rows that are learned: those with the smallest hash of their id, held-out rows excluded.

Defined results: null text and text without words score the bias alone; labels of null doc_id, null labels and labels without a document are
ignored; of repeated labels the larger counts; without any label every score is 0.5; a null doc_id is not held out; repeated
rows get equal scores; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import only, write_table
from claimlens.llm.textbytes import Chunk, chunks, mix, range_hash

BITS = 18
SHARDS, ROUNDS = 4, 4
MAX_TRAIN = 24_000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 0.0
THRESHOLD = 0.3
_U = np.uint64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Coordinate and row of every word, word pair and skip pair of a chunk, repeats included."""
    w = chunk.plain_words()
    h = range_hash(w.data, w.start, w.end)
    out, rows = [h], [np.repeat(np.arange(chunk.n), np.diff(w.off))]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        at, _, row = w.windows(gap + 1)
        out.append(mix(h[at] * _U(salt) + h[at + gap]))
        rows.append(row)
    return (np.concatenate(out) >> _U(64 - BITS)).astype(np.int64), np.concatenate(rows)


class Ftrl:
    """The learner's state: z and n per coordinate, the last coordinate being the bias (never thresholded)."""

    def __init__(self, z: np.ndarray | None = None, n: np.ndarray | None = None):
        self.z = np.zeros((1 << BITS) + 1) if z is None else z
        self.n = np.zeros((1 << BITS) + 1) if n is None else n

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def bias(self) -> float:
        return float(-self.z[-1] / ((BETA + np.sqrt(self.n[-1])) / ALPHA + L2))

    def learn(self, rows: list[np.ndarray], labels: np.ndarray) -> None:
        for x, y in zip(rows, labels):
            w, b = self.weights(x), self.bias()
            g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - y
            for at, value in ((x, w), (-1, b)):
                step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
                self.z[at] += g - step * value
                self.n[at] += g * g


def _learner(shared, turn: int):
    """One group's pass from the shared state: the changes of its coordinates."""

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable").sample(frac=1.0, random_state=turn)
        rb = pa.RecordBatch.from_arrays([pa.array(pdf["doc_id"]), pa.array(pdf["text"], pa.string(), from_pandas=True)], ["doc_id", "text"])
        xs = []
        for chunk in chunks([rb]):
            x, row = features(chunk)
            both = np.unique(row << BITS | x)
            xs += np.split(both & ((1 << BITS) - 1), np.searchsorted(both, np.arange(1, chunk.n) << BITS))
        own = Ftrl(*(x.copy() for x in shared.value))
        own.learn(xs, pdf["toxic"].to_numpy())
        at = np.flatnonzero(own.n != shared.value[1])
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "at": [at.astype("<i4").tobytes()],
                             "z": [(own.z[at] - shared.value[0][at]).tobytes()], "n": [(own.n[at] - shared.value[1][at]).tobytes()]})

    return learn


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """Weights and bias, learned from labelled rows that are not held out."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)  # two numbers a row: under 1 MB
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = write_table(rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SHARDS))), "labelled")
    state = Ftrl()
    for turn in range(ROUNDS):
        shared = docs.sparkSession.sparkContext.broadcast((state.z, state.n))

        got = rows.groupBy("shard").applyInPandas(_learner(shared, turn), "shard long, at binary, z binary, n binary").collect()
        # at most SHARDS states of 2**BITS coordinates reach the driver
        state = Ftrl(state.z.copy(), state.n.copy())
        for r in sorted(got, key=lambda r: r["shard"]):
            at = np.frombuffer(r["at"], "<i4")
            state.z[at] += np.frombuffer(r["z"]) / len(got)
            state.n[at] += np.frombuffer(r["n"]) / len(got)
    return state.weights()[:-1].astype(np.float32), state.bias()


def score(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """``(doc_id, score)`` for every row."""
    docs = only(docs, "doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = model.value
        for chunk in chunks(batches):
            x, row = features(chunk)
            some = w[x] != 0
            both = np.unique(row[some] << BITS | x[some])  # each coordinate counts once a text
            total = np.bincount(both >> BITS, weights=w[both & ((1 << BITS) - 1)], minlength=chunk.n) + b
            yield pa.RecordBatch.from_arrays([chunk.ids, pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], ["doc_id", "score"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``."""
    s = score(docs, *fit(docs, labels))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
