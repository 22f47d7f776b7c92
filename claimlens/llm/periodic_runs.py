"""Periodic runs of words, found by a suffix automaton whose link tree is kept as link-cut paths.

A run is a stretch of words with smallest period q, at least ``min_words`` and ``min_periods`` * q long, that neither neighbour extends.
The automaton of a text grows word by word.  The link tree's states carry the last end of their strings; states with one last
end form a path, and a link-cut tree holds these paths.  Appending word i walks (``access``) from the new state to the root and
recolours the path segments it crosses with i.  A segment with previous end j whose deepest crossed state has length L >= i - j
is a square of period i - j that ends at i.  Its period is the smallest one there: a smaller period would have given the same strings a
later end.  Every square is extended to both sides while words keep the period; one found before is skipped.

Only stretches that can hold a run enter the automaton.  A run of length l and period q gives l - q - ``gram`` + 1 neighbouring places whose
``gram`` words stood before, at most q words earlier, and q is at most (places + gram - 1) / (min_periods - 1).  Places where no such
stretch is left are cut by one sort of a chunk's gram hashes; the rule can only keep too much, so no run is lost.

Scale: one pass over the texts, no shuffle, nothing is gathered.  A task holds one chunk of texts and the automaton of one document's
stretch (about twice as many states as the stretch has words; amortised O(log n) a word).

Defined results: a null or empty text has no words, no runs and an empty collapsed text; repeated rows get equal results; an empty table
gives an empty table; other columns than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import only
from claimlens.llm.quality_rules import let
from claimlens.llm.textbytes import Chunk, chunks, mix, range_hash

MIN_WORDS, MIN_PERIODS = 24, 3
BLANKS = r"[\x20\x09-\x0D]+"
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_U = np.uint64


def squares(words: list[int]) -> Iterator[tuple[int, int, int]]:
    """``(end, period, length)``: the ``length`` >= ``period`` words up to ``end`` also end ``period`` words earlier."""
    follow: list[dict] = [{}, {}]  # state 0: none, state 1: the empty string
    length, link = [0, 0], [0, 0]
    left, right, up = [0, 0], [0, 0], [0, 0]  # splay trees of the paths; a tree's root has the path above it in ``up``
    ends = [-1, -1]  # last end of a path's strings, kept at its tree's root

    def splay(x: int) -> None:
        while True:
            p = up[x]
            if not p:
                return
            if left[p] == x:
                on_left = True
            elif right[p] == x:
                on_left = False
            else:
                return
            g = up[p]
            top, far = p, g
            if g and (left[g] == p or right[g] == p):
                top, far = g, up[g]
                if (left[g] == p) == on_left:  # same side: the grandparent goes below the parent first
                    if on_left:
                        b = left[g] = right[p]
                        right[p] = g
                    else:
                        b = right[g] = left[p]
                        left[p] = g
                    if b:
                        up[b] = g
                    up[g] = p
                else:  # opposite sides: the grandparent takes the subtree next to it
                    if on_left:
                        b = right[g] = left[x]
                        left[x] = g
                    else:
                        b = left[g] = right[x]
                        right[x] = g
                    if b:
                        up[b] = g
                    up[g] = x
            if on_left:
                b = left[p] = right[x]
                right[x] = p
            else:
                b = right[p] = left[x]
                left[x] = p
            if b:
                up[b] = p
            up[p] = x
            up[x] = far
            if far:
                if left[far] == top:
                    left[far] = x
                elif right[far] == top:
                    right[far] = x
            ends[x] = ends[top]

    state = 1
    for i, w in enumerate(words):
        p, state = state, len(length)
        length.append(length[p] + 1)
        follow.append({})
        link.append(1)
        for a in (left, right, up):
            a.append(0)
        ends.append(-1)
        while p and w not in follow[p]:
            follow[p][w] = state
            p = link[p]
        if p:
            q = follow[p][w]
            if length[q] != length[p] + 1:  # a copy with the shorter strings of q goes between q and its link, on the same path
                c = len(length)
                length.append(length[p] + 1)
                follow.append(dict(follow[q]))
                link.append(link[q])
                splay(q)
                above = left[q]
                left.append(above)
                right.append(0)
                up.append(q)
                ends.append(-1)
                if above:
                    up[above] = c
                left[q] = c
                link[q] = c
                while p and follow[p].get(w) == q:
                    follow[p][w] = c
                    p = link[p]
                q = c
            link[state] = q
        up[state] = link[state]
        x, below = state, 0
        while x:
            splay(x)
            end = ends[x]
            if end >= 0 and length[x] >= i - end:
                yield i, i - end, length[x]
            if right[x]:
                ends[right[x]] = end  # the rest of the path keeps its last end
            right[x] = below
            below, x = x, up[x]
        ends[below] = i


def runs_in(words: list[int], stretches: list[tuple[int, int]], min_words: int = MIN_WORDS,
            min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run that meets one of the stretches, ordered by start, then period."""
    n, found = len(words), set()
    for lo, hi in stretches:
        known: dict[int, int] = {}  # period: end of the latest stretch that keeps it
        for end, q, length in squares(words[lo:hi]):
            end += lo
            if known.get(q, -1) > end:
                continue
            start, stop = end - length - q + 1, end + 1
            while start and words[start - 1] == words[start - 1 + q]:
                start -= 1
            while stop < n and words[stop] == words[stop - q]:
                stop += 1
            known[q] = stop
            if stop - start >= max(min_words, min_periods * q):
                found.add((start, stop - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _stretches(h: np.ndarray, off: np.ndarray, min_words: int, min_periods: int) -> list[tuple[int, int]]:
    """Word ranges of a chunk (inside one text each) that can hold a run; ``h`` hashes the words."""
    least = -(-min_words * (min_periods - 1) // min_periods)  # a run's words after its first period
    gram = max(1, min(8, least // 2))
    counts = np.diff(off)
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(np.arange(len(h)) + gram <= off[1:][row])
    if not len(at):
        return []
    key = mix(range_hash(h, at, at + gram) + row[at].astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    later = order[1:][same]
    back = at[later] - at[order[:-1][same]]
    by_place = np.argsort(later)
    at, back = at[later[by_place]], back[by_place]
    while len(at):
        first = np.flatnonzero(np.append(True, np.diff(at) != 1))
        size = np.diff(np.append(first, len(at)))
        reach = (size + gram - 1) // (min_periods - 1)
        stay = (back <= np.repeat(reach, size)) & np.repeat(size >= least - gram + 1, size)
        if stay.all():
            lo = np.maximum(at[first] - reach, off[row[at[first]]])
            hi = at[first + size - 1] + gram
            out: list[tuple[int, int]] = []
            for a, b in zip(lo.tolist(), hi.tolist()):
                if out and a < out[-1][1] and row[a] == row[out[-1][0]]:
                    out[-1] = (out[-1][0], max(b, out[-1][1]))
                else:
                    out.append((a, b))
            return out
        at, back = at[stay], back[stay]
    return []


def _collapse(chunk: Chunk, min_words: int, min_periods: int) -> tuple[list[list[dict]], list[bytes]]:
    w = chunk.words()
    raw = chunk.data.tobytes()
    texts = [b" ".join(raw[a:b].split()) for a, b in zip(chunk.off[:-1].tolist(), chunk.off[1:].tolist())]
    runs: list[list[dict]] = [[] for _ in texts]
    by_row: dict[int, list[tuple[int, int]]] = {}
    found = _stretches(w.hashes(), w.off, min_words, min_periods)
    for (a, b), r in zip(found, (np.searchsorted(w.off, [a for a, _ in found], side="right") - 1).tolist()):
        by_row.setdefault(r, []).append((a - int(w.off[r]), b - int(w.off[r])))
    for r, stretches in by_row.items():
        words = texts[r].split(b" ")
        ids: dict[bytes, int] = {}
        got = runs_in([ids.setdefault(x, len(ids)) for x in words], stretches, min_words, min_periods)
        if got:
            keep = np.ones(len(words), bool)
            for start, length, q in got:
                keep[start + q:start + length] = False
            texts[r] = b" ".join([x for x, k in zip(words, keep.tolist()) if k])
            runs[r] = [{"start": s, "length": n, "period": q} for s, n, q in got]
    return runs, texts


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """``(doc_id, runs, collapsed)``: the runs by start, then period, and the words that no run repeats, joined by one space."""
    if min_periods < 2 or min_words < 2:
        raise ValueError("a run has at least two periods and two words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for chunk in chunks(batches):
            runs, texts = _collapse(chunk, min_words, min_periods)
            yield pa.RecordBatch.from_arrays([chunk.ids, pa.array(runs, kind), pa.array(texts, pa.binary()).cast(pa.string())],
                                             ["doc_id", "runs", "collapsed"])

    docs = only(docs, "doc_id", "text")
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, runs {RUNS}, collapsed string")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``; where crc32(doc_id) is a multiple of ten, the words from place a on repeat with period p (see the query)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def again(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
            words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    planted = let(F.filter(F.split(F.col("text"), BLANKS), lambda x: x != ""), lambda w: F.when(F.size(w) > 0, again(w)).otherwise(F.col("text")))
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def report(runs: DataFrame) -> DataFrame:
    """Number of runs, the one with the greatest length / period, and digests, from the result of :func:`find_runs`."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))

    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    return runs.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        digest(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))).alias("runs_sha256"),
        digest(F.col("collapsed")).alias("collapsed_sha256"))
