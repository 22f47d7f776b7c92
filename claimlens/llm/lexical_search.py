"""Ranked lexical search by range-maximum tables over posting lists.

The documents are indexed in shards of bounded size: the places and counts of every term that an item asks for, by term and document,
next to the documents' ids and lengths.  From the shards come the corpus statistics (documents, terms, documents per term), then each shard is
searched on its own:

* the impact of a posting is the integer share that it adds to a score; a sparse table over the impacts gives the place of the maximum in
  any range of a posting list in two lookups;
* an interval of documents is bounded by the sum of its terms' range maxima.  Intervals are taken best bound first (some at a time); each is
  split at the document of its largest single impact, which is scored in full, and its two sides are bounded and put back;
* an interval whose bound cannot enter the item's best ``k`` is dropped.  The ``k``-th score found so far by a task carries over to the
  shards that it searches next.

The best ``k`` of each task are merged in two steps (by item and salt, then by item).

Scale: texts are read once; the shards are a written table.  Items reach the tasks in groups of about ``ITEM_BYTES`` of text, so
the broadcast is bounded whatever their number; each group is one more pass.  A shard holds at most ``SHARD_POSTINGS`` postings or one
chunk of texts, and no document or term is left out.

Defined results: null texts and texts without terms are no documents of the corpus and match nothing; items without terms have no rows;
repeated documents count as documents of their own; of equal items (id and text) one is ranked, different texts of one id each are; a null id sorts
first; equal scores are ordered by id; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import NULL_ID, groups_for, write_table
from claimlens.llm.textbytes import Words, chunks, range_hash

ITEM_BYTES = 2 << 20
SHARD_POSTINGS = 400_000
SHARD_DOCS = 1 << 14
TOP_K = 50
SALTS = 16
SHARD_SCHEMA = "n_docs long, n_terms long, ids binary, lengths binary, terms array<int>, dfs array<int>, docs binary, tfs binary"


@dataclass
class Lexicon:
    """The items' distinct terms, ordered by hash, and each item's term numbers."""

    hashes: np.ndarray
    data: np.ndarray
    start: np.ndarray
    size: np.ndarray
    items: list[np.ndarray]

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that are a term, and their terms; a hit by hash is compared byte by byte."""
        h = range_hash(words.data, words.start, words.end, base=1)
        term = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        size = words.end - words.start
        hit = np.flatnonzero((self.hashes[term] == h) & (self.size[term] == size))
        term, size = term[hit], size[hit]
        if not len(hit):
            return hit, term
        first = np.cumsum(size) - size
        step = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
        same = words.data[np.repeat(words.start[hit], size) + step] == self.data[np.repeat(self.start[term], size) + step]
        equal = np.logical_and.reduceat(same, first)
        return hit[equal], term[equal]


def lexicon(texts: list[str | None]) -> Lexicon:
    ids, per_item = {}, []
    for chunk in chunks([pa.RecordBatch.from_arrays([pa.nulls(len(texts), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])]):
        w = chunk.plain_words()
        raw = w.data.tobytes()
        for a, b in zip(w.off[:-1], w.off[1:]):
            terms = {raw[s:e] for s, e in zip(w.start[a:b].tolist(), w.end[a:b].tolist())}
            per_item.append([ids.setdefault(t, len(ids)) for t in sorted(terms)])
    size = np.array([len(t) for t in ids], np.int64)
    data = np.frombuffer(b"".join(ids), np.uint8)
    start = np.cumsum(size) - size
    h = range_hash(data, start, start + size, base=1)
    order = np.argsort(h, kind="stable")
    if len(np.unique(h)) < len(h):
        raise ValueError("two terms of a group of items share a hash")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return Lexicon(h[order], data, start[order], size[order], [place[np.array(x, np.int64)] for x in per_item])


def _indexer(shared):
    """Texts to shards (one row each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, parts, n_docs, n_post = shared.value, [], 0, 0

        def shard() -> pa.RecordBatch:
            ids, lengths, doc, term, tf = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(ids, kind="stable")  # places follow the ids, so that equal scores keep their order
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            doc = place[doc]
            by = np.lexsort((doc, term))
            terms, dfs = np.unique(term, return_counts=True)
            row = [len(ids), int(lengths.sum()), ids[order].astype("<i8").tobytes(), lengths[order].astype("<i8").tobytes(),
                   terms.astype(np.int32), dfs.astype(np.int32), doc[by].astype("<i4").tobytes(), tf[by].astype("<i8").tobytes()]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            names = [c.split()[0] for c in SHARD_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

        for chunk in chunks(batches):
            w = chunk.plain_words()
            lengths = np.diff(w.off)
            some = np.flatnonzero(lengths)  # a text without terms is no document
            at, term = lex.find(w) if len(lex.hashes) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            row = np.searchsorted(some, np.searchsorted(w.off, at, side="right") - 1)
            pair, tf = np.unique(row * max(1, len(lex.hashes)) + term, return_counts=True)
            if parts and (n_post + len(pair) > SHARD_POSTINGS or n_docs + len(some) > SHARD_DOCS):
                yield shard()
                parts, n_docs, n_post = [], 0, 0
            doc, term = np.divmod(pair, max(1, len(lex.hashes)))
            parts.append((chunk.int_ids()[some], lengths[some], doc + n_docs, term, tf))
            n_docs, n_post = n_docs + len(some), n_post + len(pair)
        if parts:
            yield shard()

    return run


class Shard:
    """Posting lists with impacts, and a sparse table of the place of the maximum over all of them."""

    def __init__(self, ids, lengths, terms, dfs, docs, tfs, weights: np.ndarray, total_docs: int, total_terms: int):
        self.ids, self.n = ids, len(ids)
        m = 50 + (50 * lengths * total_docs) // total_terms
        self.docs = docs.astype(np.int64)
        self.impact = np.repeat(weights[terms], dfs) * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[self.docs]))
        self.impact = np.append(self.impact, 0)  # what an empty range points to
        self.start = np.cumsum(dfs) - dfs
        self.terms, self.dfs = terms, dfs
        self.key = np.repeat(np.arange(len(terms)), dfs) * self.n + self.docs
        levels = [np.arange(len(docs), dtype=np.int32)]
        while 2 << len(levels) - 1 <= (int(dfs.max()) if len(dfs) else 0):
            low, half = levels[-1], 1 << len(levels) - 1
            a, b = low[:len(low) - half], low[half:]
            up = low.copy()
            up[:len(a)] = np.where(self.impact[a] >= self.impact[b], a, b)
            levels.append(up)
        self.table = np.stack(levels)

    def maximum(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the largest impact of every range [a, b) of postings (of an empty one: the last, whose impact is 0)."""
        size = b - a
        some = size > 0
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        x = self.table[level, np.where(some, a, 0)]
        y = self.table[level, np.where(some, b - (1 << level), 0)]
        return np.where(some, np.where(self.impact[x] >= self.impact[y], x, y), len(self.impact) - 1)

    def search(self, wanted: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best (scores, ids) of ``best`` and of this shard for the terms ``wanted``."""
        if not len(self.terms):
            return best
        t = np.searchsorted(self.terms, wanted)
        t = t[self.terms[np.minimum(t, len(self.terms) - 1)] == wanted]
        if not len(t):
            return best
        at_once = max(1, 20_000 // len(t))
        lo, hi = np.zeros(1, np.int64), np.full(1, self.n)
        a, b = self.start[t][:, None], (self.start[t] + self.dfs[t])[:, None]  # the interval's part of every posting list
        top = self.maximum(a, b)
        bound = self.impact[top].sum(0)
        while True:
            if len(best[0]) >= k:
                least, last = best[0][-1], best[1][-1]
                can = (bound > least) | ((bound == least) & (self.ids[lo] < last))
            else:
                can = bound > 0
            if not can.all():
                lo, hi, a, b, top, bound = lo[can], hi[can], a[:, can], b[:, can], top[:, can], bound[can]
            if not len(lo):
                return best
            if len(lo) > at_once:
                now = np.zeros(len(lo), bool)
                now[np.argpartition(bound, len(lo) - at_once)[len(lo) - at_once:]] = True
            else:
                now = np.ones(len(lo), bool)
            al, bl, tl = a[:, now], b[:, now], top[:, now]
            peak = tl[np.argmax(self.impact[tl], axis=0), np.arange(tl.shape[1])]
            doc = self.docs[peak]  # split each interval at the document of its largest impact
            want = t[:, None] * self.n + doc[None, :]
            mid = np.searchsorted(self.key, want.ravel()).reshape(want.shape)
            has = self.key[np.minimum(mid, len(self.key) - 1)] == want
            score = np.where(has, self.impact[mid], 0).sum(0)
            best = _best(np.append(best[0], score), np.append(best[1], self.ids[doc]), k)
            a2, b2 = np.concatenate([al, mid + has], 1), np.concatenate([mid, bl], 1)
            top2 = self.maximum(a2, b2)
            keep = ~now
            lo = np.concatenate([lo[keep], lo[now], doc + 1])
            hi = np.concatenate([hi[keep], doc, hi[now]])
            bound = np.append(bound[keep], self.impact[top2].sum(0))
            a, b, top = np.concatenate([a[:, keep], a2], 1), np.concatenate([b[:, keep], b2], 1), np.concatenate([top[:, keep], top2], 1)
            lo = np.minimum(lo, self.n - 1)  # an interval after the last document is empty: its bound is 0


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    some = scores > 0
    scores, ids = scores[some], ids[some]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _searcher(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, total_docs, total_terms = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]
        for rb in batches:
            for r in range(rb.num_rows):
                ids, lengths, docs, tfs = (np.frombuffer(rb.column(c)[r].as_py(), t) for c, t in zip(
                    ("ids", "lengths", "docs", "tfs"), ("<i8", "<i8", "<i4", "<i8")))
                terms, dfs = (np.asarray(rb.column(c)[r].values, np.int64) for c in ("terms", "dfs"))
                shard = Shard(ids, lengths, terms, dfs, docs, tfs, weights, total_docs, total_terms)
                for i, wanted in enumerate(items):
                    best[i] = shard.search(wanted, best[i], k)
        n = [len(s) for s, _ in best]
        cols = [np.repeat(np.arange(len(items)), n), *(np.concatenate([b[c] for b in best]) if best else np.zeros(0, np.int64) for c in (1, 0))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["item", "doc_id", "score"])

    return run


def _rank_group(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """``(item, rank, doc_id, score)`` for some items; ``item`` is the place in ``rows``."""
    spark = docs.sparkSession
    lex = lexicon([r["text"] for r in rows])
    index = write_table(docs.mapInArrow(_indexer(spark.sparkContext.broadcast(lex)), SHARD_SCHEMA), "lexical-index")
    total_docs, total_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    df = np.zeros(len(lex.hashes), np.int64)
    pairs = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("p")).groupBy("p.terms").agg(F.sum("p.dfs").alias("df"))
    for term, n in pairs.collect():  # one row per term of the group of items
        df[term] = n
    weights = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    shared = spark.sparkContext.broadcast((lex.items, weights, total_docs, total_terms))
    found = index.mapInArrow(_searcher(shared, k), "item long, doc_id long, score long")
    order = (F.col("score").desc(), F.col("doc_id"))
    some = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*order)
    found = found.withColumn("_n", F.row_number().over(some)).where(F.col("_n") <= k)
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).select(
        "item", "rank", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "score")


def rank(docs: DataFrame, items: DataFrame, k: int = TOP_K) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents with a score above 0 of every item."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = groups_for(size, ITEM_BYTES)
    out = None
    for g in range(groups):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).orderBy("item_id", "text").collect()  # about ITEM_BYTES
        if not rows:
            continue
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item long, item_id {kind}")
        part = _rank_group(docs, rows, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if out is None else out


ORACLE_SQL = r"""
WITH words AS (SELECT doc_id, lang AS _, row_number() OVER () AS row_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS ws
  FROM documents WHERE text IS NOT NULL),
docs AS (SELECT row_id, doc_id, CAST(len(ws) AS BIGINT) AS n, ws FROM words WHERE len(ws) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS docs_n, CAST(sum(n) AS BIGINT) AS terms_n FROM docs),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark WHERE text IS NOT NULL),
tf AS (SELECT row_id, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT row_id, doc_id, n, unnest(ws) AS term FROM docs) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs_n + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term, docs_n),
scores AS (SELECT item_id, row_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs_n) // terms_n)))) AS BIGINT) AS score
  FROM wanted JOIN tf USING (term) JOIN weights USING (term), corpus GROUP BY item_id, row_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""
