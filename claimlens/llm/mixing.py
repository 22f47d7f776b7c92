r"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sources in code-point order (null last) weigh 1, 2, 3, 1, ...; each gets its share of all words, but at most
``MAX_EPOCHS`` times its own, and the excess is shared again by weight (water filling, in closed form).

Each source's documents stand in an order fixed by a hash of their id and are cut into blocks of about ``block_words``
words.  A target is whole passes over the source plus the first part of one more; that makes a number of blocks, the
source's *quota*.  The quotas of all sources are split among the output shards by a binary tree: a node draws, from a
multivariate hypergeometric distribution, which blocks go left, so every shard gets a random mix, and the quotas are
met exactly.  A shard then owns consecutive, disjoint blocks of each source's permuted list and orders its documents
by another hash.

Scale: words are counted in the scan; the order inside a source is made in (source, hash bucket) windows with offsets
of earlier buckets, so a source with a third of all rows is spread over 4,096 tasks, and the order inside a shard is made the
same way; text joins once, at the end.  The driver
holds one row per source (at most ``MAX_SOURCES``); the tree is grown in tasks of ``TREE_SHARDS`` shards.

Defined results: null text has size 0 and takes 0 words; null source is a source; documents of one id follow each other
in the order (their size, then equal rows); every row counts on its own; an empty table gives an empty table; other columns are carried by
``mix`` and ignored by ``taken_words``.  Only ids, sizes and the seed decide, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.llm.common import boxed, doc_key, groups_for, unboxed, write_table

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 9
BLOCK_WORDS = 20_000
SHARD_WORDS = 20_000_000
MAX_SOURCES = 1_000_000
TREE_SHARDS = 256
BUCKET_HEX = 3
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> list[float]:
    """Words that each source should give, for sources in order."""
    total = sum(sizes)
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    order = sorted(range(len(sizes)), key=lambda i: (max_epochs * sizes[i] / w[i], i))
    capped, weight = 0, sum(w)
    level = 0.0
    for i in order:
        level = (total - capped) / weight
        if level <= max_epochs * sizes[i] / w[i]:
            break
        capped += max_epochs * sizes[i]
        weight -= w[i]
    return [float(max_epochs * s) if max_epochs * s / x < level else level * x for s, x in zip(sizes, w)]


def leaves(quotas: np.ndarray, shards: int, lo: int, hi: int, seed: int = SEED) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(shard, first, count)`` for the shards lo..hi-1: the blocks that each gets of every source, and how many earlier shards got.

    Every node of the tree draws from a seed of its own, so any part of the tree can be grown from the root without the rest.
    """
    stack = [(0, shards, np.zeros(len(quotas), np.int64), np.asarray(quotas, np.int64))]
    while stack:
        a, b, first, q = stack.pop()
        if b <= lo or a >= hi:
            continue
        if b - a == 1:
            yield a, first, q
            continue
        mid = (a + b) // 2
        n = int(q.sum())
        left = n * (mid - a) // (b - a)
        rng = np.random.default_rng([seed, a, b])
        part = rng.multivariate_hypergeometric(q, left, method="marginals") if 0 < left < n else np.where(left > 0, q, 0)
        stack += [(mid, b, first + part, q - part), (a, mid, first, part)]


def drawn_blocks(spark: SparkSession, quotas: list[int], shards: int, seed: int = SEED, per_task: int = TREE_SHARDS) -> DataFrame:
    """``(_src, _from, _count, shard)``: the tree's leaves, grown in tasks of ``per_task`` shards each; one number per source is broadcast."""
    shared = spark.sparkContext.broadcast(np.array(quotas, np.int64))
    tasks = groups_for(shards, per_task)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for t in rb.column(0).to_pylist():
                for shard, first, count in leaves(shared.value, shards, t * per_task, min(shards, (t + 1) * per_task), seed):
                    src = np.flatnonzero(count)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (src, first[src], count[src], np.full(len(src), shard))],
                                                     ["_src", "_from", "_count", "shard"])

    return spark.range(0, tasks, 1, tasks).mapInArrow(grow, "_src long, _from long, _count long, shard long")


def _size():
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size")


def sized(docs: DataFrame) -> DataFrame:
    """``(_key, doc_id, source, size, _rep)`` rows: ``_rep`` numbers the rows of one id."""
    rows = docs.select(doc_key().alias("_key"), "doc_id", "source", _size())
    return rows.withColumn("_rep", F.row_number().over(_same_id()))


def _same_id():
    return Window.partitionBy("_key").orderBy("size", F.col("source").asc_nulls_last())


def ordered(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``_start``: the words that stand before a row in its source's order."""
    rows = rows.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
    rows = rows.withColumn("_bkt", F.substring("_h", 1, BUCKET_HEX))
    inside = Window.partitionBy("source", "_bkt").orderBy("_h", "_key", "_rep").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    sums = rows.groupBy("source", "_bkt").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("source").orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.select(F.col("source").alias("_s"), F.col("_bkt").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (rows.join(offs, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bkt") == F.col("_b")))
            .withColumn("_start", F.col("_off") + F.col("_in")).drop("_s", "_b", "_off", "_in", "_bkt", "_h"))


def plan(rows: DataFrame) -> list[tuple]:
    """``(source, size, target)`` in order, from one small aggregate."""
    got = rows.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(got) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    got = sorted(((r["source"], int(r["n"])) for r in got), key=lambda x: (x[0] is None, x[0] if x[0] is not None else ""))
    return [(s, n, t) for (s, n), t in zip(got, targets([n for _, n in got]))]


def _with_source(rows: DataFrame, sources: list[tuple]) -> DataFrame:
    """Rows with ``_src``, ``source_size`` and ``target``."""
    table = rows.sparkSession.createDataFrame([(i, *x) for i, x in enumerate(sources)], "_src long, _s string, source_size long, target double")
    return rows.join(table, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def _planned(rows: DataFrame, sources: list[tuple]) -> DataFrame:
    """Rows with ``source_size``, ``target`` and ``copies``, the number that the mix must draw."""
    out = _with_source(ordered(rows), sources)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - passes * F.col("source_size")
    return out.withColumn("copies", (passes + (F.col("_start") + F.col("size") / 2 < rest).cast("long")).cast("long"))


def taken_words(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row; ``taken`` counts the copies that the mix drew."""
    rows = write_table(sized(docs), "sized")
    sources = plan(rows)
    drawn = write_table(assignments(rows, sources), "drawn").groupBy("_key", "_rep").agg(F.count("*").alias("_n"))
    return _with_source(rows, sources).join(drawn, ["_key", "_rep"], "left").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.coalesce("_n", F.lit(0))).alias("taken"))


def assignments(rows: DataFrame, sources: list[tuple], block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
                seed: int = SEED) -> DataFrame:
    """``(_key, _rep, copy, shard, position)``: one row per document copy in the mix."""
    spark = rows.sparkSession
    blocks = [max(1, math.ceil(n / block_words)) for _, n, _ in sources]
    quotas = [math.ceil(t / n * b + 1e-9) if n else 0 for (_, n, t), b in zip(sources, blocks)]
    shards = max(1, math.ceil(sum(t for _, _, t in sources) / shard_words))
    drawn = drawn_blocks(spark, quotas, shards, seed).select(
        "_src", "shard", F.explode(F.expr("sequence(_from, _from + _count - 1)")).alias("_block"))
    out = _planned(rows, sources).where("copies > 0").select(
        "_key", "_rep", "_src", "_start", "source_size", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
    per = F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words))
    # block of the copy in its source's list; the last pass may end inside a block, and empty documents stand at the very end
    place = F.least(F.floor(F.col("_start") * per / F.greatest(F.col("source_size"), F.lit(1))), per - 1)
    out = out.withColumn("_block", ((F.col("copy") - 1) * per + place).cast("long"))
    out = out.join(drawn, ["_src", "_block"]).select("_key", "_rep", "copy", "shard", F.xxhash64("_key", "_rep", "copy", F.lit(seed)).alias("_h"))
    return _positions(write_table(out.withColumn("_bkt", F.shiftright("_h", 64 - 4 * BUCKET_HEX)), "dealt"))


def _positions(dealt: DataFrame) -> DataFrame:
    """The local shuffle: ``position`` in the order of ``_h``, whose high bits are ``_bkt``, so that a shard is many tasks."""
    inside = Window.partitionBy("shard", "_bkt").orderBy("_h", "_key", "_rep", "copy")
    before = Window.partitionBy("shard").orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offs = dealt.groupBy("shard", "_bkt").agg(F.count("*").alias("_n")).select("shard", "_bkt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (dealt.withColumn("_in", F.row_number().over(inside)).join(offs, ["shard", "_bkt"])
            .select("_key", "_rep", "copy", "shard", (F.col("_off") + F.col("_in")).alias("position")))


def mix_rows(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """The mix as ``(row, shard, position)``, ``row`` holding the columns of ``docs``; a document stands there once per copy."""
    rows = write_table(sized(docs), "sized")
    sources = plan(rows)
    numbered = boxed(docs, doc_key().alias("_key"), _size(), F.col("source"))
    if not any(t for _, _, t in sources):
        return numbered.where("false").select("row", F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("position"))
    picked = assignments(rows, sources, block_words, shard_words, seed)
    return (numbered.withColumn("_rep", F.row_number().over(_same_id())).join(picked, ["_key", "_rep"])
            .select("row", "shard", "position"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """The columns of ``docs`` in the order of the mix: each output shard is one sorted run."""
    rows = mix_rows(docs, block_words, shard_words, seed)
    return unboxed(rows.repartition("shard").sortWithinPartitions("shard", "position"), docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('9:' || doc_id) AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM d GROUP BY source),
r AS (SELECT *, (rn - 1) % 3 + 1 AS w, (3 * n)::DOUBLE / ((rn - 1) % 3 + 1)::DOUBLE AS ratio FROM s),
c AS (
  SELECT *, (sum(n) OVER ())::BIGINT - ((sum(3 * n) OVER (ORDER BY ratio, rn ROWS UNBOUNDED PRECEDING))::BIGINT - 3 * n) AS open_words,
         (sum(w) OVER ())::BIGINT - ((sum(w) OVER (ORDER BY ratio, rn ROWS UNBOUNDED PRECEDING))::BIGINT - w) AS open_weight
  FROM r),
l AS (
  SELECT open_words::DOUBLE / open_weight::DOUBLE AS level FROM c
  WHERE open_words::DOUBLE / open_weight::DOUBLE <= ratio ORDER BY ratio, rn LIMIT 1),
t AS (SELECT source, n, CASE WHEN ratio < level THEN (3 * n)::DOUBLE ELSE level * w END AS target FROM c, l),
o AS (
  SELECT d.doc_id, d.size, t.n, t.target,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id ROWS UNBOUNDED PRECEDING))::BIGINT - d.size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, n AS source_size, target,
       (size * (CASE WHEN n > 0 THEN floor(target / n)::BIGINT ELSE 0 END
        + (before + size / 2 < target - (CASE WHEN n > 0 THEN floor(target / n)::BIGINT ELSE 0 END) * n)::INT))::BIGINT AS taken
FROM o"""
