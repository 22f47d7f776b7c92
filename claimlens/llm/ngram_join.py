"""Exact Jaccard join of documents on word n-grams, with count vectors in an R-tree.

A document's set holds its distinct 5-word shingles (lower-cased A-Z) as 64-bit hashes.  Two documents link
when their sets share at least 80 % of the union.

1. One pass counts, in a fixed array of hash groups, how often each group occurs (merged by slice), and gives every
   document its set size, a set signature and its *count vector*: shingles per group of the hash's top bits.
   Documents with the same set are one point from here on, so thousands of copies cost one.
2. Points meet in buckets.  If the shingles are ordered rarest group first, a set's last 80 % can hold at most
   80 % of the shared elements, so similar sets share one of their first ``n - ceil(0.8 n) + 1`` shingles;
   each of those is a bucket, and buckets that turn out to hold the same points are one.  Rare ones first means that a passage which many documents share opens no bucket unless it is
   nearly all of the document.  Buckets with one point vanish in the first reduce.
3. Inside a bucket the vectors bound the overlap by the sum of their coordinate minima.  First a star and a chain of the
   bucket's points (linear in its size; all pairs up to three points) are bounded and verified on the full
   sets, and connected points are merged.  Buckets of four and more points that are still in several components are then
   searched completely: an R-tree of the vectors drops node pairs whose bound is too small, and what survives and would
   join two components is verified.  No link that could change a component is left out.

Output is one row per document with its component; pairs inside groups of copies are never made.

Defined results: null text, or text without words, has an empty set, links with nothing and is its own component; a
text with fewer than five words is one shingle; doc_id tells documents apart (a null doc_id sorts first, and rows that
share one belong together if their sets do); repeated rows give repeated rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import NULL_ID, boxed, components, doc_key, shuffle_slices, text_key, unboxed, write_table
from claimlens.llm.count_tree import CountTree, may_link, overlap_bound
from claimlens.llm.textbytes import Chunk, chunks, mix, range_hash

SHINGLE = 5
PERCENT = 80
GROUP_BITS = 8
ORDERS = 2  # orders in which a bucket's points are starred and chained
MIN_BITS, MAX_BITS = 16, 22
FLUSH = 1_000_000
_U = np.uint64
_VEC = np.dtype("<u4")


def shingle_sets(chunk: Chunk, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row in a row, and where each row's set starts (one more)."""
    w = chunk.words(lower=True)
    at, end, rows = w.windows(size, whole_if_shorter=True)
    h = range_hash(w.hashes(), at, end, 1)
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    h, rows = h[new], rows[new]
    return h, np.searchsorted(rows, np.arange(chunk.n + 1))


def _signatures(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A 63-bit signature of each set (the sum of its mixed hashes, mixed again)."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ _U(0x5851F42D4C957F2D)))])
    n = np.diff(off).astype(np.uint64)
    return (mix(total[off[1:]] - total[off[:-1]] + n * _U(0x9E3779B97F4A7C15)) >> _U(1)).astype(np.int64)


def _vectors(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    rows = np.repeat(np.arange(len(off) - 1), np.diff(off))
    group = (h >> _U(64 - GROUP_BITS)).astype(np.int64)
    return np.bincount(rows << GROUP_BITS | group, minlength=(len(off) - 1) << GROUP_BITS).reshape(-1, 1 << GROUP_BITS)


def _packed_vector(v: np.ndarray) -> bytes:
    """One byte per coordinate, or four if one of them needs more."""
    return v.astype(np.uint8 if v.max() < 256 else _VEC).tobytes()


def _unpacked_vectors(raw: list[bytes]) -> np.ndarray:
    wide = np.fromiter(map(len, raw), np.int64, len(raw)) > 1 << GROUP_BITS
    out = np.empty((len(raw), 1 << GROUP_BITS), _VEC if wide.any() else np.uint8)
    for some, kind in ((wide, _VEC), (~wide, np.uint8)):
        at = np.flatnonzero(some)
        out[at] = np.frombuffer(b"".join([raw[i] for i in at.tolist()]), kind).reshape(-1, 1 << GROUP_BITS)
    return out


def describe(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """Rows ``(_key, _text, n, sig, vec)`` per document and ``(slice, counts)`` per partition and slice of the group counts.

    An empty set has a null signature.
    """
    slices = 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_key", "_text", "n", "sig", "vec", "slice", "counts"]
        counts = np.zeros(1 << bits, np.int64)
        for rb in batches:
            text, at = rb.column(rb.schema.get_field_index("_text")), 0
            for chunk in chunks([rb], ids="_key"):
                h, off = shingle_sets(chunk, size)
                counts += np.bincount((h >> _U(64 - bits)).astype(np.int64), minlength=1 << bits)
                n, k = np.diff(off), chunk.n
                vec = _vectors(h, off)
                yield pa.RecordBatch.from_arrays([
                    pa.array(chunk.int_ids()), text.slice(at, k), pa.array(n, pa.int64()), pa.array(_signatures(h, off), mask=n == 0),
                    pa.array([_packed_vector(v) for v in vec], pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
                at += k
        if counts.any():
            parts = np.minimum(counts, 65535).astype("<u2").reshape(slices, -1)
            yield pa.RecordBatch.from_arrays([
                *(pa.nulls(slices, pa.int64()) for _ in range(4)), pa.nulls(slices, pa.binary()),
                pa.array(range(slices), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names)

    return docs.mapInArrow(run, "_key long, _text long, n long, sig long, vec binary, slice int, counts binary")


def _merged_counts(described: DataFrame, bits: int) -> np.ndarray:
    """Occurrences per hash group, saturated at 65535: 2**(bits + 1) bytes, 8 MB at most."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for rb in batches:
            for s, raw in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                part = np.frombuffer(raw, "<u2").astype(np.int64)
                sums[s] = sums[s] + part if s in sums else part
        for s, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([np.minimum(total, 65535).astype("<u2").tobytes()], pa.binary())],
                                             ["slice", "counts"])

    rows = described.where("slice IS NOT NULL").select("slice", "counts").repartition(16, "slice").mapInArrow(merge, "slice int, counts binary")
    out = np.zeros((16, (1 << bits) // 16), np.uint16)
    for r in rows.toLocalIterator():
        out[r["slice"]] = np.frombuffer(r["counts"], "<u2")
    return out.ravel()


def shared_buckets(docs: DataFrame, counts: np.ndarray, size: int, percent: int, bits: int) -> DataFrame:
    """``(bucket, sig)`` for every bucket with two or more different sets."""
    slices = shuffle_slices(docs)
    common = docs.sparkSession.sparkContext.broadcast(counts)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        n_held = 0

        def flush():
            h, sig = (np.concatenate([x[k] for x in held]) for k in range(2))
            h = mix(h)  # the bucket's number
            s = (h >> _U(32)).astype(np.int64) % slices
            key = h.astype(np.uint32)
            order = np.lexsort((sig, key, s))
            s, key, sig = s[order], key[order], sig[order]
            new = np.ones(len(s), bool)  # a chunk's copies are one
            new[1:] = (s[1:] != s[:-1]) | (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
            s, key, sig = s[new], key[new], sig[new]
            cut = np.searchsorted(s, np.arange(slices + 1))
            for k in range(slices):
                a, b = cut[k], cut[k + 1]
                if a < b:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([key[a:b].tobytes()], pa.binary()), pa.array([sig[a:b].tobytes()], pa.binary())],
                        ["slice", "keys", "sigs"])

        for chunk in chunks(batches, ids="_key"):
            h, off = shingle_sets(chunk, size)
            n = np.diff(off)
            sig = _signatures(h, off)
            rows = np.repeat(np.arange(chunk.n), n)
            order = np.lexsort((h, common.value[(h >> _U(64 - bits)).astype(np.int64)], rows))
            take = n - (-(-percent * n // 100)) + 1
            rank = np.arange(len(h)) - np.repeat(off[:-1], n)
            first = rank < np.repeat(take, n)
            held.append((h[order][first], sig[rows[first]]))
            n_held += int(first.sum())
            if n_held > FLUSH:
                yield from flush()
                held, n_held = [], 0
        if held:
            yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_slice: dict[int, list] = {}
        for rb in batches:
            for s, k, g in zip(*(rb.column(x).to_pylist() for x in range(3))):
                by_slice.setdefault(s, []).append((np.frombuffer(k, np.uint32), np.frombuffer(g, np.int64)))
        for s in list(by_slice):
            got = by_slice.pop(s)
            key, sig = (np.concatenate([x[j] for x in got]) for j in range(2))
            order = np.lexsort((sig, key))
            key, sig = key[order], sig[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
            key, sig = key[new], sig[new]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(key)))
            if len(first):  # buckets with the same points are one
                name = np.repeat(mix(np.add.reduceat(mix(sig.astype(np.uint64)), first)).astype(np.int64), n)
                many = np.repeat(n > 1, n)
                yield pa.RecordBatch.from_arrays([pa.array(name[many]), pa.array(sig[many])], ["bucket", "sig"])

    sent = docs.mapInArrow(send, "slice int, keys binary, sigs binary")
    return sent.repartition(slices // 4, "slice").mapInArrow(meet, "bucket long, sig long").distinct()


def _bucket_arrays(batches: Iterator[pa.RecordBatch]):
    """bucket, sig, size and vectors of a partition, sorted by bucket and a mixed signature."""
    got = [rb for rb in batches if rb.num_rows]
    if not got:
        return None
    t = pa.Table.from_batches(got)
    col = lambda k: t.column(k).to_numpy()
    vec = _unpacked_vectors(t.column("vec").to_pylist())
    salt = (col("bucket") % ORDERS).astype(np.uint64) * _U(0x9E3779B97F4A7C15)
    order = np.lexsort((mix(col("sig").astype(np.uint64) ^ salt), col("bucket")))
    return col("bucket")[order], col("sig")[order], col("n")[order], vec[order], t, order


def _emit(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])


def star_and_chain(entries: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs: each point of a bucket with the bucket's first point and with the one before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _bucket_arrays(batches)
        if got is None:
            return
        bucket, sig, n, vec, _, _ = got
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        hub = np.repeat(first, np.diff(np.append(first, len(bucket))))
        at = np.arange(len(bucket))
        x = np.concatenate([at[at > hub], at[at > hub + 1]])
        y = np.concatenate([hub[at > hub], at[at > hub + 1] - 1])
        near = may_link(np.minimum(n[x], n[y]), n[x], n[y], percent)
        x, y = x[near], y[near]
        near = may_link(overlap_bound(vec[x], vec[y]), n[x], n[y], percent)
        yield _emit(sig[x[near]], sig[y[near]])

    return entries.select("bucket", "sig", "n", "vec").repartition("bucket").mapInArrow(run, "a long, b long").distinct()


def tree_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of different components (``root``) in each bucket, by R-tree search.

    ``entries`` also has ``buckets``, all buckets of the point: a pair is told by the first bucket that both are in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _bucket_arrays(batches)
        if got is None:
            return
        bucket, sig, n, vec, t, order = got
        root = t.column("root").to_numpy()[order]
        lists = t.column("buckets").take(pa.array(order))
        cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
            a, b = CountTree(vec[i:j], n[i:j], percent, root[i:j]).pairs()
            mine = [set(x) for x in lists.slice(i, j - i).to_pylist()] if len(a) else []
            first = np.array([min(mine[x] & mine[y]) == bucket[i] for x, y in zip(a.tolist(), b.tolist())], bool)
            yield _emit(sig[a[first] + i], sig[b[first] + i])

    return entries.select("bucket", "sig", "n", "vec", "root", "buckets").repartition("bucket").mapInArrow(run, "a long, b long").distinct()


def _member_bits(sigs: DataFrame, bits: int) -> np.ndarray:
    """A bit map of the signatures: 2**bits bits, built and merged by slice."""
    slices = 16

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for rb in batches:
            at = _member(rb.column(0).to_numpy(), bits)
            s = at >> (bits - 4)
            for k in np.unique(s).tolist():
                maps.setdefault(k, np.zeros(1 << (bits - 4), bool))[at[s == k] & ((1 << (bits - 4)) - 1)] = True
        for k, m in maps.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(m).tobytes()], pa.binary())], ["slice", "bits"])

    dealt = sigs.select("sig", F.pmod(F.col("sig"), F.lit(slices)).alias("s")).repartition(slices, "s").select("sig")
    out = np.zeros((slices, (1 << bits) // slices // 8), np.uint8)
    for r in dealt.mapInArrow(part, "slice int, bits binary").toLocalIterator():
        out[r["slice"]] |= np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def _member(sig: np.ndarray, bits: int) -> np.ndarray:
    return (mix(sig.astype(np.uint64)) >> _U(64 - bits)).astype(np.int64)


def fetch_sets(texts: DataFrame, sigs: DataFrame, size: int) -> DataFrame:
    """``(sig, set)`` for the signatures in ``sigs``, computed again from the texts.

    A bit map of the signatures (about 16 bits for each, 32 MB at most) keeps the other documents from being sent; what it lets through
    by chance is dropped by the join.
    """
    n = sigs.count()
    bits = int(np.clip(np.ceil(np.log2(16 * max(n, 1))), 16, 28))
    wanted = texts.sparkSession.sparkContext.broadcast(_member_bits(sigs, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for chunk in chunks(batches, ids="_key"):
            h, off = shingle_sets(chunk, size)
            sig = _signatures(h, off)
            at = _member(sig, bits)
            hit = np.flatnonzero((np.diff(off) > 0) & ((wanted.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0)).tolist()
            hit = [i for i in hit if not (int(sig[i]) in seen or seen.add(int(sig[i])))]
            yield pa.RecordBatch.from_arrays([pa.array(sig[hit]), pa.array([h[off[i]:off[i + 1]].tobytes() for i in hit], pa.binary())], ["sig", "set"])

    found = texts.mapInArrow(run, "sig long, set binary").join(sigs, "sig")
    return write_table(found.groupBy("sig").agg(F.first("set").alias("set")), "sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            ok = []
            for x, y in zip(rb.column(2).to_pylist(), rb.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(bool(may_link(both, len(x), len(y), percent)))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([rb.column(0).filter(keep), rb.column(1).filter(keep)], ["a", "b"])

    left = sets.select(F.col("sig").alias("a"), F.col("set").alias("x"))
    right = sets.select(F.col("sig").alias("b"), F.col("set").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct()


def similar_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(_key, _text, n_shingles, root, component_key)`` for every row of ``docs``.

    ``root`` tells components apart, also those that share a smallest id; it is null for an empty set.
    """
    texts = docs.select(doc_key().alias("_key"), "text")
    chars = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = int(np.clip(np.ceil(np.log2(max(chars, 1) / 400)), MIN_BITS, MAX_BITS))
    described = write_table(describe(texts.withColumn("_text", text_key()), size, bits), "sets")
    rows = described.where("slice IS NULL").select("_key", "_text", "n", "sig", "vec")
    points = rows.where("sig IS NOT NULL").groupBy("sig").agg(F.min("_key").alias("_key"), F.min("n").alias("n"), F.min("vec").alias("vec"))
    points = write_table(points, "points")
    shared = write_table(shared_buckets(texts, _merged_counts(described, bits), size, percent, bits), "buckets")

    entries = shared.join(points.select("sig", "n", "vec"), "sig")
    pairs = write_table(star_and_chain(entries, percent), "pairs")
    sets = fetch_sets(texts, _ends(pairs), size)
    links = write_table(verified(pairs, sets, percent), "links")
    roots = write_table(components(links), "roots")
    rooted = shared.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    open_ = rooted.groupBy("bucket").agg(F.count("*").alias("_m"), F.min("root").alias("_a"), F.max("root").alias("_b")).where("_m > 3 AND _a <> _b")
    rest = write_table(rooted.join(open_.select("bucket"), "bucket"), "open")
    lists = rest.groupBy("sig").agg(F.collect_list("bucket").alias("buckets"))  # a point's buckets are fewer than its shingles
    rest = rest.join(points.select("sig", "n", "vec"), "sig").join(lists, "sig")
    pairs = write_table(tree_pairs(rest, percent), "pairs")
    if not pairs.isEmpty():
        others = fetch_sets(texts, _ends(pairs).join(sets.select("sig"), "sig", "left_anti"), size)
        more = verified(pairs, sets.union(others), percent)
        roots = write_table(components(links.union(more)), "roots")
    named = points.select("sig", "_key").join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    least = named.groupBy("root").agg(F.min("_key").alias("component_key"))
    by_sig = named.select("sig", "root").join(least, "root").select("sig", "root", "component_key")
    return rows.select("_key", "_text", "n", "sig").join(by_sig, "sig", "left").select(
        "_key", "_text", F.col("n").alias("n_shingles"), "root", F.coalesce("component_key", "_key").alias("component_key"))


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``."""
    id_type = docs.schema["doc_id"].dataType
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).cast(id_type)
    return similar_documents(docs, size, percent).select(
        back("_key").alias("doc_id"), "n_shingles", back("component_key").alias("component_id"))


def keep_one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, with all columns: its smallest doc_id (null first), of that the smallest text hash.

    Rows without words are components of their own; repeated rows of one id and text are one.
    """
    rows = similar_documents(docs, size, percent).where("_key = component_key")
    some = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("_key").alias("_key"), F.min("_text").alias("_text")).select("_key", "_text")
    kept = some.union(rows.where("root IS NULL").select("_key", "_text").distinct())
    return unboxed(boxed(docs, doc_key().alias("_key"), text_key().alias("_text")).join(kept, ["_key", "_text"])
                   .dropDuplicates(["_key", "_text"]), docs.columns)
