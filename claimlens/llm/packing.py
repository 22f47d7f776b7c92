"""Best-fit packing with certified bin counts.

Documents become token pieces of at most ``capacity`` ids; pieces are placed into sequences of exactly
that room.  Every group of pieces is packed by best-fit decreasing, and dual-feasible functions give a
lower bound of the bins that *any* packing of the group needs.  A group that meets its bound is certified
and stays.  The groups with a gap keep their full bins, exchange the documents of the others (they are
dealt into new groups) and rerun best-fit decreasing, for as long as that saves bins.

Scale: token ids never shuffle, only (doc_id, piece, start, length, crc) rows.  Groups hold about
``per_group`` rows dealt by a hash of a row number, so equal documents and hot sources spread evenly.

Defined results: null text is the empty text (one piece, the closing id alone); repeated rows are packed
as often as they come; a null doc_id is kept; ties go to the smaller row number; an empty table gives an
empty table; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import itertools
import os
import unicodedata
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm.common import groups_for, only, write_table
from claimlens.llm.textbytes import Chunk, chunks, range_hash

CAPACITY = 2048
PER_GROUP = 200_000
CACHE_WORDS = 800_000
ENCODE_BYTES = 1 << 19  # texts encoded at once: the arrays of hashes take some 50 times their bytes
BATCH_ROWS = 1000       # rows sent to a worker at once: whole texts, which stand in the executor and in the worker meanwhile
ENCODE_WORDS = 4096     # unknown words sent to the tokenizer at once: its own records take far more room than the ids

_TOKENIZERS: dict = {}


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


_PUNCTUATION = np.isin(np.arange(256), list(b".,;:!?"))
_ASCII_LETTER = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
_KEEP_CASE = np.arange(256) >= 128
_KEEP_CASE[ord("<")] = True  # special tokens are found before lower-casing


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: bytes without one count up from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Token ids of whole texts from the ids of their words.

    The vocabulary's splitter drops white space, its merges never cross it, and a sentence mark after a letter is a split
    of its own, so a text's ids are the ids of its words and marks in a row.  They are encoded once per worker and found again by
    hash; the store is emptied when it holds ``CACHE_WORDS``.  Spark runs a worker per core, so the tokenizer starts no threads
    of its own, each of which would keep memory.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        # words that are already normal (letters only) go to the model without the normaliser
        self.bare = Tokenizer(self.tok.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.stands_for = _byte_letters()
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self):
        self.known = np.zeros(0, np.uint64)  # sorted hashes
        self.place = np.zeros(0, np.int32)
        self.count = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _normal(self, word: str) -> str | None:
        """The word as the model sees it, if it is letters only and normalising it is plain."""
        if not word.isalpha():
            return None
        if word.isascii():
            return word.lower()
        low = word.lower()
        if "\u03a3" in word or len(low) != len(word) or not low.isalpha() or not unicodedata.is_normalized("NFC", word):
            return None
        return low.encode().decode("latin-1").translate(self.stands_for)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and how many each has, ``ENCODE_WORDS`` at a time."""
        some = [self._encode_some(words[i:i + ENCODE_WORDS]) for i in range(0, len(words), ENCODE_WORDS)]
        return np.concatenate([ids for ids, _ in some]), np.concatenate([count for _, count in some])

    def _encode_some(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        normal = [self._normal(w) for w in words]
        letters = [i for i, w in enumerate(normal) if w is not None]
        ids = np.array(self.bare.encode_batch_fast([" ".join([normal[i] for i in letters])], add_special_tokens=False)[0].ids, np.uint32)
        stop = np.flatnonzero(self.ends[ids]) + 1
        if len(stop) != len(letters):
            letters, ids, stop = [], ids[:0], stop[:0]
        had = set(letters)
        other = [i for i in range(len(words)) if i not in had]
        got = [e.ids for e in self.tok.encode_batch_fast([words[i] for i in other], add_special_tokens=False)]
        count = np.zeros(len(words), np.int64)
        start = np.zeros(len(words), np.int64)
        count[letters], start[letters] = np.diff(stop, prepend=0), np.append(0, stop)[:-1]
        n = np.fromiter(map(len, got), np.int64, len(got))
        count[other], start[other] = n, len(ids) + np.cumsum(n) - n
        flat = np.concatenate([ids, np.fromiter((t for g in got for t in g), np.uint32, int(n.sum()))])
        end = np.cumsum(count)
        return flat[np.repeat(start - (end - count), count) + np.arange(len(flat))], count

    def _units(self, chunk: Chunk):
        """Words and trailing marks: byte places, hashes, and units before each text."""
        w = chunk.words()
        d = w.data
        last, before = w.end - 1, np.maximum(w.end - 2, 0)
        latin = (d[np.maximum(w.end - 3, 0)] == 0xC3) & (d[before] >= 0x80) & (d[before] != 0x97) & (d[before] != 0xB7) & (w.end - w.start > 2)
        cut = (w.end - w.start > 1) & _PUNCTUATION[d[last]] & (_ASCII_LETTER[d[before]] | latin) if w.n else np.zeros(0, bool)
        extra = np.cumsum(cut)
        at = np.arange(w.n) + extra - cut
        start, end = np.empty(w.n + int(cut.sum()), np.int64), np.empty(w.n + int(cut.sum()), np.int64)
        start[at], end[at] = w.start, w.end - cut
        start[at[cut] + 1], end[at[cut] + 1] = last[cut], w.end[cut]
        special = np.append(0, np.cumsum(_KEEP_CASE[d]))
        low = range_hash(chunk.lower(), start, end)
        h = np.where(special[end] > special[start], range_hash(d, start, end), low)
        return start, end, h, w.off + np.append(0, extra)[w.off]

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk's texts in a row, and where each text's ids start (one more)."""
        start, end, h, off = self._units(chunk)
        uniq, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > CACHE_WORDS:
            self.clear()
        at = np.searchsorted(self.known, uniq)
        new = np.ones(len(uniq), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != uniq[inside]
        if new.any():
            raw, i = chunk.data.tobytes(), first[new]
            ids, count = self._encode_words([raw[a:b].decode("utf-8", "replace") for a, b in zip(start[i].tolist(), end[i].tolist())])
            place = len(self.ids) + np.cumsum(count) - count
            self.known = np.insert(self.known, at[new], uniq[new])
            self.place = np.insert(self.place, at[new], place)
            self.count = np.insert(self.count, at[new], count)
            self.ids = np.append(self.ids, ids)
            at = at + np.cumsum(new) - new
        n = self.count[at][back].astype(np.int64)
        stop = np.cumsum(n)
        src = np.repeat(self.place[at][back] - (stop - n), n) + np.arange(int(stop[-1]) if len(stop) else 0)
        return self.ids[src], np.append(0, stop)[off]


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None,
                 keep_ids: bool = False) -> DataFrame:
    """Pieces ``(doc_id, piece, start, length, ids_crc32[, ids])``: ids of the text, then id 0.

    Only a document longer than ``capacity`` is cut, into full pieces and one last, maybe shorter, piece.
    """
    path = path or tokenizer_path()
    fields = "doc_id {}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    docs = only(docs, "doc_id", "text")
    schema = fields.format(docs.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _TOKENIZERS.get(path)
        if enc is None:
            enc = _TOKENIZERS[path] = WordEncoder(path)
        for chunk in chunks(batches, limit=ENCODE_BYTES):
            ids, off = enc.encode(chunk)
            n = np.diff(off) + 1
            pieces = -(-n // capacity)
            row = np.repeat(np.arange(chunk.n), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, n[row] - start)
            full = np.insert(ids, off[1:], 0)  # the closing id after each text
            at = off[row] + row + start
            raw = full.astype("<u4")
            out = [chunk.ids.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                   pa.array([zlib.crc32(raw[a:a + k].tobytes()) for a, k in zip(at.tolist(), length.tolist())], pa.int64())]
            if keep_ids:
                out.append(pa.array([full[a:a + k].astype(np.int32) for a, k in zip(at.tolist(), length.tolist())],
                                    pa.list_(pa.int32())))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(out, names[:len(out)])

    return docs.mapInArrow(run, schema)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of two families of dual-feasible functions.

    ``counts[x]`` is the number of pieces of length x.  For a threshold t up to half a bin, pieces longer
    than ``capacity - t`` count as whole bins and pieces shorter than t as nothing; the rounding family
    lifts x to ``floor((k + 1) x / capacity) / k`` of a bin where that product is no integer.
    """
    x = np.arange(capacity + 1)
    c = counts.astype(np.int64)
    size, number = np.cumsum(c * x), np.cumsum(c)
    t = np.arange(0, capacity // 2 + 1)
    large = number[-1] - number[capacity - t]
    middle = size[capacity - t] - np.where(t > 0, size[np.maximum(t - 1, 0)], 0)
    best = int((large + -(-middle // capacity)).max())
    for k in range(1, 101):
        exact = (k + 1) * x % capacity == 0
        scaled = np.where(exact, k * x, (k + 1) * x // capacity * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((c * scaled).sum()) // (k * capacity)))
    return best


def best_fit(length: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: bin and offset per piece (ties: input order) and the number of bins.

    Open bins are kept by free room; a bit mask finds the tightest room that still fits.
    """
    order = np.argsort(-length, kind="stable")
    bins, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = used = 0
    for i, s in zip(order.tolist(), length[order].tolist()):
        fit = mask >> s
        if fit:
            room = s + (fit & -fit).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, b = capacity, used
            used += 1
        bins[i], offset[i] = b, capacity - room
        left = room - s
        if left:
            rooms[left].append(b)
            mask |= 1 << left
    return bins, offset, used


_PACKED = "_row long, _group long, _bin long, offset long, _used long, _bound long, _open boolean"


def _pack_groups(items: DataFrame, groups: int, seed: int, capacity: int) -> DataFrame:
    """Deal ``items(_row, length)`` into groups by hash and pack each."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row")
        length = pdf["length"].to_numpy()
        bins, offset, used = best_fit(length, capacity)
        fill = np.bincount(bins, weights=length, minlength=used)
        bound = lower_bound(np.bincount(length, minlength=capacity + 1), capacity)
        return pd.DataFrame({"_row": pdf["_row"], "_group": pdf["_group"] + (seed << 24), "_bin": bins, "offset": offset,
                             "_used": used, "_bound": bound, "_open": (fill < capacity)[bins]})

    dealt = items.select("_row", "length", F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(groups)).alias("_group"))
    return dealt.groupBy("_group").applyInPandas(run, _PACKED)


@contextmanager
def _batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside the ``with`` block sends at most ``rows`` rows to a Python worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_group: int = PER_GROUP) -> tuple[DataFrame, dict]:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (with ``length``); also the bin counts.

    The second result has ``bins``, the ``bound`` that no packing of all pieces can beat, and the bins
    after each round.
    """
    with _batches_of(pieces.sparkSession, BATCH_ROWS):
        table = write_table(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    sizes = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    counts = np.zeros(capacity + 1, np.int64)  # at most `capacity` distinct lengths reach the driver
    for k, n in sizes.items():
        counts[k] = n
    total = int(counts.sum())
    # a full piece is a sequence of its own
    full = table.where(F.col("length") == capacity).select("_row", (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items = table.where(F.col("length") < capacity).select("_row", "length")
    left = int(counts[:capacity].sum())
    groups = groups_for(left, per_group)
    placed = write_table(_pack_groups(items, groups, 0, capacity), "packed")
    rounds = [int(_bins(placed))]
    for seed in itertools.count(1):  # ends: each round but the last saves a bin
        gap = placed.where(F.col("_used") > F.col("_bound"))
        pool = gap.where("_open").join(items, "_row")
        n, before = pool.agg(F.count("*"), F.countDistinct("_group", "_bin")).first()
        if groups == 1 or not n:
            break
        groups = groups_for(n, per_group)
        again = write_table(_pack_groups(pool.select("_row", "length"), groups, seed, capacity), "packed")
        after = int(_bins(again))
        if after >= before:
            break
        stay = placed.where("NOT (_open AND _used > _bound)")
        rounds.append(rounds[-1] - before + after)
        placed = write_table(stay.unionByName(again), "packed")
    spots = placed.select("_row", (F.col("_group") * (1 << 24) + F.col("_bin")).alias("sequence_id"), "offset").union(full)
    report = {"bins": rounds[-1] + int(counts[capacity]), "bound": lower_bound(counts, capacity) if total else 0, "rounds": rounds}
    return table.join(spots, "_row").drop("_row"), report


def _bins(placed: DataFrame) -> int:
    return placed.select("_group", "_used").distinct().agg(F.coalesce(F.sum("_used"), F.lit(0))).first()[0]


def sequences(packed: DataFrame) -> DataFrame:
    """The training sequences themselves, from pieces with ``ids``: ``(sequence_id, ids, doc_ids)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most `capacity` ids in all
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    packed, _ = pack(token_pieces(docs, capacity), capacity)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
