"""Operators 3, 5 and 8 against brute force, with copies, hot passages and edge cases."""

import random

import numpy as np
import pytest
from brute import jaccard, repeated_bytes, repeated_windows

from claimlens.llm import ngram_join, substring_dedup, suffix_dedup
from claimlens.llm.count_tree import CountTree
from claimlens.llm.suffix_sort import SuffixSort

SCHEMA = "doc_id long, text string, sig string, _key string, places string"


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    words = lambda n: rnd.choices(vocab, k=n)
    rows = [(1, None), (2, ""), (3, "One two"), (4, "one  TWO"), (5, " \t\n"), (6, "é " * 500)]
    base, hot = words(150), words(70)
    for i in range(40):
        w = list(base)
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(150)] = rnd.choice(vocab)
        rows.append((100 + i, " ".join(w)))
    rows += [(200 + i, " ".join(words(rnd.randint(0, 30)) + hot + words(rnd.randint(5, 60)))) for i in range(40)]
    rows += [(300 + i, " ".join(base)) for i in range(15)]
    chain = words(120)
    for i in range(15):
        chain[rnd.randrange(120)] = rnd.choice(vocab)
        rows.append((400 + i, " ".join(chain)))
    return rows


def frame(spark, rows, parts=3):
    """Rows with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(parts)


def test_jaccard_components(spark, corpus):
    got = ngram_join.jaccard_components(frame(spark, corpus)).collect()
    assert sorted(map(tuple, got)) == jaccard(corpus)
    kept = ngram_join.keep_one_of_each(frame(spark, corpus + corpus[:9]))
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _, c in jaccard(corpus) if d == c)


def test_one_row_of_each_component_stays_when_ids_are_null_or_shared(spark):
    text = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abcd"}
    rows = [(None, text["a"]), (None, text["b"]), (5, text["a"]), (7, text["c"]), (7, text["d"]), (7, text["c"]), (9, text["d"] + " e"),
            (None, "."), (None, ", ;"), (8, text["d"] + " f")]
    kept = ngram_join.keep_one_of_each(frame(spark, rows)).collect()
    assert [r.text for r in kept if r.text in text.values()].count(text["d"]) == 1
    assert sorted(map(str, [(r.doc_id, r.text) for r in kept])) == sorted(map(str, [
        (None, text["a"]), (None, text["b"]), (7, text["c"]), (7, text["d"]), (None, "."), (None, ", ;")]))


def test_tree_finds_every_pair():
    rng = np.random.default_rng(1)
    for n in (1, 2, 40, 300):
        points = rng.poisson(3, (n, 8))
        points[n // 2:] = points[:n - n // 2] + rng.integers(0, 2, (n - n // 2, 8))
        sizes = points.sum(axis=1)
        a, b = CountTree(points, sizes).pairs()
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if 180 * np.minimum(points[i], points[j]).sum() >= 80 * (sizes[i] + sizes[j])}
        assert {(min(p), max(p)) for p in zip(a.tolist(), b.tolist())} == want and len(a) == len(want)


def test_two_stage_suffix_sort():
    rnd = random.Random(2)
    for _ in range(60):
        depth = rnd.choice([3, 9, 20])
        base = bytes(rnd.choices(b"abc", k=200))
        parts = [rnd.choice([base[s:s + 60], b"a" * 60, bytes(rnd.choices(b"ab", k=60))]) for s in (rnd.randrange(120) for _ in range(5))]
        data, count = b"".join(parts), np.full(5, 60 - depth + 1)
        order = SuffixSort(np.frombuffer(data, np.uint8), np.arange(5) * 60, count, depth)
        keys = [data[i:i + depth] for i in order.sa.tolist()]
        assert keys == sorted(keys) and len(set(order.sa.tolist())) == count.sum()
        common = [next((k for k in range(depth) if a[k] != b[k]), depth) for a, b in zip(keys, keys[1:])]
        assert order.common_prefixes().tolist()[1:] == common
        assert order.reaches_depth().tolist()[1:] == [c == depth for c in common]


@pytest.mark.parametrize("parts", [1, 4])
def test_repeated_bytes(spark, corpus, parts):
    rows = [*corpus, (900, "ab" * 700), (901, "x" * 400), (902, "x" * 399), (903, "é" * 1000)]
    got = suffix_dedup.remove_repeats(frame(spark, rows, parts), keep_bytes=False).collect()
    assert sorted(map(tuple, got)) == sorted(repeated_bytes(rows))
    small = suffix_dedup.remove_repeats(frame(spark, rows[:80], parts), length=40, gram=8, keep_bytes=False).collect()
    assert sorted(map(tuple, small)) == sorted(repeated_bytes(rows[:80], 40))


def test_repeated_rows_and_null_ids_of_bytes(spark):
    rows = [(None, "q" * 10 + "0123456789" * 45), (7, "abc" * 200), (7, "abc" * 200)]
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got) == [
        (-1, 460, 450, b"q" * 10), (7, 600, 600, b""), (7, 600, 600, b"")]


@pytest.mark.parametrize("bits", [None, 8])
def test_repeated_windows(spark, corpus, bits):
    """With 2**8 cells the sketch lets every window through; the result is the same."""
    got = substring_dedup.remove_repeats(frame(spark, corpus), keep_text=False, bits=bits).collect()
    assert sorted(map(tuple, got)) == repeated_windows(corpus)


def test_null_id_keeps_its_passage(spark, corpus):
    passage = " ".join(str(i) for i in range(60))
    got = substring_dedup.remove_repeats(frame(spark, [(None, passage), (1, "a " + passage), (1, "a " + passage)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed, r.kept) for r in got) == [(0, 0, passage), (1, 60, "a"), (1, 60, "a")]


def test_empty_tables(spark):
    none = frame(spark, []).where("false")
    assert ngram_join.jaccard_components(none).count() == 0
    assert ngram_join.keep_one_of_each(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0


def test_rows_that_share_an_id_keep_their_own_places(spark):
    """Ids shared by different texts of different lengths (and null ids) change no neighbour's words or bytes."""
    long_a = " ".join(f"alpha{i}" for i in range(200))
    rows = [(7, long_a), (7, "three short words"), (3, long_a), (9, "other text here"), (None, "tiny"), (None, long_a + " tail"), (None, "x" * 900),
            (7, "three short words"), (9, "other " + long_a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    low = -(1 << 63)
    want = repeated_windows([(low if d is None else d, t) for d, t in rows])
    got = sorted((low if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(df).collect())
    assert got == want and any(r[2] for r in want)
    want = sorted(repeated_bytes(rows), key=str)
    assert sorted((tuple(r) for r in suffix_dedup.remove_repeats(df, keep_bytes=False).collect()), key=str) == want
