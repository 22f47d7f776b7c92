"""Embedding near-duplicates, lexical search and periodic runs against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from brute import sha, words

from claimlens.llm import embedding_dedup as E
from claimlens.llm import lexical_search as L
from claimlens.llm import periodic_runs as P

DOCS = "doc_id long, text string"


# ---------------------------------------------------------------- embeddings

def brute_vectors(rows, t=0.9):
    """rows: (id, list or None); the answer per row, in order."""
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a in good:
        for b in good:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a < b and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= t:
                links[a].add(b)
                links[b].add(a)
    low = lambda i: (rows[i][0] is not None, rows[i][0] or 0)  # noqa: E731  a null id sorts first
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        comp = rows[min(seen, key=low)][0]
        out.append((rows[i][0], len(links[i]), comp, comp == rows[i][0]))
    return out


def vectors(seed, n, dim=16):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    for i in range(1, n):  # near copies on both sides of the threshold, chains included
        if i % 3:
            x[i] = x[i - 1] + r.normal(size=dim) * r.choice([0.05, 0.4, 0.5])
    return x.astype(np.float32)


def got_vectors(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted((tuple(r) for r in E.near_duplicates(df, **kw).select("vec_id", "n_links", "component_id", "kept").collect()), key=key)


def want_vectors(rows, t=0.9):
    return sorted(brute_vectors(rows, t), key=lambda r: tuple((x is not None, x) for x in r))


def test_vectors_equal_brute_force_in_many_blocks(spark):
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(vectors(1, 240))]
    want = want_vectors(rows)
    assert max(r[1] for r in want) > 1 and any(not r[3] for r in want)
    assert got_vectors(spark, rows, block=16) == want
    assert got_vectors(spark, rows) == want


def test_vectors_odd_rows(spark):
    a, b = [1.0, 0.5, 0.0], [1.0, 0.52, 0.01]
    rows = [(5, a), (3, a), (3, a), (9, b), (7, None), (8, []), (10, [0.0, 0.0, 0.0]), (11, [float("nan"), 1.0, 0.0]), (12, [None, 1.0, 0.0]),
            (13, [float("inf"), 1.0, 0.0]), (14, [1.0, 0.5]), (15, [2.0, 1.0]), (16, [-1.0, -0.5, 0.0]), (17, [1e-30, 0.5e-30, 0.0]), (None, None)]
    assert got_vectors(spark, rows) == want_vectors(rows)
    rows = [(4, a), (None, b), (6, [0.0, 0.0, 1.0])]
    assert got_vectors(spark, rows) == [(None, 1, None, True), (4, 1, None, False), (6, 0, 6, True)]
    assert got_vectors(spark, []) == []
    assert got_vectors(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_vectors_ignore_other_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 7, "x"), (2, [1.0, 0.1], 8, "y")], "vec_id long, embedding array<double>, cls int, vector string")
    assert sorted(tuple(r) for r in E.near_duplicates(df).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_error_bound_holds_and_far_cells_have_no_tiles():
    x = E.unit(vectors(3, 400, 64).astype(float))
    q, s, e = E.quantise(x)
    approx = (q.astype(float) * s[:, None]) @ (q.astype(float) * s[:, None]).T
    assert (np.abs(approx - x @ x.T) <= e[:, None] + e[None, :] + np.outer(e, e)).all()
    for t in (0.9, 0.3, 0.0001):
        pairs = [(a, b) for u, v in E.tile_links(x, x, t, True) for a, b in zip(u.tolist(), v.tolist())]
        assert sorted(pairs) == sorted(map(tuple, np.argwhere(np.triu(x @ x.T >= t, 1)).tolist()))
    far = [{"dim": 2, "pivot": np.array(p), "n": 1, "radius": 0.1} for p in ([1.0, 0.0], [0.0, 1.0], [0.95, math.sqrt(1 - 0.95 ** 2)])]
    assert E._near_cells(far, 0.9) == [[0, 2], [1], [0, 2]]


# ---------------------------------------------------------------- lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute_rank(docs, items, k=50):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        got = []
        for d, c in held:
            m = 100 - 50 + ((50 * sum(c.values()) * n_docs) // n_terms)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if c[t])
            if s > 0:
                got.append((-s, (d is not None, d), d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(got)[:k])]
    return sorted(out, key=str)


def got_rank(spark, docs, items, **kw):
    df = L.rank(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), **kw)
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(seed, n):
    r = random.Random(seed)
    voc = [f"w{i}" for i in range(60)] + ["Ünï", "ñ", "the", "The", "x1"]
    return [(i, " ".join(r.choices(voc, [1 / (j + 1) for j in range(len(voc))], k=r.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("k", [1, 5, 50])
def test_search_equals_brute_force(spark, k, monkeypatch):
    monkeypatch.setattr(L, "SHARD_DOCS", 64)
    docs = corpus(4, 400)
    items = [(i, t) for i, (_, t) in enumerate(corpus(5, 12))]
    assert got_rank(spark, docs, items, k=k) == brute_rank(docs, items, k)


def test_search_odd_rows(spark):
    docs = [(1, "A b c"), (1, "A b c"), (None, "a b"), (2, None), (3, ""), (4, "!!! --- _"), (5, "a" * 5000 + " b"), (6, "É é ÉCOLE b\x00b"), (7, "b " * 3000)]
    items = [(0, "a B"), (0, "a B"), (0, "école"), (1, None), (2, ""), (3, "zzz"), (None, "b c"), (4, "É"), (5, "b")]
    assert got_rank(spark, docs, items) == brute_rank(docs, [i for i in items if i[1] is not None])
    assert got_rank(spark, [], items) == [] and got_rank(spark, docs, []) == [] and got_rank(spark, [(1, None)], [(1, "a")]) == []


def test_search_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(L, "SHARD_DOCS", 32)
    docs = [(i * 7 % 301, "alpha beta") for i in range(301)] + [(999, "gamma")]
    got = got_rank(spark, docs, [(1, "alpha"), (2, "beta gamma")])
    assert got == brute_rank(docs, [(1, "alpha"), (2, "beta gamma")])


def test_search_in_groups_of_items(spark, monkeypatch):
    monkeypatch.setattr(L, "ITEM_BYTES", 200)
    docs, items = corpus(6, 80), [(i, t) for i, (_, t) in enumerate(corpus(7, 6))]
    assert got_rank(spark, docs, items) == brute_rank(docs, items)


def test_search_skips_intervals(monkeypatch):
    """Most documents of a shard are never scored when a few are much better."""
    lex = L.lexicon(["rare other"])
    n = 4000
    docs = np.concatenate([np.arange(n), np.arange(0, n, 500)])
    term = np.concatenate([np.full(n, 0), np.full(len(docs) - n, 1)])
    shard = L.Shard(np.arange(n), np.full(n, 10), np.array([0, 1]), np.bincount(term), docs, np.ones(len(docs), np.int64), np.array([1, 9000]), n, 10 * n)
    scored = []
    monkeypatch.setattr(L, "_best", lambda s, i, k, f=L._best: scored.append(len(s)) or f(s, i, k))
    best = shard.search(np.array([0, 1]), (np.zeros(0, np.int64), np.zeros(0, np.int64)), 4)
    assert best[1].tolist() == [0, 500, 1000, 1500] and sum(scored) < n // 4 and len(lex.items[0]) == 2


# ---------------------------------------------------------------- periodic runs

def brute_runs(w, least=24, periods=3):
    out = []
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            if length >= max(least, periods * q) and not any(all(w[s + j] == w[s + j + d] for j in range(length - d)) for d in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def brute_report(doc_id, text):
    w = planted(doc_id, text)
    runs = brute_runs(w)
    keep = [True] * len(w)
    for s, n, q in runs:
        keep[s + q:s + n] = [False] * (n - q)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(" ".join(x for x, k in zip(w, keep) if k).encode()))


def run_texts():
    r = random.Random(11)
    out = []
    for i in range(120):
        parts = []
        for _ in range(r.randint(1, 4)):
            q = r.choice([1, 2, 3, 7, 8, 9, 20])
            base = [r.choice("abcdefgh") for _ in range(q)]
            parts += [r.choice("abcdefgh") + str(r.randint(0, 9)) for _ in range(r.randint(0, 12))] + (base * 90)[:r.randint(0, 80)]
        out.append((i, r.choice([" ", "\n", "\t \x0b"]).join(parts)))
    out += [(200, "a " * 400), (201, "a b " * 11 + "a"), (202, "a b " * 12), (203, " ".join("ab"[bin(i).count("1") % 2] for i in range(600)))]
    fib = ["a", "a b"]
    while len(fib) < 14:
        fib.append(fib[-1] + " " + fib[-2])
    return out + [(204, fib[-1]), (205, "x " * 23), (206, "x " * 24), (207, "ab c" * 60)]


def test_runs_equal_brute_force(spark):
    rows = run_texts() + [(None, "a b " * 30), (300, None), (301, ""), (302, " \n\t "), (0, "same " * 40), (0, "same " * 40)]
    df = spark.createDataFrame([(d, t, "z", 1) for d, t in rows], DOCS + ", runs string, start int")
    got = sorted((tuple(r) for r in P.report(P.find_runs(P.with_planted_periods(df))).collect()), key=str)
    want = sorted((brute_report(d, t) for d, t in rows), key=str)
    assert got == want
    assert sum(r[1] for r in want) > 100
    empty = spark.createDataFrame([], DOCS)
    assert P.report(P.find_runs(P.with_planted_periods(empty))).collect() == []


def test_runs_other_limits_without_the_cut():
    """The automaton alone (whole text) and behind the cut give the same runs, for several limits."""
    for d, t in run_texts()[::3]:
        w = words(t)
        ids = {x: i for i, x in enumerate(dict.fromkeys(w))}
        for least, periods in ((24, 3), (6, 2), (12, 4)):
            assert P.runs_in([ids[x] for x in w], [(0, len(w))], least, periods) == brute_runs(w, least, periods), d


def test_runs_small_limits_behind_the_cut(spark):
    rows = run_texts()[::5]
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in P.find_runs(spark.createDataFrame(rows, DOCS), 6, 2).collect()}
    assert got == {d: brute_runs(words(t), 6, 2) for d, t in rows}


def test_runs_very_long_text(spark):
    t = " ".join(f"u{i}" for i in range(30_000)) + " k" * 3000 + " " + " ".join(f"v{i % 700}" for i in range(2800))
    r = P.find_runs(spark.createDataFrame([(1, t)], DOCS)).first()
    assert [tuple(x) for x in r["runs"]] == [(30_000, 3000, 1), (33_000, 2800, 700)]
    assert hashlib.sha256(r["collapsed"].encode()).hexdigest() == sha(" ".join(words(t)[:30_001] + words(t)[33_000:33_700]).encode())
