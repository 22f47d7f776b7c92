"""Brute-force versions on plain Python data, straight from the contracts."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def jaccard(rows, size=5):
    def shingles(t):
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return ({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or {tuple(w)}) if w else set()

    sets = [(d, shingles(t)) for d, t in rows]
    comp = {d: {d} for d, _ in rows}
    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and comp[d] is not comp[e]:
                comp[d] |= comp[e]
                for x in comp[d]:
                    comp[x] = comp[d]
    return sorted((d, len(s), min(comp[d])) for d, s in sets)


def quality_base(t):
    w = words(t)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def repeated_bytes(rows, length=400):
    raw = [(d, (t or "").encode()) for d, t in rows]
    starts = Counter(b[i:i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = set()
        for i in range(len(b) - length + 1):
            if starts[b[i:i + length]] > 1:
                gone.update(range(i, i + length))
        spans = sum(1 for i in gone if i - 1 not in gone)
        out.append((d, len(b), len(gone), spans, sha(bytes(c for i, c in enumerate(b) if i not in gone))))
    return out


def repeated_windows(rows, window=50):
    """``rows``: (key, text) with integer keys."""
    docs = [(d, words(t)) for d, t in rows]
    first = {}
    for d, w in docs:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(d, first.get(k, d))
    out = []
    for d, w in docs:
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < d for j in range(i, i + window)}
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone).encode())))
    return sorted(out)


def pii_base(t):
    t = t or ""

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    n = lambda m: re.sub("[^0-9]", "", m.group())
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if max(map(int, m.group().split("."))) <= 255]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(n(m)) <= 19 and luhn(n(m))]
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(n(m)) <= 15]
    text = ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in sorted(found))
    return (*(sum(k == i for _, k, _ in found) for i in range(4)), sha(text.encode()))
