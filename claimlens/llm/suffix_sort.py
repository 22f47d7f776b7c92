"""Two-stage suffix sorting of many short pieces, as whole-array steps.

``pieces`` are byte strings; the suffixes to sort are the starts of ``depth``-byte windows.  A suffix that is
smaller than its successor is sorted directly; so is the last one of each piece, whose successor is
not sorted.  Every other suffix is induced: buckets of the first byte are scanned in order, and the predecessor
of each entry is appended to the bucket of its own first byte.  Order is by the first ``depth`` bytes at least.
"""

from __future__ import annotations

import numpy as np

from claimlens.llm.textbytes import range_hash_of, range_sums

_U = np.uint64


class SuffixSort:
    def __init__(self, data: np.ndarray, start: np.ndarray, count: np.ndarray, depth: int):
        """``data``: the pieces in a row; piece k has its windows at ``start[k] .. start[k] + count[k] - 1``."""
        self.depth = depth
        self.data = np.concatenate([data, np.full(depth + 8, 255, np.uint8)])  # 255 is in no UTF-8 text
        first = np.cumsum(count) - count
        window = np.zeros(len(self.data), bool)
        window[np.repeat(start - first, count) + np.arange(int(count.sum()))] = True
        self.sums = range_sums(self.data)
        below = self._below_successor()
        # from each last window on, up to one that is sorted directly: the others are induced from it
        ups = np.flatnonzero(below)
        last = (start + count - 1)[count > 0]
        until = ups[np.searchsorted(ups, last)]
        n = until - last
        self.wanted = window.copy()
        self.wanted[np.repeat(last + 1 - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] = True
        self.direct = self.wanted & below
        order = self._induced(self._directly_sorted(np.flatnonzero(self.direct)))
        self.sa = order[window[order]]

    def _hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return range_hash_of(self.sums, a, b)

    def _below_successor(self) -> np.ndarray:
        """For every place: the next different byte is larger.  Runs longer than the depth count so, too."""
        d = self.data
        change = np.append(np.flatnonzero(d[1:] != d[:-1]), len(d) - 1)  # d[c] differs from d[c + 1]
        at = change[np.searchsorted(change, np.arange(len(d)))]
        return (at - np.arange(len(d)) >= self.depth) | (np.append(d, np.uint8(255))[at + 1] >= d)

    def _directly_sorted(self, pos: np.ndarray) -> np.ndarray:
        """``pos`` in the order of the first ``depth`` bytes: eight bytes a round, ties go on."""
        n = len(self.data) - 8
        key = np.zeros(n, np.uint64)
        for k in range(8):
            key |= self.data[k:k + n].astype(np.uint64) << _U(56 - 8 * k)
        order = pos[np.argsort(key[pos], kind="stable")]
        tied = _tied_groups(key[order])
        at, group, depth = tied[0], tied[1], np.full(len(tied[0]), 8, np.int64)
        while len(at):
            p = order[at]
            starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            size = np.diff(np.append(starts, len(group)))
            alike = lambda h: np.repeat(np.minimum.reduceat(h, starts) == np.maximum.reduceat(h, starts), size)
            live = ~alike(self._hash(p + depth, p + self.depth))
            for step in (128, 32):  # what a whole group shares needs no comparison
                to = np.minimum(depth + step, self.depth)
                depth = np.where(alike(self._hash(p + depth, p + to)), to, depth)
            live &= depth < self.depth
            at, group, depth, p = at[live], group[live], depth[live], p[live]
            if not len(at):
                break
            word = key[p + depth]
            turn = np.lexsort((word, group))
            order[at] = p[turn]
            word, depth = word[turn], np.minimum(depth[turn] + 8, self.depth)
            same = np.append(False, (word[1:] == word[:-1]) & (group[1:] == group[:-1]))
            tie = same | np.append(same[1:], False)
            tie &= depth < self.depth
            group = np.cumsum(~same)[tie]
            at, depth = at[tie], depth[tie]
        return order

    def _induced(self, direct: np.ndarray) -> np.ndarray:
        """All wanted suffixes in order, from those sorted directly."""
        d = self.data
        cut = np.searchsorted(d[direct], np.arange(257))
        waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
        out = []
        for c in range(256):
            seq = waiting[c]
            last = np.concatenate(seq) if seq else np.zeros(0, np.int64)
            seq = [last] if len(last) else []
            while len(last):  # runs of one byte feed their own bucket
                p = last[last > 0] - 1
                last = p[self.wanted[p] & ~self.direct[p] & (d[p] == c)]
                if len(last):
                    seq.append(last)
            if cut[c] < cut[c + 1]:
                seq.append(direct[cut[c]:cut[c + 1]])
            if not seq:
                continue
            full = np.concatenate(seq)
            out.append(full)
            p = full[full > 0] - 1
            p = p[self.wanted[p] & ~self.direct[p] & (d[p] > c)]
            if len(p):
                byte = d[p]
                p = p[np.argsort(byte, kind="stable")]
                ends = np.cumsum(np.bincount(byte, minlength=256))
                for b in np.unique(byte).tolist():
                    waiting[b].append(p[(ends[b - 1] if b else 0):ends[b]])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def reaches_depth(self) -> np.ndarray:
        """Whether the common prefix of each suffix and the one before it has the full depth (first: no)."""
        a, b = self.sa[:-1], self.sa[1:]
        return np.append(np.zeros(min(1, len(self.sa)), bool), self._hash(a, a + self.depth) == self._hash(b, b + self.depth))

    def common_prefixes(self) -> np.ndarray:
        """Common prefix of each suffix and the one before it in order, at most ``depth`` (first: 0)."""
        a, b = self.sa[:-1], self.sa[1:]
        have = np.zeros(len(b), np.int64)
        step = 1 << (self.depth.bit_length() - 1)
        while step:
            to = have + step
            fits = to <= self.depth
            to = np.where(fits, to, have)
            have = np.where(fits & (self._hash(a + have, a + to) == self._hash(b + have, b + to)), to, have)
            step >>= 1
        return np.append(0, have)


def _tied_groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a sorted array that equal a neighbour, and their group numbers."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.append(False, key[1:] == key[:-1])
    tie = same | np.append(same[1:], False)
    return np.flatnonzero(tie), np.cumsum(~same)[tie]
