"""R-tree over count vectors, joined with itself under an overlap bound.

A set is a point: coordinate g counts its elements whose hash falls into group g.  Two sets share at most
``sum_g min(a_g, b_g)`` elements, and a node's box gives the same bound for everything below it (with the
largest coordinates and the smallest size in the node).  A pair of nodes that cannot hold a similar pair is
dropped with all its points.
"""

from __future__ import annotations

import numpy as np

LEAF, FAN = 16, 8
STEP = 200_000  # node pairs expanded at a time


def may_link(shared: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int = 80) -> np.ndarray:
    """Whether this many shared elements reach ``percent`` of the union."""
    return (100 + percent) * shared >= percent * (size_a + size_b)


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a, b).sum(axis=1, dtype=np.int32).astype(np.int64)


class CountTree:
    """Bulk-loaded: points sorted by class and size, then by the place of their largest coordinate, packed into full nodes.

    ``classes``: pairs inside one class are of no interest, so two nodes that hold the same single class are not compared.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int = 80, classes: np.ndarray | None = None):
        self.percent = percent
        classes = np.arange(len(sizes)) if classes is None else classes
        self.order = np.lexsort((points.argmax(axis=1), sizes, classes if len(np.unique(classes)) < len(sizes) else sizes))
        box, low, first, last = points[self.order], sizes[self.order], classes[self.order], classes[self.order]
        self.levels = [(box, low, first, last)]
        while len(low) > 1:
            step = LEAF if len(self.levels) == 1 else FAN
            cut = np.arange(0, len(low), step)
            box, low = np.maximum.reduceat(box, cut), np.minimum.reduceat(low, cut)
            first, last = np.minimum.reduceat(first, cut), np.maximum.reduceat(last, cut)
            self.levels.append((box, low, first, last))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs (each once) of points of different classes that may be similar."""
        out_a, out_b = [], []
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))] if top else []  # a single point has no partner
        while stack:
            level, a, b = stack.pop()
            if level == 0:
                out_a.append(self.order[a])
                out_b.append(self.order[b])
                continue
            box, low, first, last = self.levels[level - 1]
            step = LEAF if level == 1 else FAN
            child = np.arange(step)
            for k in range(0, len(a), max(1, STEP // step ** 2)):
                i, j = a[k:k + max(1, STEP // step ** 2)], b[k:k + max(1, STEP // step ** 2)]
                x = np.repeat(i[:, None] * step + child, step, axis=1).ravel()
                y = np.tile(j[:, None] * step + child, (1, step)).ravel()
                fits = (x < len(low)) & (y < len(low)) & ((x < y) if level == 1 else (x <= y))
                x, y = x[fits], y[fits]
                apart = (first[x] != last[x]) | (first[x] != first[y]) | (first[x] != last[y])
                x, y = x[apart], y[apart]
                near = may_link(overlap_bound(box[x], box[y]), low[x], low[y], self.percent)
                if near.any():
                    stack.append((level - 1, x[near], y[near]))
        if not out_a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(out_a), np.concatenate(out_b)
