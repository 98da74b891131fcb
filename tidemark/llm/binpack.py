"""Exact best-fit decreasing over a histogram of sizes, and dual-feasible lower bounds.

Best-fit decreasing depends on the sizes alone, and equal sizes arrive together. Bins with the same
remaining capacity therefore stay a class (runs of bin numbers), and all items of a size enter a class
in one step: the tightest class that fits takes floor(remaining / size) items a bin before the next
larger class is touched, exactly as item by item. The work follows the number of distinct sizes, not
of items.
"""

from __future__ import annotations

import numpy as np


class Tree:
    """AVL tree of integer keys; ceiling(k) is the least key that is k or more."""

    def __init__(self) -> None:
        self.root = None  # [key, height, left, right]

    @staticmethod
    def _h(n) -> int:
        return n[1] if n else 0

    def _fix(self, n):
        h = self._h
        n[1] = 1 + max(h(n[2]), h(n[3]))
        d = h(n[2]) - h(n[3])
        if d > 1:
            if h(n[2][2]) < h(n[2][3]):
                n[2] = self._turn(n[2], 3, 2)
            return self._turn(n, 2, 3)
        if d < -1:
            if h(n[3][3]) < h(n[3][2]):
                n[3] = self._turn(n[3], 2, 3)
            return self._turn(n, 3, 2)
        return n

    def _turn(self, n, a: int, b: int):
        up = n[a]
        n[a], up[b] = up[b], n
        for x in (n, up):
            x[1] = 1 + max(self._h(x[2]), self._h(x[3]))
        return up

    def add(self, k: int) -> None:
        def go(n):
            if n is None:
                return [k, 1, None, None]
            if k == n[0]:
                return n
            side = 2 if k < n[0] else 3
            n[side] = go(n[side])
            return self._fix(n)

        self.root = go(self.root)

    def remove(self, k: int) -> None:
        def go(n, k):
            if n is None:
                return None
            if k != n[0]:
                side = 2 if k < n[0] else 3
                n[side] = go(n[side], k)
            elif n[2] is None or n[3] is None:
                return n[2] or n[3]
            else:
                m = n[3]
                while m[2]:
                    m = m[2]
                n[0] = m[0]
                n[3] = go(n[3], m[0])
            return self._fix(n)

        self.root = go(self.root, k)

    def ceiling(self, k: int) -> int | None:
        n, best = self.root, None
        while n:
            if n[0] >= k:
                best, n = n[0], n[2]
            else:
                n = n[3]
        return best


def best_fit_decreasing(sizes, counts, capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows (size, first rank, rank after the last, first bin, items a bin) and the number of bins.

    The item of a size with rank k (from 0) goes to bin first bin + (k - first rank) // items a bin.
    A size above the capacity has bins of its own, one an item. Size 0 goes to the fullest bin.
    """
    order = np.argsort(-np.asarray(sizes, np.int64), kind="stable")
    tree, runs, out, bins = Tree(), {}, [], 0

    def put(left: int, first: int, n: int) -> None:
        if n:
            if left not in runs:
                runs[left] = []
                tree.add(left)
            runs[left].append((first, n))

    for i in order:
        s, c, rank = int(sizes[i]), int(counts[i]), 0
        if s > capacity:
            out.append((s, 0, c, bins, 1))
            bins += c
            continue
        while rank < c:
            left = tree.ceiling(s)
            if left is None:
                q = capacity // s if s else c
                full, rest = divmod(c - rank, q)
                if full:
                    out.append((s, rank, rank + full * q, bins, q))
                    put(capacity - q * s, bins, full)
                if rest:
                    out.append((s, c - rest, c, bins + full, rest))
                    put(capacity - rest * s, bins + full, 1)
                bins += full + (rest > 0)
                break
            q = left // s if s else c - rank
            own = runs.pop(left)
            tree.remove(left)
            for j, (first, n) in enumerate(own):
                full = min(n, (c - rank) // q)
                if full:
                    out.append((s, rank, rank + full * q, first, q))
                    put(left - q * s, first, full)
                    rank += full * q
                if full < n:
                    rest = c - rank
                    if rest:
                        out.append((s, rank, c, first + full, rest))
                        put(left - rest * s, first + full, 1)
                        rank = c
                    put(left, first + full + (rest > 0), n - full - (rest > 0))
                    for f, m in own[j + 1 :]:
                        put(left, f, m)
                    break
    return out, bins


def lower_bound(sizes, counts, capacity: int, most_k: int = 100) -> int:
    """The largest of the bounds that dual-feasible functions give: u(k) for k up to most_k, U(eps) for
    every size up to half the capacity (and 0: the volume), phi(eps) for eps = capacity / j. Sizes above
    the capacity need a bin each. Integer arithmetic, so that rounding can't certify too much."""
    s, c = np.asarray(sizes, np.int64), np.asarray(counts, np.int64)
    over = int(c[s > capacity].sum())
    s, c = s[(s > 0) & (s <= capacity)], c[(s > 0) & (s <= capacity)]
    if not len(s):
        return over or int(len(np.asarray(counts)) > 0)
    o = np.argsort(s)
    s, c = s[o], c[o]
    big = lambda x: sum(int(a) * int(b) for a, b in zip(x, c, strict=True))
    up = lambda a, b: -(-a // b)
    best = up(big(s), capacity)
    for k in range(1, most_k + 1):  # u(k), times k * capacity
        whole = (k + 1) * s % capacity == 0
        value = np.where(whole, k * s, (k + 1) * s // capacity * capacity)
        best = max(best, up(_dot(value, c), k * capacity))
    n_from = np.concatenate((np.cumsum(c[::-1])[::-1], [0]))
    v_from = np.concatenate((np.cumsum((s * c)[::-1])[::-1], [0]))
    eps = s[2 * s <= capacity]
    if len(eps):
        at, top = np.searchsorted(s, eps, "left"), np.searchsorted(s, capacity - eps, "right")
        whole = n_from[top] * capacity + v_from[at] - v_from[top]
        best = max(best, int((-(-whole // capacity)).max()))
    for j in range(2, most_k + 1):  # phi, times j; eps = capacity / j
        high, mid = 2 * s > capacity, (s * j >= capacity) & (2 * s <= capacity)
        value = np.where(high, j - (capacity - s) * j // capacity, np.where(mid, 1, 0))
        best = max(best, up(_dot(value, c), j))
    return best + over


def _dot(a: np.ndarray, b: np.ndarray) -> int:
    """Exact sum of products."""
    hi, lo = a >> 20, a & ((1 << 20) - 1)
    return int((hi * b).sum()) * (1 << 20) + int((lo * b).sum())


def naive(items: list[int], capacity: int) -> int:
    """Bins of best-fit decreasing, item by item."""
    left: list[int] = []
    n_over = 0
    for s in sorted(items, reverse=True):
        if s > capacity:
            n_over += 1
            continue
        fits = [x for x in left if x >= s]
        if fits:
            left.remove(min(fits))
            left.append(min(fits) - s)
        else:
            left.append(capacity - s)
    return len(left) + n_over

