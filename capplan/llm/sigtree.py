"""Signature tree over sets of 64-bit tokens and its dual traversal for a Jaccard self-join.

Leaves are sets in order of size; every node holds the OR of its sets' token bitmaps, the range of their
sizes and the largest excess of tokens over bits. Two nodes can hold a similar pair only if their size
ranges are close enough and the common bits, plus the smaller excess, allow the overlap that is needed.
"""

from __future__ import annotations

import numpy as np

#: Bits of a bitmap, and buckets of the counts beside it.
BITMAP, BUCKETS = 1024, 128
LEAF, FAN = 32, 8


class Links:
    """Connected components of a few items, by path halving."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return int(x)

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)

    def roots(self, start: int, end: int) -> np.ndarray:
        """Roots of a range; the range is flattened on the way."""
        part = self.parent[start:end]
        while True:
            up = self.parent[part]
            if (up == part).all():
                break
            part = up
        self.parent[start:end] = part
        return part

    def one(self, a: slice, b: slice) -> bool:
        left, right = self.roots(a.start, a.stop), self.roots(b.start, b.stop)
        return bool((left == left[0]).all() and (right == left[0]).all())


def signatures(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per set a bitmap of its tokens and, per bucket of tokens, how many it has (255 stands for more)."""
    sizes = np.diff(starts)
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    bits = np.zeros((n, BITMAP // 64), dtype=np.uint64)
    place = (tokens & np.uint64(BITMAP - 1)).astype(np.int64)
    flat = owner * (BITMAP // 64) + (place >> 6)
    np.bitwise_or.at(bits.reshape(-1), flat, np.uint64(1) << (place & 63).astype(np.uint64))
    bucket = (tokens >> np.uint64(40)).astype(np.int64) % BUCKETS
    counts = np.bincount(owner * BUCKETS + bucket, minlength=n * BUCKETS)
    return np.hstack([bits.view(np.uint8), np.minimum(counts, 255).astype(np.uint8).reshape(n, BUCKETS)])


class Tree:
    """A signature tree of sets that come in order of size.

    ``signed`` has their signatures. With ``tokens`` (one set after the other) and ``starts`` (where each
    begins and the last ends) pairs are verified; without them, pairs are linked that may be similar.
    """

    def __init__(self, signed: np.ndarray, sizes: np.ndarray, tokens=None, starts=None):
        self.tokens, self.starts = tokens, starts
        n = len(sizes)
        bits = np.ascontiguousarray(signed[:, : BITMAP // 8]).view(np.uint64)
        self.counts = signed[:, BITMAP // 8 :].astype(np.int16)
        excess = sizes - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.bits, self.sizes, self.excess = bits, sizes, excess
        self.levels = []  # from leaves up: bitmaps, least and largest size, largest excess, first set and last
        step, low, high, ex, first = LEAF, sizes, sizes, excess, np.arange(n)
        width = bits
        while True:
            cuts = np.arange(0, len(low), step)
            width = np.bitwise_or.reduceat(width, cuts, axis=0)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            ex, first = np.maximum.reduceat(ex, cuts), first[cuts]
            self.levels.append((width, low, high, ex, np.append(first, n)))
            if len(cuts) == 1:
                break
            step = FAN

    def possible(self, level: int, i: int, j: int, share: int) -> bool:
        """Whether some pair of the two nodes may reach the share (in hundredths); i comes before j."""
        width, low, high, ex, _ = self.levels[level]
        if 100 * high[i] < share * low[j]:
            return False
        common = int(np.bitwise_count(width[i] & width[j]).sum()) + min(ex[i], ex[j])
        return (100 + share) * min(common, high[i]) >= share * (low[i] + low[j])

    def join(self, share: int, links: Links | None = None, border: np.ndarray | None = None) -> Links:
        """Links all pairs with ``100 * intersection >= share * union``.

        Pairs that are linked already, directly or through others, are not compared again. With ``border``,
        a flag per set, only pairs with different flags are compared.
        """
        links = links or Links(len(self.sizes))
        stack = [(len(self.levels) - 1, 0, 0)]
        numbers = mark = None
        while stack:
            level, i, j = stack.pop()
            first = self.levels[level][4]
            a, b = slice(int(first[i]), int(first[i + 1])), slice(int(first[j]), int(first[j + 1]))
            if links.one(a, b) or (i != j and not self.possible(level, i, j, share)):
                continue
            if level:
                ends = len(self.levels[level - 1][1])
                left = range(i * FAN, min((i + 1) * FAN, ends))
                right = range(j * FAN, min((j + 1) * FAN, ends))
                pairs = [(level - 1, x, y) for x in left for y in right if x <= y]
                # near pairs first: what they link need not be compared farther off
                stack.extend(sorted(pairs, key=lambda p: p[1] - p[2]))
                continue
            if numbers is None and self.tokens is not None:
                values, numbers = np.unique(self.tokens, return_inverse=True)
                mark = np.zeros(len(values), dtype=bool)
            self._compare(a, b, share, links, border, numbers, mark)
        return links

    def _compare(self, a: slice, b: slice, share: int, links: Links, border, numbers, mark) -> None:
        for x in range(a.start, a.stop):
            from_ = max(b.start, x + 1)
            if from_ >= b.stop:
                continue
            others = np.arange(from_, b.stop)
            size = self.sizes[others]
            open_ = (links.roots(from_, b.stop) != links.find(x)) & (100 * self.sizes[x] >= share * size)
            common = np.bitwise_count(self.bits[others] & self.bits[x]).sum(axis=1) + np.minimum(
                self.excess[others], self.excess[x]
            )
            open_ &= (100 + share) * common >= share * (size + self.sizes[x])
            if border is not None:
                open_ &= border[others] != border[x]
            # sets differ by at least as many tokens as their bucket counts do
            differ = np.abs(self.counts[others] - self.counts[x]).sum(axis=1, dtype=np.int64)
            open_ &= (100 + share) * (size + self.sizes[x] - differ) >= 2 * share * (size + self.sizes[x])
            if not open_.any():
                continue
            if numbers is None:
                for y in others[open_].tolist():
                    links.join(x, y)
                continue
            own = numbers[self.starts[x] : self.starts[x + 1]]
            mark[own] = True
            for y in others[open_].tolist():
                both = int(np.count_nonzero(mark[numbers[self.starts[y] : self.starts[y + 1]]]))
                if 100 * both >= share * (len(own) + int(self.sizes[y]) - both):
                    links.join(x, y)
            mark[own] = False
