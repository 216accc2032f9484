"""Suffix sort by hashes: merge sort whose comparisons find the common extension by binary search on prefix hashes.

The first eight bytes are sorted as numbers beforehand, so that only suffixes that begin alike are merged.
"""

from __future__ import annotations

import numpy as np

from orderloom.llm import kernels as K

#: Bytes of a suffix that are sorted as one number.
HEAD = 8


class Suffixes:
    """Suffixes of one byte string: starts and lengths (a suffix may be cut short)."""

    def __init__(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.raw, self.start, self.length = raw, start.astype(np.int64), length.astype(np.int64)
        self.hash = K.SpanHash(raw)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes x and y: binary search over equal prefix hashes."""
        low, high = np.zeros(len(x), np.int64), np.minimum(self.length[x], self.length[y])
        a, b = self.hash.spans_from(self.start[x]), self.hash.spans_from(self.start[y])
        while (low < high).any():
            middle = (low + high + 1) // 2  # a closed search stays where it is
            same = a(middle) == b(middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, np.maximum(middle - 1, low))
        return low

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether suffix x sorts before suffix y: the byte behind the common extension decides, the end comes first."""
        n = self.common(x, y)
        end_x, end_y = n >= self.length[x], n >= self.length[y]
        last = max(len(self.raw) - 1, 0)
        byte_x = np.where(end_x, -1, self.raw[np.minimum(self.start[x] + n, last)].astype(np.int64))
        byte_y = np.where(end_y, -1, self.raw[np.minimum(self.start[y] + n, last)].astype(np.int64))
        return byte_x < byte_y

    def heads(self) -> np.ndarray:
        """The first HEAD bytes of each suffix as a number that sorts as they do; what is missing counts as zero bytes."""
        out, last = np.zeros(len(self.start), K.U64), max(len(self.raw) - 1, 0)
        for i in range(HEAD if len(self.raw) else 0):
            byte = self.raw[np.minimum(self.start + i, last)].astype(K.U64)
            out = out << K.U64(8) | np.where(i < self.length, byte, K.U64(0))
        return out

    def sort(self, groups: np.ndarray) -> np.ndarray:
        """Order of the suffixes within each group; ``groups``: n + 1 bounds. Stable. Of equal suffixes one is merged, where heads are equal."""
        heads, whole, group = self.heads(), self.hash(self.start, self.start + self.length), K.owners(groups)
        order = np.lexsort((whole, heads, group))
        tie, new = np.ones(len(order), bool), np.ones(len(order), bool)
        tie[1:] = (group[1:] != group[:-1]) | (heads[order[1:]] != heads[order[:-1]])
        new[1:] = tie[1:] | (whole[order[1:]] != whole[order[:-1]])
        first = np.flatnonzero(new)  # of each run of equal suffixes
        runs = self._merged(order[first], np.r_[np.flatnonzero(tie[first]), len(first)])
        size = np.empty(len(order), np.int64)
        place = np.empty(len(order), np.int64)
        place[order[first]], size[order[first]] = first, np.diff(np.r_[first, len(order)])
        size = size[runs]
        return order[np.repeat(place[runs] - (np.cumsum(size) - size), size) + np.arange(len(order))]

    def _merged(self, order: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """``order`` with each group sorted: a stable merge sort, bottom up, all groups at once."""
        group = K.owners(groups)
        first, size = groups[:-1][group], np.diff(groups)[group]
        place = np.arange(len(order)) - first
        width = 1
        while (size > width).any():
            at = np.flatnonzero(size > width)  # places of groups that are not sorted yet
            block = place[at] // (2 * width) * (2 * width) + first[at]
            left = place[at] % (2 * width) < width
            end = first[at] + size[at]
            low = np.where(left, np.minimum(block + width, end), block)
            high = np.where(left, np.minimum(block + 2 * width, end), np.minimum(block + width, end))
            base = low.copy()
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                own, other = order[at[open_]], order[middle]
                # From the left, those strictly before pass; from the right, equal ones pass too.
                mine = left[open_]
                passes = np.where(mine, self.before(other, own), ~self.before(own, other))
                low[open_] = np.where(passes, middle + 1, low[open_])
                high[open_] = np.where(passes, high[open_], middle)
            offset = np.where(left, at - block, at - block - width)
            moved = order.copy()
            moved[block + offset + (low - base)] = order[at]
            order = moved
            width *= 2
        return order

    def neighbours(self, order: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """Common extension of each suffix with the one before it in ``order`` (0 at a group's start), checked on the bytes."""
        if not len(order):
            return np.zeros(0, np.int64)
        found = np.r_[0, self.common(order[1:], order[:-1])]
        found[groups[:-1][np.diff(groups) > 0]] = 0
        most = int(found.max())
        for i in range(most):  # a hash collision shows as a longer extension than the bytes have
            look = np.flatnonzero(found > i)
            differ = self.raw[self.start[order[look]] + i] != self.raw[self.start[order[look - 1]] + i]
            found[look[differ]] = i
        return found
