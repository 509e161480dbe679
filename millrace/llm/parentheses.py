"""Trees as balanced parentheses: one bit for each opening and closing of a node in depth-first order."""

from __future__ import annotations

import numpy as np

# Bits per block of the range min-max tree.
BLOCK = 64
# Searches of a block done together.
TOGETHER = 1 << 13


class Parentheses:
    """Navigation in a balanced sequence of bits, 1 for an opening.

    The excess at a place is the number of nodes open behind it. Its smallest value is kept for every
    block of bits, and in a tree over the blocks for every run of 2, 4, 8... blocks. The parenthesis that
    closes a node is the first behind it where the excess falls below that of the opening: if it is not in
    the same block, one climbs until a run to the right reaches that low, and goes down in it.
    """

    def __init__(self, bits: np.ndarray):
        self.opened = np.flatnonzero(bits)
        excess = np.cumsum(np.where(bits, 1, -1))
        blocks = max(1, -(-len(bits) // BLOCK))
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[: len(bits)] = excess
        self._excess = padded.reshape(blocks, BLOCK)
        self._lows = [self._excess.min(axis=1)]
        while len(self._lows[-1]) > 1:
            below = self._lows[-1]
            if len(below) % 2:
                below = np.append(below, np.iinfo(np.int64).max)
            self._lows.append(below.reshape(-1, 2).min(axis=1))
        # leaf pairs "()" up to and including each place
        pair = np.zeros(len(bits), bool)
        pair[:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
        self._leaves = np.concatenate([[0], np.cumsum(pair)])

    def _first(self, block: np.ndarray, after: np.ndarray, low: np.ndarray) -> np.ndarray:
        """In each named block the first place behind ``after`` where the excess is ``low``, else -1."""
        found = np.empty(len(block), np.int64)
        place = np.arange(BLOCK)
        for at in range(0, len(block), TOGETHER):
            part = slice(at, at + TOGETHER)
            hit = (self._excess[block[part]] == low[part, None]) & (place > after[part, None])
            first = hit.argmax(axis=1)
            ok = hit[np.arange(len(first)), first]
            found[part] = np.where(ok, block[part] * BLOCK + first, -1)
        return found

    def find_close(self) -> np.ndarray:
        """The place that closes each node, in the order of the openings."""
        block, inside = np.divmod(self.opened, BLOCK)
        low = self._excess[block, inside] - 1
        close = self._first(block, inside, low)
        left = np.flatnonzero(close < 0)
        node, level = block[left], np.full(len(left), -1)
        climbing = np.arange(len(left))
        for height, lows in enumerate(self._lows):
            if not len(climbing):
                break
            beside = node[climbing] + 1
            there = (node[climbing] % 2 == 0) & (beside < len(lows))
            there[there] = lows[beside[there]] <= low[left[climbing[there]]]
            node[climbing[there]] += 1
            level[climbing[there]] = height
            climbing = climbing[~there]
            node[climbing] //= 2
        for height in range(len(self._lows) - 1, 0, -1):
            down = np.flatnonzero(level == height)
            child = 2 * node[down]
            node[down] = child + (self._lows[height - 1][child] > low[left[down]])
            level[down] = height - 1
        close[left] = self._first(node, np.full(len(left), -1), low[left])
        return close

    def leaf_rank(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Leaf pairs that begin at places ``first`` to ``last``."""
        return self._leaves[last + 1] - self._leaves[first]
