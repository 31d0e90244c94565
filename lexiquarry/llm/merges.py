"""BPE merges of many short fragments at once, as array operations.

Every fragment makes its own merges in the order of the method: of its neighbouring symbols the pair that was learned
first, the leftmost of equal ones, until no pair is left. A step makes one merge in each fragment that still has one.
Fragments stand in the columns of a matrix, their symbols in its rows, so that the next merges of all are one minimum
over rows.

A pair is found in one table by row displacement: the pairs of a left symbol lie at its own distance from their right
symbols, and distances are chosen so that no two pairs share a slot.
"""

from __future__ import annotations

import numpy as np

#: Longest fragment that is merged here, and rows that a key has room for.
LONGEST, ROWS = 32, 64
#: Fragments that are merged at a time.
COLUMNS = 1 << 13
#: Of a pair that is never merged.
_NEVER = np.int32(2**31 - 1)


class Merges:
    """pairs[k] = (left, right, merged) of the k-th merge learned; symbols are numbers below `size`."""

    def __init__(self, pairs: np.ndarray, size: int):
        if len(pairs) * ROWS >= _NEVER:
            raise ValueError("too many merges")
        self.size, self.merged = size, pairs[:, 2].astype(np.int32)
        left, right = pairs[:, 0], pairs[:, 1]
        slots = 1 << max(10, int(4 * len(pairs)).bit_length())
        self._mask = slots - 1
        #: Left symbol and rank of the pair in a slot; the symbol `size` stands for no symbol and has no pairs.
        self._slot = np.full(slots, -1, np.int64)
        self._shift = np.zeros(size + 1, np.int64)
        order = np.argsort(left, kind="stable")
        begins = np.flatnonzero(np.diff(left[order], prepend=-1))
        rows = np.split(order, begins[1:]) if len(order) else []
        for row in sorted(rows, key=len, reverse=True):
            a, b, tried = int(left[row[0]]), right[row], 0
            while True:
                shifts = (np.arange(tried, tried + 32) * 40_503 + a * 977) & self._mask
                free = np.flatnonzero((self._slot[(shifts[:, None] + b) & self._mask] < 0).all(axis=1))
                if len(free):
                    break
                tried += 32
            self._shift[a] = shifts[free[0]]
            self._slot[(self._shift[a] + b) & self._mask] = a << 32 | row

    def _keys(self, left: np.ndarray, right: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Rank and row of pairs, which order a fragment's merges."""
        found = self._slot[(self._shift[left] + right) & self._mask]
        return np.where(found >> 32 == left, (found & 0xFFFFFFFF) * ROWS + row, _NEVER).astype(np.int32)

    def __call__(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The symbols (int32) with all merges made within the fragments of 2 to `LONGEST` symbols at `starts`: a merged symbol
        stands in the place of its first, and -1 in the places of the others."""
        out = symbols.copy()
        for least, most in ((2, 4), (5, 8), (9, 12), (13, 16), (17, LONGEST)):
            some = np.flatnonzero((lengths >= least) & (lengths <= most))
            for at in range(0, len(some), COLUMNS):
                part = some[at : at + COLUMNS]
                self._merge(out, starts[part], lengths[part], int(lengths[part].max()))
        return out

    def _merge(self, out: np.ndarray, starts: np.ndarray, lengths: np.ndarray, rows: int) -> None:
        place = np.arange(rows)[:, None] + starts
        there = np.arange(rows)[:, None] < lengths
        # The last row stands for the end: no symbol, and never a merge.
        symbol = np.full((rows + 1, len(starts)), self.size, np.int32)
        symbol[:rows][there] = out[place[there]]
        key = np.full(symbol.shape, _NEVER)
        key[: rows - 1] = self._keys(symbol[: rows - 1], symbol[1:rows], np.arange(rows - 1)[:, None])
        wide = lambda rows: np.array(np.broadcast_to(rows[:, None], symbol.shape), order="C")
        after, before = wide(np.minimum(np.arange(1, rows + 2), rows)), wide(np.concatenate([[rows], np.arange(rows)]))
        column = np.arange(len(starts))
        while True:
            best = key.min(axis=0)
            live = np.flatnonzero(best != _NEVER)
            if len(live) < 0.7 * len(column):  # what is finished goes out; what is not is replaced by a later state
                real = symbol[:rows] != self.size
                out[place[:, column][real]] = symbol[:rows][real]
                if not len(live):
                    return
                symbol, key, after, before = (np.take(x, live, axis=1) for x in (symbol, key, after, before))
                column, best = column[live], best[live]
                live = np.arange(len(column))
            best, width = best[live], len(column)
            symbols, keys, nexts, previous = symbol.reshape(-1), key.reshape(-1), after.reshape(-1), before.reshape(-1)
            row = best & (ROWS - 1)
            first = row * width + live
            second = nexts[first] * width + live
            merged = self.merged[best // ROWS]
            symbols[first], symbols[second], keys[second] = merged, -1, _NEVER
            third = nexts[first] = nexts[second]
            third = third * width + live
            previous[third] = row
            keys[first] = self._keys(merged, symbols[third], row)
            row = previous[first]
            zeroth = row * width + live
            keys[zeroth] = self._keys(symbols[zeroth], merged, row)
