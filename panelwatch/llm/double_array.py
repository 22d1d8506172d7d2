"""Double-array tries in numpy: the arrays behind operator 11.

The child of node s by code c is the slot t = BASE[s] + c if CHECK[t] = s, and there is none otherwise. Nodes
are packed level by level. An only child takes any free slot, so all of a level are placed at once; several
children need free slots at the distances of their codes, the first such place being taken.
"""

from __future__ import annotations

import numpy as np

ROOT = 0
_FREE = -1


class DoubleArray:
    def __init__(self, codes: int):
        self.codes = max(codes, 1)
        self.base = np.zeros(16, np.int64)
        self.check = np.full(16, _FREE, np.int64)
        self.check[ROOT] = ROOT
        self.end = 1  # slots from here on are free
        self.holes = np.zeros(0, np.int64)  # free slots before it

    def child(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of nodes by codes; -1 where there is none."""
        slots = self.base[nodes] + codes
        inside = (slots > ROOT) & (slots < self.end)
        return np.where(inside & (self.check[np.where(inside, slots, ROOT)] == nodes), slots, -1)

    def add(self, nodes: np.ndarray, codes: np.ndarray) -> None:
        """Give childless nodes their children, all of a node's at once."""
        pairs = np.unique(nodes * self.codes + codes)
        parents, codes = np.divmod(pairs, self.codes)
        first = np.flatnonzero(np.diff(parents, prepend=-1))
        sizes = np.diff(first, append=len(parents))
        for at, size in zip(first[sizes > 1], sizes[sizes > 1], strict=True):
            self._place(parents[at], codes[at : at + size])
        alone = first[sizes == 1]
        slots = self._take(len(alone))
        self.base[parents[alone]] = slots - codes[alone]
        self.check[slots] = parents[alone]

    def _grow(self, end: int) -> None:
        self.end = max(self.end, end)
        if self.end > len(self.base):
            more = max(2 * len(self.base), self.end) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, _FREE, np.int64)])

    def _take(self, n: int) -> np.ndarray:
        taken, self.holes = self.holes[:n], self.holes[n:]
        fresh = np.arange(self.end, self.end + n - len(taken))
        self._grow(self.end + len(fresh))
        return np.concatenate([taken, fresh])

    def _place(self, parent: int, codes: np.ndarray) -> None:
        apart = codes - codes[0]
        fits = np.ones(len(self.holes), bool)
        for far in apart[1:]:
            slots = self.holes + far
            fits &= (slots >= self.end) | (self.check[np.minimum(slots, self.end - 1)] == _FREE)
            if not fits.any():
                break
        start = self.holes[np.argmax(fits)] if fits.any() else self.end
        slots = start + apart
        before = self.end
        self._grow(int(slots[-1]) + 1)
        self.base[parent] = start - codes[0]
        self.check[slots] = parent
        free = np.concatenate([self.holes, np.arange(before, self.end)])
        self.holes = free[self.check[free] == _FREE]
