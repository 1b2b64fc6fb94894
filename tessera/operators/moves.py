"""Moves of vertices between communities inside one bounded block of a graph."""

from __future__ import annotations

from collections import deque

import numpy as np

#: Gain in quality below which a move is not made.
TOLERANCE = 1e-12


class Block:
    """Vertices 0..n-1, edges in both directions, strengths ``k`` and total strengths ``two_m`` of their graphs."""

    def __init__(self, n: int, src: np.ndarray, dst: np.ndarray, w: np.ndarray, k: np.ndarray, two_m: np.ndarray):
        # Edges arrive in any order, and vertices are queued in theirs.
        order = np.lexsort((dst, src))
        self.n, self.k, self.two_m = n, k, two_m
        self.src, self.dst, self.w = src[order], dst[order], w[order]
        self.first = np.searchsorted(self.src, np.arange(n + 1)).tolist()

    def move(self, label: list[int], tot: dict[int, float], fixed: list[dict[int, float]] | None = None) -> bool:
        """Move vertices, each to its best community (ties: the smallest), until none gains; whether any has moved.

        ``tot`` has the strength of each community; ``fixed`` the weights of
        a vertex to members that do not move.
        """
        first, near, w, k, two_m = self.first, self.dst.tolist(), self.w.tolist(), self.k.tolist(), self.two_m.tolist()
        queue, waits, any_moved = deque(range(self.n)), [True] * self.n, False
        while queue:
            v = queue.popleft()
            waits[v] = False
            own = label[v]
            to = dict(fixed[v]) if fixed else {}
            to.setdefault(own, 0.0)
            for e in range(first[v], first[v + 1]):
                c = label[near[e]]
                to[c] = to.get(c, 0.0) + w[e]
            if len(to) == 1:
                continue
            share = k[v] / two_m[v]
            stay = to[own] - share * (tot[own] - k[v])
            best, most = own, stay
            for c, x in to.items():
                if c != own:
                    x -= share * tot[c]
                    if x > most or (x == most and best != own and c < best):
                        best, most = c, x
            if 2 * (most - stay) / two_m[v] > TOLERANCE:
                tot[own] -= k[v]
                tot[best] += k[v]
                label[v], any_moved = best, True
                for e in range(first[v], first[v + 1]):
                    u = near[e]
                    if label[u] != best and not waits[u]:
                        waits[u] = True
                        queue.append(u)
        return any_moved

    def connected(self, label: np.ndarray) -> np.ndarray:
        """Labels of the connected parts of each community: the smallest vertex of the part."""
        same = label[self.src] == label[self.dst]
        a, b = self.src[same], self.dst[same]
        part = np.arange(self.n)
        while True:
            least = part.copy()
            np.minimum.at(least, a, part[b])
            least = least[least]
            if np.array_equal(least, part):
                return part
            part = least

    def merged(self, label: np.ndarray) -> tuple[Block, np.ndarray]:
        """The graph of communities, and the community of each vertex."""
        names, own = np.unique(label, return_inverse=True)
        n = len(names)
        pair, at = np.unique(own[self.src] * n + own[self.dst], return_inverse=True)
        w = np.bincount(at, self.w, len(pair))
        a, b = pair // n, pair % n
        apart = a != b
        two_m = np.zeros(n)
        two_m[own] = self.two_m
        return Block(n, a[apart], b[apart], w[apart], np.bincount(own, self.k, n), two_m), own


def settle(block: Block, label: np.ndarray) -> np.ndarray:
    """Communities, named by their smallest vertex, in which no move of a vertex or of a whole community gains; all connected."""
    while True:
        held = label.tolist()
        block.move(held, _totals(held, block.k))
        label = block.connected(np.array(held, np.int64))
        again = len(np.unique(label)) != len(set(held))
        # Whole communities, then communities of communities.
        level, own = block.merged(label)
        while True:
            up = list(range(level.n))
            if not level.move(up, _totals(up, level.k)):
                break
            again = True
            level, onward = level.merged(level.connected(np.array(up, np.int64)))
            own = onward[own]
        least = np.full(own.max() + 1, block.n, np.int64)
        np.minimum.at(least, own, np.arange(block.n))
        label = least[own]
        if not again:
            return label


def _totals(label: list[int], k: np.ndarray) -> dict[int, float]:
    tot: dict[int, float] = {}
    for c, x in zip(label, k.tolist()):
        tot[c] = tot.get(c, 0.0) + x
    return tot
