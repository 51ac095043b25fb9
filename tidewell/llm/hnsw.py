"""A hierarchical navigable small-world graph over one shard of vectors.

Flat arrays only: per level a table of neighbours (rows of -1 padded numbers),
so a shard's index is one row of a table. Vectors enter in blocks; a block is
searched in lockstep (one beam per query, all advanced together by NumPy), linked
to its nearest by the usual diversity rule, and links are mirrored. Distances
are squared Euclidean in float32 for the walk; callers judge results in double.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from . import textbytes as tb


@dataclass(frozen=True)
class GraphSpec:
    links: int = 16
    build_beam: int = 64
    block: int = 512
    seed: int = 5


class Graph:
    """``vectors`` (n x d, float32); node numbers are row numbers."""

    def __init__(self, vectors: np.ndarray, spec: GraphSpec = GraphSpec()) -> None:
        self.x = np.ascontiguousarray(vectors, dtype=np.float32)
        self.sq = np.einsum("ij,ij->i", self.x, self.x)
        self.spec = spec
        self.tables: list[np.ndarray] = []
        self.entry = 0

    # -- building ---------------------------------------------------------
    def build(self) -> "Graph":
        n, s = len(self.x), self.spec
        u = tb.uniform(tb.mix64(np.arange(n, dtype=np.uint64) + np.uint64(s.seed)))
        level = np.minimum(np.floor(-np.log(u) / np.log(s.links)), 8).astype(np.int64)
        # higher nodes first: every block finds the levels above it complete
        order = np.argsort(-level, kind="stable")
        self.tables = [np.full((n, 2 * s.links if lv == 0 else s.links), -1, np.int32)
                       for lv in range(int(level.max(initial=0)) + 1)]
        self.entry = int(order[0]) if n else 0
        done, size = 1, 1
        while done < n:
            block = order[done:done + size]
            self._insert(block, level)
            done += len(block)
            size = min(s.block, done)  # a block never outgrows what it can link to
        return self

    def _insert(self, block: np.ndarray, level: np.ndarray) -> None:
        s = self.spec
        beam = np.full((len(block), 1), self.entry, np.int64)
        for lv in range(len(self.tables) - 1, -1, -1):
            joins = level[block] >= lv
            wide = s.build_beam if joins.any() else 1
            beam, dist = self._beam(self.x[block], beam, lv, wide)
            rows = np.flatnonzero(joins)
            if len(rows):
                self._link(block[rows], beam[rows], dist[rows], lv)

    def _link(self, nodes, beam, dist, lv) -> None:
        table = self.tables[lv]
        table[nodes, :self.spec.links] = self._diverse(nodes, beam, dist, self.spec.links)
        src = np.repeat(nodes, self.spec.links)
        dst = table[nodes, :self.spec.links].reshape(-1).astype(np.int64)
        src, dst = src[dst >= 0], dst[dst >= 0]
        if not len(dst):
            return
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        touched, first, count = np.unique(dst, return_index=True, return_counts=True)
        width = table.shape[1]
        own = table[touched]
        free = (own >= 0).sum(1)
        fits = free + count <= width
        # room left: append behind the links there are
        which = np.repeat(np.arange(len(touched)), count)
        slot = np.arange(len(dst)) - np.repeat(first, count) + free[which]
        ok = fits[which]
        table[dst[ok], slot[ok]] = src[ok]
        # no room: the old and new links compete again, all such nodes at once
        full = np.flatnonzero(~fits)
        for lo in range(0, len(full), self.spec.block):
            part = full[lo:lo + self.spec.block]
            pool = np.full((len(part), width + int(count[part].max())), -1, np.int64)
            pool[:, :width] = own[part]
            row = np.repeat(np.arange(len(part)), count[part])
            col = np.arange(len(row)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
            pool[row, width + col] = src[np.repeat(first[part], count[part]) + col]
            d = self._dist(self.x[touched[part]], pool)
            near = np.argsort(d, axis=1, kind="stable")[:, :2 * width]
            table[touched[part]] = self._diverse(touched[part], np.take_along_axis(pool, near, 1),
                                                 np.take_along_axis(d, near, 1), width)

    def _diverse(self, nodes, cand, dist, m) -> np.ndarray:
        """Per node at most m candidates, each nearer to the node than to any chosen
        before; free places go to the nearest of the rest."""
        b, k = cand.shape
        chosen = np.zeros((b, k), bool)
        valid = (cand >= 0) & (cand != nodes[:, None]) & np.isfinite(dist)
        nearest_chosen = np.full((b, k), np.inf, np.float32)
        count = np.zeros(b, np.int64)
        safe = np.maximum(cand, 0)
        xs, sq = self.x[safe], self.sq[safe]
        for j in range(k):
            take = valid[:, j] & (dist[:, j] < nearest_chosen[:, j]) & (count < m)
            rows = np.flatnonzero(take)
            if len(rows):
                chosen[rows, j] = True
                count[rows] += 1
                to = sq[rows] + sq[rows, j][:, None] - 2 * np.einsum("bkd,bd->bk", xs[rows], xs[rows, j])
                nearest_chosen[rows] = np.minimum(nearest_chosen[rows], np.maximum(to, 0))
        rest = valid & ~chosen
        rank = np.where(chosen, 0, np.where(rest, 1, 2)) * (k + 1) + np.arange(k)
        pick = np.argsort(rank, axis=1, kind="stable")[:, :m]
        out = np.take_along_axis(cand, pick, 1).astype(np.int32)
        out[np.take_along_axis(rank, pick, 1) >= 2 * (k + 1)] = -1
        if out.shape[1] < m:
            out = np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)
        return out

    # -- searching --------------------------------------------------------
    def _dist(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        safe = np.maximum(nodes, 0)
        d = self.sq[safe] + np.einsum("ij,ij->i", q, q)[:, None] - 2 * np.einsum("bkd,bd->bk", self.x[safe], q)
        return np.where(nodes >= 0, np.maximum(d, 0), np.inf).astype(np.float32)

    def _beam(self, q: np.ndarray, seeds: np.ndarray, lv: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest nodes of each query on a level, nearest first (-1 and inf where fewer)."""
        b, table = len(q), self.tables[lv]
        seen = np.zeros((b, (len(self.x) + 7) // 8), np.uint8)
        dist = self._dist(q, seeds)
        order = np.argsort(dist, axis=1, kind="stable")[:, :width]
        ids, dist = np.take_along_axis(seeds, order, 1), np.take_along_axis(dist, order, 1)
        pad = width - ids.shape[1]
        if pad > 0:
            ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1)
            dist = np.pad(dist, ((0, 0), (0, pad)), constant_values=np.inf)
        open_ = ids >= 0
        self._mark(seen, np.arange(b)[:, None], seeds)
        live = np.arange(b)
        while len(live):
            has = open_[live].any(1)
            live = live[has]
            if not len(live):
                break
            at = np.argmax(open_[live], axis=1)  # rows are sorted: the first open one is the nearest
            open_[live, at] = False
            near = table[ids[live, at]].astype(np.int64)
            known = (seen[live[:, None], np.maximum(near, 0) >> 3] >> (near & 7).astype(np.uint8)) & 1
            near = np.where((near >= 0) & (known == 0), near, -1)
            self._mark(seen, live[:, None], near)
            d = self._dist(q[live], near)
            all_ids = np.concatenate([ids[live], near], 1)
            all_d = np.concatenate([dist[live], d], 1)
            all_open = np.concatenate([open_[live], near >= 0], 1)
            keep = np.argsort(all_d, axis=1, kind="stable")[:, :width]
            ids[live] = np.take_along_axis(all_ids, keep, 1)
            dist[live] = np.take_along_axis(all_d, keep, 1)
            open_[live] = np.take_along_axis(all_open, keep, 1) & np.isfinite(dist[live])
        return np.where(np.isfinite(dist), ids, -1), dist

    @staticmethod
    def _mark(seen, rows, nodes) -> None:
        r = np.broadcast_to(rows, nodes.shape)[nodes >= 0]
        v = nodes[nodes >= 0]
        np.bitwise_or.at(seen, (r, v >> 3), (1 << (v & 7)).astype(np.uint8))

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes found per query, nearest first."""
        q = np.ascontiguousarray(q, dtype=np.float32)
        beam = np.full((len(q), 1), self.entry, np.int64)
        for lv in range(len(self.tables) - 1, 0, -1):
            beam, _ = self._beam(q, beam, lv, 1)
        return self._beam(q, beam, 0, min(width, max(1, len(self.x))))

    # -- flat form --------------------------------------------------------
    def flat(self) -> tuple[int, list[int], list[bytes]]:
        """Entry node, width per level, neighbour arrays as bytes; of the upper levels
        only the rows that have links."""
        out, widths = [], []
        for lv, t in enumerate(self.tables):
            rows = np.arange(len(t)) if lv == 0 else np.flatnonzero((t >= 0).any(1))
            widths.append(t.shape[1])
            out.append(np.concatenate([rows[:, None].astype(np.int32), t[rows]], 1).tobytes())
        return self.entry, widths, out

    @classmethod
    def from_flat(cls, vectors: np.ndarray, entry: int, widths: list[int], arrays: list[bytes]) -> "Graph":
        g = cls(vectors)
        g.entry = entry
        for w, raw in zip(widths, arrays):
            rows = np.frombuffer(raw, np.int32).reshape(-1, w + 1)
            t = np.full((len(g.x), w), -1, np.int32)
            t[rows[:, 0]] = rows[:, 1:]
            g.tables.append(t)
        return g
