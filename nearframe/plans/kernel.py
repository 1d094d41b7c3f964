"""NumPy kernel of the wide-vector strategies: exact k nearest rows of a block.

Distances are defined as the left-to-right sum of squared differences and its
square root, the same doubles as the SQL expression. Computing that for every
pair costs a pass over memory per dimension, so wide vectors go through a filter
first:

    |q|^2 + |t|^2 - 2 q.t

comes from one matrix product per block. With ``u = 2^-53`` and dimension ``d``,
each of the three terms and the sequential sum itself are off by at most
``(d + 2) u / (1 - (d + 2) u)`` of ``|q|^2 + |t|^2`` (times two for the sum, as
``|q - t|^2 <= 2 (|q|^2 + |t|^2)``), whatever order the product adds in. Twice their
sum is ``slack(d)``. A pair whose filter value minus the slack exceeds the square
of the query's current k-th distance cannot enter; only the pairs that stay get the
exact distance. Ties and ids are decided on exact distances alone, so the result has
the same bits as without the filter.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

#: Entries of one distance block, and of a tile that stays in cache.
BLOCK_ELEMS = 4_000_000
_CACHE_ELEMS = 32_768
#: Queries that meet a block of train at once.
QUERY_TILE = 2_048
#: From this width on a matrix product and a few exact pairs are cheaper.
FILTER_MIN_DIM = 8
#: Above all errors of products that underflow, which no relative bound covers.
TINY = 1e-290

# Ship this module's helpers with the task closure, so executors need no
# installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def squared_block(Q: np.ndarray, X: np.ndarray) -> np.ndarray:
    """(nq, nb) squared distances, summed dimension by dimension in order.

    Query rows are taken in tiles of about ``_CACHE_ELEMS`` entries, so each
    tile's running sum stays in cache across the dimensions; the first
    square is stored directly, the same double as ``0.0 + square``.
    """
    nq, nb, d = Q.shape[0], X.shape[0], Q.shape[1]
    out = np.empty((nq, nb), dtype=np.float64)
    XT = np.ascontiguousarray(X.T)
    rows = max(1, _CACHE_ELEMS // max(1, nb))
    tmp = np.empty((min(rows, nq), nb), dtype=np.float64)
    for a in range(0, nq, rows):
        acc = out[a : a + rows]
        t = tmp[: acc.shape[0]]
        for j in range(d):
            dst = acc if j == 0 else t
            np.subtract(Q[a : a + rows, j : j + 1], XT[j][None, :], out=dst)
            np.multiply(dst, dst, out=dst)
            if j:
                acc += t
    return out


def root_block(Q: np.ndarray, X: np.ndarray) -> np.ndarray:
    """(nq, nb) Euclidean distances, square root taken in place."""
    acc = squared_block(Q, X)
    return np.sqrt(acc, out=acc)


def pair_distances(Q: np.ndarray, X: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances of the pairs (Q[r], X[c]), bit for bit those of ``root_block``."""
    out = np.empty(len(r))
    step = max(1, (1 << 20) // max(1, Q.shape[1]))
    for s in range(0, len(r), step):
        diff = (Q[r[s : s + step]] - X[c[s : s + step]]).T.copy()
        np.multiply(diff, diff, out=diff)
        acc = diff[0]
        for j in range(1, len(diff)):
            acc += diff[j]
        np.sqrt(acc, out=out[s : s + step])
    return out


def slack(d: int) -> float:
    """Relative allowance of the filter, above twice its proven error."""
    return 2.0 * (4 * (d + 2) + 16) * 2.0**-53


class Side:
    """Rows prepared for the product: ``q . t - (1 - slack) |t|^2 / 2`` is one
    product of the query form with the train form."""

    def __init__(self, M: np.ndarray):
        self.M = M
        self.norm = np.einsum("ij,ij->i", M, M)
        self._query = self._train = None

    @property
    def query(self) -> np.ndarray:
        if self._query is None:
            self._query = np.concatenate([self.M, np.full((len(self.M), 1), -1.0)], axis=1)
        return self._query

    @property
    def train(self) -> np.ndarray:
        if self._train is None:
            half = (1.0 - slack(self.M.shape[1])) * self.norm / 2
            self._train = np.concatenate([self.M, half[:, None]], axis=1)
        return self._train

    def rows(self, at: slice | np.ndarray) -> Side:
        return Side(self.M[at])


def same_ids(ids: np.ndarray, tids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (r, c) with ``ids[r] == tids[c]``; ids of any type, repeats kept."""
    if ids.dtype == object or tids.dtype == object:
        where: dict = {}
        for c, t in enumerate(tids.tolist()):
            where.setdefault(t, []).append(c)
        hits = [(r, c) for r, i in enumerate(ids.tolist()) for c in where.get(i, ())]
        return np.array([h[0] for h in hits], np.int64), np.array([h[1] for h in hits], np.int64)
    order = np.argsort(tids, kind="stable")
    s = tids[order]
    low, high = np.searchsorted(s, ids, "left"), np.searchsorted(s, ids, "right")
    n = high - low
    r = np.repeat(np.arange(len(ids)), n)
    c = order[np.repeat(low, n) + np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)]
    return r, c


class RunningTopK:
    """k best (dist, train_id) per query, exact under ties.

    Each step keeps from the new block only entries that beat the row's
    current k-th by (dist, train_id). When many pass (the first block), each
    row is cut to its own k best in the block: the entries below the row's
    k-th smallest distance, plus the first entries equal to it in train-id
    order (the block is sorted by train id), enough to make k. The survivors
    merge with the current k, sorted by (query, dist, train_id), cut at k.
    """

    def __init__(self, n_queries: int, k: int, id_dtype, label_dtype):
        self.k = k
        self.d = np.full((n_queries, k), np.inf)
        self.i = np.zeros((n_queries, k), dtype=id_dtype)
        self.lab = np.empty((n_queries, k), dtype=label_dtype)
        self.scored = 0

    def push(self, D: np.ndarray, tid: np.ndarray, lab: np.ndarray) -> None:
        nq, nb = D.shape
        k = self.k
        if nb > 1 and np.any(tid[1:] < tid[:-1]):
            o = np.argsort(tid, kind="stable")
            D, tid, lab = D[:, o], tid[o], lab[o]
        # Only entries that beat the current k-th by (dist, train_id) can
        # enter; NaN and infinity never pass. Once a query's list is full,
        # this is two comparisons and no selection.
        bd = self.d[:, k - 1][:, None]
        bi = self.i[:, k - 1][:, None]
        mask = D < bd
        tr, tc = np.nonzero((D == bd) & np.isfinite(bd))
        if len(tr):  # ids are compared only where distances tie, so they may be of any type
            lower = tid[tc] < bi[tr, 0]
            mask[tr[lower], tc[lower]] = True
        if nb > k and np.count_nonzero(mask) > 4 * k * nq:
            # many candidates (first block, or a block better than the list):
            # cut each row to its k best within the block, ties by train id
            Dm = np.where(mask, D, np.inf)
            kth = np.partition(Dm, k - 1, axis=1)[:, k - 1]
            less = Dm < kth[:, None]
            eq = (Dm == kth[:, None]) & mask
            need = k - less.sum(axis=1, dtype=np.int32)
            mask = less | (eq & (np.cumsum(eq, axis=1, dtype=np.int32) <= need[:, None]))
        r, c = np.nonzero(mask)
        self._merge(r, D[r, c], tid[c], lab[c])

    def push_block(self, q: Side, t: Side, qids: np.ndarray, tid: np.ndarray, lab: np.ndarray, exclude_self: bool, bound: np.ndarray | None = None) -> None:
        """Rows ``t`` offered to all queries ``q``; ``bound`` is a distance known
        not to be below a query's k-th over all of train."""
        k, d = self.k, q.M.shape[1]
        r0, c0 = same_ids(qids, tid) if exclude_self else (np.zeros(0, np.int64),) * 2
        self.scored += len(q.M) * len(t.M)
        if d < FILTER_MIN_DIM:
            D = root_block(q.M, t.M)
            D[r0, c0] = np.inf
            self.push(D, tid, lab)
            return
        g = slack(d)
        with np.errstate(all="ignore"):
            P = q.query @ t.train.T
            P[r0, c0] = -np.inf
            limit = self.d[:, k - 1] if bound is None else np.minimum(self.d[:, k - 1], bound)
            limit = limit * limit * (1.0 + 1e-14) + TINY
            open_ = np.flatnonzero(~np.isfinite(limit))
            if len(open_) and len(t.M) >= k:
                # the k-th best of the block itself, by its upper bound
                kth = np.partition(P[open_], len(t.M) - k, axis=1)[:, len(t.M) - k]
                up = (1.0 + g) * q.norm[open_] + 2.0 * g * t.norm.max() - 2.0 * kth
                limit[open_] = np.where(np.isfinite(up), np.maximum(up, 0.0) * (1.0 + 1e-14) + TINY, np.inf)
            # a value that is no number (overflow) is kept for the exact distance
            keep = ~(P < (((1.0 - g) * q.norm - limit) / 2)[:, None])
        keep[r0, c0] = False
        if np.count_nonzero(keep) * 8 > keep.size and keep.size > 4096:
            # mostly ties, or no bound yet: the plain block is cheaper
            D = root_block(q.M, t.M)
            D[r0, c0] = np.inf
            self.push(D, tid, lab)
            return
        r, c = np.nonzero(keep)
        with np.errstate(over="ignore"):
            dist = pair_distances(q.M, t.M, r, c)
        bd = self.d[r, k - 1]
        enter = dist < bd
        tie = np.flatnonzero((dist == bd) & np.isfinite(bd))
        if len(tie):
            enter[tie[tid[c[tie]] < self.i[r[tie], k - 1]]] = True
        self._merge(r[enter], dist[enter], tid[c[enter]], lab[c[enter]])

    def _merge(self, r: np.ndarray, dist: np.ndarray, ids: np.ndarray, labs: np.ndarray) -> None:
        """Candidates of the queries ``r`` (any order) with the current lists."""
        if not len(r):
            return
        k = self.k
        # merge only the queries with a hit
        touched, at = np.unique(r, return_inverse=True)
        held, hi, hl = self.d[touched], self.i[touched], self.lab[touched]
        cr, cc = np.nonzero(np.isfinite(held))
        rows = np.concatenate([cr, at])
        dist = np.concatenate([held[cr, cc], dist])
        ids = np.concatenate([hi[cr, cc], ids])
        labs = np.concatenate([hl[cr, cc], labs])
        key = np.unique(ids, return_inverse=True)[1] if ids.dtype == object else ids
        order = np.lexsort((key, dist, rows))
        rows, dist, ids, labs = rows[order], dist[order], ids[order], labs[order]
        starts = np.searchsorted(rows, np.arange(len(touched)))
        rank = np.arange(rows.size) - starts[rows]
        keep = (rank < k) & np.isfinite(dist)
        self.d[touched] = np.inf
        to = touched[rows[keep]]
        self.d[to, rank[keep]] = dist[keep]
        self.i[to, rank[keep]] = ids[keep]
        self.lab[to, rank[keep]] = labs[keep]

    def hits(self) -> tuple[np.ndarray, np.ndarray]:
        """(query row, rank from 0) of the entries found so far."""
        return np.nonzero(np.isfinite(self.d))


class Search:
    """Lists of many queries, in tiles, over blocks that come one by one."""

    def __init__(self, Q: np.ndarray, qids: np.ndarray, k: int, exclude_self: bool, bound: np.ndarray | None = None):
        self.k, self.exclude_self, self.states = k, exclude_self, None
        self.qids, self.bound = qids, bound
        self.tiles = [(a, Side(Q[a : a + QUERY_TILE])) for a in range(0, len(Q), QUERY_TILE)]

    def push(self, X: np.ndarray, tid: np.ndarray, lab: np.ndarray) -> None:
        if not len(X):
            return
        if len(tid) > 1 and np.any(tid[1:] < tid[:-1]):
            o = np.argsort(tid, kind="stable")
            X, tid, lab = X[o], tid[o], lab[o]
        if self.states is None:
            self.states = [RunningTopK(len(q.M), self.k, tid.dtype, lab.dtype) for _, q in self.tiles]
        step = max(1, BLOCK_ELEMS // max(1, min(QUERY_TILE, len(self.qids))))
        for s in range(0, len(X), step):
            t = Side(X[s : s + step])
            for (a, q), state in zip(self.tiles, self.states):
                bound = None if self.bound is None else self.bound[a : a + QUERY_TILE]
                state.push_block(q, t, self.qids[a : a + QUERY_TILE], tid[s : s + step], lab[s : s + step], self.exclude_self, bound)

    @property
    def scored(self) -> int:
        return sum(s.scored for s in self.states or ())

    def kth(self) -> np.ndarray:
        """Each query's k-th distance so far, infinite where there are fewer."""
        if self.states is None:
            return np.full(len(self.qids), np.inf)
        return np.concatenate([s.d[:, self.k - 1] for s in self.states]) if self.states else np.zeros(0)

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query position, rank from 1, train id, label, distance) of all lists."""
        parts = []
        for (a, _), s in zip(self.tiles, self.states or ()):
            r, c = s.hits()
            parts.append((r + a, c + 1, s.i[r, c], s.lab[r, c], s.d[r, c]))
        if not parts:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, object),) * 2 + (np.zeros(0),)
        return tuple(np.concatenate(x) for x in zip(*parts))
