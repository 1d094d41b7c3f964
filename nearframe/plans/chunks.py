"""Exact kNN of low-dimensional rows: chunks of space, searched with NumPy.

1. **Chunks.** A bounded sample of train (chosen by a hash) is halved along its widest
   axis until a part stands for some ``CHUNK_ROWS`` rows. Any halves are correct; they
   only decide how even the chunks are. Every row goes to the chunk it lies in, in packs
   of compressed columns, which move once and are kept in the checkpoint folder. Where
   both sides are one table, its rows are sent once. A chunk where the sample has many
   more queries than usual is cut into parts of queries, each with all train rows; of a
   point that crowds a pack only the train rows that can be neighbours are sent.
2. **Borders.** A quick bound of each query's k-th distance tells which balls stay within
   their chunk's reach. The others are searched at home; where the ball of the true k-th
   distance still reaches the box of another chunk's train rows, the query goes there as
   well, with its bound. With ``n`` rows in a chunk of ``d`` axes that are some
   ``d / n^(1/d)`` of the queries, and only they are kept before the end.
3. **At home.** Queries meet the train rows of their own chunk, one group a task, as the
   result is read: lists of queries that stay at home go nowhere else, the others are
   merged with what was found abroad.

Inside a chunk, of equal train rows those with the lowest ids stay, and equal queries are
searched once. Train rows are ordered by halves down to leaves of ``LEAF`` rows;
queries come in blocks that lie together, and a query meets the leaves whose boxes its
bound reaches. Box distances get an allowance far above rounding; distances themselves
are the doubles of the SQL expression, and ties go by train id.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint, release
from .brute import rank_neighbours
from .choose import Sizes, count_prepared
from .prepare import DIST, LABEL, QUERY_ID, RANK, TRAIN_ID, Prepared
from .vectorized import matrix, neighbour_schema, unpacked, values

#: Train rows of a chunk, about; small inputs still give every core some chunks.
CHUNK_ROWS = 131_072
LEAST_ROWS = 4_096
CHUNKS_PER_CORE = 3
#: Rows of the sample, in all and for each chunk.
SAMPLE = 65_536
SAMPLE_PER_CHUNK = 48
SAMPLE_MOST = 1 << 20
LEAF = 32
BLOCK = 128
#: Leaves of one larger box, and those that give the first bound.
SUPER = 32
FIRST = 8
#: Rows that a task packs at once, and bytes of packs that leave it together.
PACK_ROWS = 1 << 19
PACK_BYTES = 16 << 20
#: Train rows of one point in a pack that make it a crowd.
CROWD = 64
#: Rows of one train id in a chunk up to which lists are made so much longer that a query's
#: own rows can leave them; beyond, own rows are told apart in the search.
OWN_ROWS = 4
#: Train rows a visiting query below which only those around the visitors are ordered.
FEW = 64
#: (query, leaf) pairs scored at once.
PAIRS = 1 << 14
#: Relative allowance of box distances, and above all errors of squares that underflow.
SLACK = 1e-9
TINY = 1e-290

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Halves:
    """Cuts of a sample into ``parts`` chunks: a tree of (axis, value)."""

    def __init__(self, sample: np.ndarray, parts: int):
        self.axis, self.cut, self.kids, self.parts = [], [], [], 0
        self.root = self._grow(sample, parts)
        self.axis, self.cut, self.kids = np.array(self.axis, int), np.array(self.cut, float), np.array(self.kids, int).reshape(-1, 2)

    def _grow(self, rows: np.ndarray, parts: int) -> int:
        with np.errstate(over="ignore"):
            wide = np.ptp(rows, axis=0) if len(rows) else np.zeros(1)
        if parts > 1 and wide.max() > 0:
            j = int(wide.argmax())
            x = np.sort(rows[:, j])
            value = x[len(x) * (parts // 2) // parts]
            if value == x[0]:
                value = x[x > x[0]][0]
            at = len(self.axis)
            self.axis.append(j)
            self.cut.append(value)
            self.kids.append(None)
            low = rows[:, j] < value
            self.kids[at] = (self._grow(rows[low], parts // 2), self._grow(rows[~low], parts - parts // 2))
            return at
        self.parts += 1
        return -self.parts

    def chunk(self, M: np.ndarray) -> np.ndarray:
        at = np.full(len(M), self.root)
        while len(live := np.flatnonzero(at >= 0)):
            node = at[live]
            at[live] = self.kids[node, (M[live, self.axis[node]] >= self.cut[node]).astype(int)]
        return -1 - at


def in_halves(X: np.ndarray, size: int) -> np.ndarray:
    """The rows' order by halves of the widest axis, down to runs of ``size``."""
    order, todo = np.arange(len(X)), [(0, len(X))]
    while todo:
        a, b = todo.pop()
        if b - a > size:
            rows = X[order[a:b]]
            x = rows[:, (rows.max(axis=0) - rows.min(axis=0)).argmax()]
            mid = size * (-(-(b - a) // size) // 2)
            order[a:b] = order[a:b][np.argpartition(x, mid)]
            todo += [(a, a + mid), (a + mid, b)]
    return order


def gap(lo: np.ndarray, hi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> np.ndarray:
    """Squared distances of boxes (or points); the axis comes last."""
    out = 0.0
    for j in range(blo.shape[-1]):
        x = np.maximum(np.maximum(blo[..., j] - hi[..., j], lo[..., j] - bhi[..., j]), 0.0)
        out = out + x * x
    return out


def limit(bound: np.ndarray) -> np.ndarray:
    return bound * bound * (1.0 + SLACK) + TINY


class Leaves:
    """The train rows of a chunk, in leaves; ``key`` orders their ids."""

    def __init__(self, X: np.ndarray, key: np.ndarray):
        order = in_halves(X, LEAF)
        pad = -len(X) % LEAF
        self.row = np.concatenate([order, np.zeros(pad, order.dtype)]).reshape(-1, LEAF)
        # rows that fill the last leaf up are infinitely far
        Y = np.concatenate([X[order], np.full((pad, X.shape[1]), np.inf)]).reshape(-1, LEAF, X.shape[1])
        self.axes = [np.ascontiguousarray(Y[:, :, j]) for j in range(X.shape[1])]
        self.key = key[self.row]
        self.lo, self.hi = Y.min(axis=1), Y.max(axis=1)
        starts = np.arange(0, len(self.row), SUPER)
        self.slo, self.shi = (f.reduceat(x, starts, axis=0) for f, x in ((np.minimum, self.lo), (np.maximum, self.hi)))

    def _near(self, lo: np.ndarray, hi: np.ndarray, most: float) -> np.ndarray:
        """The leaves whose boxes reach the box within the squared distance."""
        sup = np.flatnonzero(gap(lo, hi, self.slo, self.shi) <= most)
        at = (sup[:, None] * SUPER + np.arange(SUPER)).ravel()
        at = at[at < len(self.row)]
        return at[gap(lo, hi, self.lo[at], self.hi[at]) <= most]

    def _squares(self, Q: np.ndarray, q: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """(pairs, LEAF) squared distances, summed axis by axis."""
        acc = None
        for j, x in enumerate(self.axes):
            diff = x[leaf]
            np.subtract(Q[q, j][:, None], diff, out=diff)
            np.multiply(diff, diff, out=diff)
            acc = diff if acc is None else np.add(acc, diff, out=acc)
        return acc

    def box_bound(self, lo: np.ndarray, hi: np.ndarray, rows: int) -> float:
        """What bounds the distances of the ``rows`` nearest rows of any query in the box:
        the farthest corner of the best leaf."""
        if rows > LEAF:
            return np.inf
        far = 0.0  # infinite where a leaf is not full
        for j in range(self.lo.shape[1]):
            x = np.maximum(hi[j] - self.lo[:, j], self.hi[:, j] - lo[j])
            far = far + x * x
        return np.sqrt(far.min()) * (1.0 + SLACK)

    def first_bound(self, Q: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
        """Upper bounds of the k-th distances of queries that lie together."""
        lo, hi = Q.min(axis=0), Q.max(axis=0)
        sup = gap(lo, hi, self.slo, self.shi)
        reach = np.sort(sup)[min(2, len(sup) - 1)]
        first = self._near(lo, hi, reach)
        if len(first) > FIRST:
            first = first[np.argpartition(gap(lo, hi, self.lo[first], self.hi[first]), FIRST)[:FIRST]]
        n = len(first)
        if n * LEAF < k:
            return np.full(len(Q), np.inf)
        D = self._squares(Q, np.repeat(np.arange(len(Q)), n), np.tile(first, len(Q))).reshape(len(Q), n * LEAF)
        if (key >= 0).any():
            D[key[:, None] == self.key[first].reshape(1, -1)] = np.inf
        return np.sqrt(np.partition(D, k - 1, axis=1)[:, k - 1])

    def search(self, Q: np.ndarray, key: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, train row, distance) of each query's k nearest rows within its
        bound, for queries that lie together, by query and rank."""
        lo, hi = Q.min(axis=0), Q.max(axis=0)
        if np.isinf(bound).any():
            bound = np.minimum(bound, self.first_bound(Q, key, k))
        most = limit(bound)
        near = self._near(lo, hi, most.max())
        points = Q[:, None, :]
        found = []
        step = max(1, PAIRS * 8 // max(1, len(Q)))
        for a in range(0, len(near), step):
            some = near[a : a + step]
            q, at = np.nonzero(gap(points, points, self.lo[some], self.hi[some]) <= most[:, None])
            for s in range(0, len(q), PAIRS):
                mine, leaf = q[s : s + PAIRS], some[at[s : s + PAIRS]]
                D = self._squares(Q, mine, leaf)
                r, c = np.nonzero((D <= most[mine][:, None]) & np.isfinite(D))
                mine, leaf = mine[r], leaf[r]
                tkey = self.key[leaf, c]
                other = tkey != key[mine]
                found.append([x[other] for x in (mine, self.row[leaf, c], np.sqrt(D[r, c]), tkey)])
        if not found:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        q, row, dist, tkey = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((tkey, dist, q))
        q, row, dist = q[order], row[order], dist[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        return tuple(x[rank < k] for x in (q, row, dist))


def _lists(n: int, q: np.ndarray, body: pa.Array, kind: pa.DataType) -> pa.Array:
    """A list for each of ``n`` rows from values ordered by their row ``q``."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(q, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), body, type=kind)


def _runs(X: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal rows follow each other, by ``keys`` among themselves, and
    the number of the row's run there. Two runs may be of one point; a run never is of two."""
    h = np.zeros(len(X), np.uint64)
    for j in range(X.shape[1]):
        h = (h ^ np.ascontiguousarray(X[:, j]).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    order = np.lexsort((*reversed(keys), h)) if keys else np.argsort(h, kind="stable")
    Y = X[order]
    new = np.ones(len(X), bool)
    new[1:] = (Y[1:] != Y[:-1]).any(axis=1)
    return order, np.cumsum(new) - 1


def _place(run: np.ndarray) -> np.ndarray:
    """Each row's place in its run."""
    return np.arange(len(run)) - np.searchsorted(run, run)


def _spare(X: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Train rows that are in no list: among the rows of a crowded point, those behind
    ``k`` others, whatever id is left out."""
    out = np.zeros(len(X), bool)
    order, run = _runs(X)
    size = np.bincount(run)
    for r in np.flatnonzero(size > CROWD):
        a = np.searchsorted(run, r)
        at = order[a : a + size[r]]
        names, key = np.unique(ids[at], return_inverse=True)
        out[at[np.argsort(key, kind="stable")[k + np.bincount(key).max() :]]] = True
    return out


class Chunk:
    """Both sides of one group: the searches of its points, block by block."""

    def __init__(self, left: pa.Table, right: pa.Table, dim: int, k: int, exclude_self: bool, collapse: bool = True):
        x = [f"x{j}" for j in range(dim)]
        self.k, self.left, self.right = k, left, right
        self.Q, qids = matrix(left, x), values(left, "id")
        own = np.full(len(self.Q), -1)
        self.tree, self.need, times = None, k, 0
        if right.num_rows:
            T = matrix(right, x)
            names, tkey = np.unique(values(right, "id"), return_inverse=True)
            if exclude_self:
                at = np.minimum(np.searchsorted(names, qids), len(names) - 1)
                own = np.where(names[at] == qids, at, -1)
                times = int(np.bincount(tkey).max())
            collapse = collapse and times <= OWN_ROWS
            kept = np.arange(len(T))
            if collapse:
                self.need = k + times
                order, run = _runs(T, tkey)
                kept = order[_place(run) < self.need]
            self.tree, self.row, self.tkey = Leaves(T[kept], tkey[kept]), kept, tkey
        self.own, self.collapse = own, collapse
        # queries of one id and point are answered once, those of one point searched once
        code = np.unique(qids, return_inverse=True)[1]
        order, run = _runs(self.Q, code)
        first = np.ones(len(order), bool)
        first[1:] = (run[1:] != run[:-1]) | (code[order][1:] != code[order][:-1])
        self.query, run = order[first], run[first]
        self.point = run if collapse else np.arange(len(run))
        self.at = self.query[np.searchsorted(self.point, np.arange(self.point[-1] + 1))] if len(run) else self.query
        self.key = np.full(len(self.at), -1) if collapse else own[self.at]

    def blocks(self, points: np.ndarray):
        """The points in blocks that lie together, smaller where train is denser, so that
        the leaves of the first bound surround a block."""
        block = BLOCK if self.tree is None else min(BLOCK, max(BLOCK // 4, BLOCK * len(self.at) // len(self.row)))
        order = in_halves(self.Q[self.at[points]], block)
        for a in range(0, len(order), block):
            yield points[order[a : a + block]]

    def quick(self, points: np.ndarray, reached) -> np.ndarray:
        """Upper bounds of the points' k-th distances; one for all of a block's points if
        no ball of it is ``reached`` by other chunks."""
        if self.tree is None:
            return np.full(len(points), np.inf)
        if self.collapse:
            Q = self.Q[self.at[points]]
            box = np.stack([Q.min(axis=0), Q.max(axis=0)])
            most = self.tree.box_bound(*box, self.need)
            if not reached(box, most):
                return np.full(len(points), most)
        return self.tree.first_bound(self.Q[self.at[points]], self.key[points], self.need)

    def search(self, points: np.ndarray, bound: np.ndarray):
        """(point, train row, distance) by point and rank, and what bounds each point's lists."""
        if self.tree is None:
            return (np.zeros(0, int), np.zeros(0, int), np.zeros(0)), np.full(len(points), np.inf)
        q, row, dist = self.tree.search(self.Q[self.at[points]], self.key[points], self.need, bound)
        full = np.bincount(q, minlength=len(points)) >= self.need
        kth = np.full(len(points), np.inf)
        kth[full] = dist[(np.searchsorted(q, np.arange(len(points)), side="right") - 1)[full]]
        return (points[q], self.row[row], dist), kth

    def lists(self, found: list, points: np.ndarray | None = None):
        """Rows of the queries that ask for ``points`` (or all), and their lists: (place
        in those rows, rank from 0, train row, distance) by place and rank."""
        p, row, dist = (_glued(list(x), kind) for x, kind in zip(zip(*found), (int, int, float))) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        mine = np.ones(len(self.query), bool)
        if points is not None:
            wanted = np.zeros(len(self.at), bool)
            wanted[points] = True
            mine = wanted[self.point]
        query, point = self.query[mine], self.point[mine]
        order = np.argsort(p, kind="stable")
        p, row, dist = p[order], row[order], dist[order]
        size = np.bincount(p, minlength=len(self.at))
        start = np.cumsum(size) - size
        n = size[point]
        place = np.repeat(np.arange(len(query)), n)
        at = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[point], n)
        row, dist = row[at], dist[at]
        if self.collapse and len(row) and (self.own >= 0).any():
            other = self.tkey[row] != self.own[query][place]
            place, row, dist = place[other], row[other], dist[other]
        rank = _place(place)
        top = rank < self.k
        return query, (place[top], rank[top], row[top], dist[top])


def _take(table: pa.Table, column: str, at: np.ndarray) -> pa.Array:
    out = table.column(column).take(pa.array(at))
    return out.combine_chunks() if isinstance(out, pa.ChunkedArray) else out


def _glued(parts: list, kind) -> np.ndarray:
    return np.concatenate([np.asarray(x) for x in parts]) if parts else np.zeros(0, kind)


def _body(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


#: Packs hold rows that are train and query, train only, or query only.
BOTH, TRAIN, QUERY = 0, 1, 2


def _boxes(dim: int) -> list[str]:
    return [f"{e}{j}" for e in ("lo", "hi") for j in range(dim)]


def _packs(df: DataFrame, side: int, name: str, cols: list[str], shared, k: int, collapse: bool) -> DataFrame:
    """(_g, _part, kind, lo.., hi.., body): the rows, packed by the chunk they lie in."""
    d = len(cols)
    fields = [T.StructField(c, T.IntegerType()) for c in ("_g", "_part", "kind")] + [T.StructField(c, T.DoubleType()) for c in _boxes(d)]
    kind = T.StructType([*fields, T.StructField("body", T.BinaryType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(kind)

    def flush(batches):
        halves, parts = shared.value
        table = pa.Table.from_batches(batches)
        table = table.rename_columns([{name: "id", LABEL: LABEL, **{c: f"x{j}" for j, c in enumerate(cols)}}[c] for c in table.column_names])
        X = matrix(table, [f"x{j}" for j in range(d)])
        g = halves.chunk(X)
        order = np.argsort(g, kind="stable")
        table, X, g = table.take(pa.array(order)).combine_chunks(), X[order], g[order]
        train = np.full(len(g), side != QUERY)
        if side == BOTH:
            train &= table.column(LABEL).is_valid().to_numpy()
        if side != QUERY and collapse:
            train &= ~_spare(X, values(table, "id"), k)
        asked = table.select(["id", *[f"x{j}" for j in range(d)]])
        ends = np.flatnonzero(np.diff(g, append=-1)) + 1
        out, held = [], 0
        for a, b in zip(np.concatenate([[0], ends[:-1]]), ends):
            n = parts[g[a]]
            kept = a + np.flatnonzero(train[a:b])
            packs = []
            if len(kept):
                whole = table.slice(a, b - a) if len(kept) == b - a else table.take(pa.array(kept))
                box = [*X[kept].min(axis=0), *X[kept].max(axis=0)]
                body = _body(whole)
                packs += [[g[a], part, BOTH if side == BOTH and n == 1 else TRAIN, *box, body] for part in range(n)]
            if side != TRAIN:
                rest = np.arange(a, b) if n > 1 or side == QUERY else a + np.flatnonzero(~train[a:b])
                if len(rest):
                    # rows of one id go to one part
                    part = np.zeros(len(rest), int) if n == 1 else (hash_array(values(asked, "id")[rest]) % np.uint64(n)).astype(int)
                    packs += [[g[a], i, QUERY, *[None] * (2 * d), _body(asked.take(pa.array(rest[part == i])))] for i in np.unique(part)]
            for x in packs:
                out.append(x)
                held += len(x[-1])
                if held >= PACK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def run(batches):
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
                if n >= PACK_ROWS:
                    yield from flush(held)
                    held, n = [], 0
        if held:
            yield from flush(held)

    return df.mapInArrow(run, kind)


def _opened(packs: pa.Table, sides: tuple[int, ...], schema: pa.Schema) -> pa.Table:
    found = [unpacked(body) for kind, body in zip(packs.column("kind").to_pylist(), packs.column("body")) if kind in sides]
    return pa.concat_tables([t.select(schema.names).cast(schema) for t in found]).combine_chunks() if found else schema.empty_table()


def _around(train: pa.Table, Q: np.ndarray, bound: np.ndarray) -> pa.Table:
    """The train rows in the boxes that hold the queries' balls, block by block."""
    T = matrix(train, [f"x{j}" for j in range(Q.shape[1])])
    near, order = np.zeros(len(T), bool), in_halves(Q, LEAF)
    for a in range(0, len(Q), LEAF):
        at = order[a : a + LEAF]
        near |= gap(Q[at].min(axis=0), Q[at].max(axis=0), T, T) <= limit(bound[at].max())
    return train.take(pa.array(np.flatnonzero(near))).combine_chunks()


def _cut(df: DataFrame, rows: int) -> DataFrame | None:
    """(_g, _salts, _parts) of chunks where more than twice ``rows`` queries meet."""
    hot = [(r["_g"], 1, -(-r["n"] // rows)) for r in df.groupBy("_g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * rows).collect()]
    # one short row a chunk at most
    return F.broadcast(df.sparkSession.createDataFrame(hot, "_g int, _salts int, _parts int")) if hot else None


def _drawn(df: DataFrame, name: str, cols: list[str], n: int, size: int) -> pa.Table:
    """About ``size`` of ``n`` rows, by id and place, so that rows whose ids repeat are
    drawn one by one."""
    if n > size:
        df = df.where(F.pmod(F.xxhash64(name, *cols, F.lit(31)), F.lit(1 << 30)) < int(size / n * (1 << 30)))
    keep = [F.col(LABEL).isNotNull().alias(LABEL)] if LABEL in df.columns else []
    return df.select(*cols, *keep).limit(2 * size).toArrow()


def knn_chunks(p: Prepared, k: int, *, parallelism: int = 8, collapse: bool = True, sizes: Sizes | None = None) -> DataFrame:
    """Exact k nearest train rows of every query. Train rows are found with ids that
    repeat too; equal rows of queries are answered once. The searches run when the result
    is read: a caller that reads it twice keeps it."""
    from pyspark.sql.pandas.types import to_arrow_schema

    from .grid import _empty, _spread_over_cells

    spark = p.queries.sparkSession
    qc, tc, d, both = p.qcols, p.tcols, p.dim, p.both
    train, queries = p.train.select(TRAIN_ID, *tc, LABEL), p.queries.select(QUERY_ID, *qc)
    sizes = sizes or count_prepared(p)
    n_queries, n_train = sizes.n_queries, sizes.n_train
    if not (n_train and n_queries):
        return _empty(p)
    rows = min(CHUNK_ROWS, max(LEAST_ROWS, -(-n_train // (CHUNKS_PER_CORE * parallelism))))
    chunks = min(-(-n_train // rows), SAMPLE_MOST // SAMPLE_PER_CHUNK)
    size = max(SAMPLE, SAMPLE_PER_CHUNK * chunks)
    if both is not None:
        seen = _drawn(both, TRAIN_ID, tc, n_queries, size)
        asked, sample = matrix(seen, tc), matrix(seen.filter(seen.column(LABEL)), tc)
    else:
        sample, asked = matrix(_drawn(train, TRAIN_ID, tc, n_train, size), tc), matrix(_drawn(queries, QUERY_ID, qc, n_queries, size), qc)
    halves = Halves(sample, chunks)
    # chunks with many queries in the sample are cut
    expected = np.bincount(halves.chunk(asked), minlength=halves.parts) * (n_queries / max(1, len(asked)))
    shared = spark.sparkContext.broadcast((halves, np.where(expected > 2 * rows, -(-expected // rows), 1).astype(int)))
    if both is not None:
        packs = _packs(both, BOTH, TRAIN_ID, tc, shared, k, collapse)
    else:
        packs = _packs(train, TRAIN, TRAIN_ID, tc, shared, k, collapse).unionByName(_packs(queries, QUERY, QUERY_ID, qc, shared, k, collapse))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    release(spark)  # of what the sides were made
    packs = checkpoint(packs.repartition(width, "_g", "_part"))

    kind = neighbour_schema(p, with_rank=True)
    one = T.StructType([f for f in kind.fields if f.name not in (QUERY_ID, RANK)])
    asks_kind = T.StructType([*queries.schema.fields, T.StructField("bound", T.DoubleType()), T.StructField("needs", T.ArrayType(T.IntegerType())), T.StructField("found", T.ArrayType(one))])
    asks_schema, schema, few_schema = to_arrow_schema(asks_kind), to_arrow_schema(kind), to_arrow_schema(T.StructType([f for f in kind.fields if f.name != RANK]))
    point_names = [f"x{j}" for j in range(d)]
    point = [pa.field(x, pa.float64()) for x in point_names]
    left_schema = pa.schema([pa.field("id", schema.field(QUERY_ID).type), *point])
    right_schema = pa.schema([pa.field("id", schema.field(TRAIN_ID).type), *point, pa.field(LABEL, schema.field(LABEL).type)])
    exclude_self = p.exclude_self

    release(spark)  # the packs' shuffle
    boxes = packs.where(f"_part = 0 and kind <> {QUERY}").groupBy("_g").agg(*[(F.min if c[0] == "l" else F.max)(c).alias(c) for c in _boxes(d)]).orderBy("_g").toArrow()  # a row a chunk
    around = spark.sparkContext.broadcast((boxes.column("_g").to_numpy(), matrix(boxes, _boxes(d)[:d]), matrix(boxes, _boxes(d)[d:])))

    def opened(table: pa.Table) -> tuple[Chunk, int]:
        chunk = Chunk(_opened(table, (BOTH, QUERY), left_schema), _opened(table, (BOTH, TRAIN), right_schema), d, k, exclude_self, collapse)
        return chunk, table.column("_g")[0].as_py()

    def near_chunks(box: np.ndarray, bound: float, own: int) -> np.ndarray:
        """The other chunks whose boxes the bound reaches from the box."""
        number, blo, bhi = around.value
        return np.flatnonzero((gap(*box, blo, bhi) <= limit(bound)) & (number != own))

    def reached(Q: np.ndarray, bound: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, other chunk) where the ball of a bound meets the chunk's box."""
        number, blo, bhi = around.value
        near = near_chunks(np.stack([Q.min(axis=0), Q.max(axis=0)]), bound.max(), own)
        if not len(near):
            return np.zeros(0, int), np.zeros(0, int)
        ask, other = np.nonzero(gap(Q[:, None, :], Q[:, None, :], blo[near], bhi[near]) <= limit(bound)[:, None])
        return ask, number[near[other]]

    def named(cols: dict, schema: pa.Schema) -> pa.Table:
        return pa.Table.from_arrays([cols[f.name].cast(f.type) for f in schema], schema=schema)

    def border(table: pa.Table) -> pa.Table:
        chunk, own = opened(table)
        found, asks = [], []
        kth = np.full(len(chunk.at), np.inf)
        for at in chunk.blocks(np.arange(len(chunk.at))):
            bound = chunk.quick(at, lambda box, most: len(near_chunks(box, most, own)))
            doubtful = np.unique(reached(chunk.Q[chunk.at[at]], bound, own)[0])
            if not len(doubtful):
                continue
            at = at[doubtful]
            some, kth[at] = chunk.search(at, bound[doubtful])
            ask, other = reached(chunk.Q[chunk.at[at]], kth[at], own)
            found.append(some)
            asks.append((at[ask], other))
        ask, other = (_glued(list(x), int) for x in zip(*asks)) if asks else (np.zeros(0, int), np.zeros(0, int))
        if not len(ask):
            return asks_schema.empty_table()
        query, (place, _, row, dist) = chunk.lists(found, np.unique(ask))
        order = np.argsort(ask, kind="stable")
        ask, other = ask[order], other[order]
        point = np.zeros(len(chunk.Q), int)
        point[chunk.query] = chunk.point
        mine = point[query]
        start, end = np.searchsorted(ask, mine), np.searchsorted(ask, mine, side="right")
        n = end - start
        to = other[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)]
        many, lists = asks_schema.field("needs").type, asks_schema.field("found").type
        fields = [lists.value_type.field(i) for i in range(lists.value_type.num_fields)]
        cols = {DIST: pa.array(dist)} | ({TRAIN_ID: _take(chunk.right, "id", row), LABEL: _take(chunk.right, LABEL, row)} if chunk.right.num_rows else {})
        items = pa.StructArray.from_arrays([cols[f.name].cast(f.type) if f.name in cols else pa.nulls(0, f.type) for f in fields], fields=fields)
        out = {QUERY_ID: _take(chunk.left, "id", query), "bound": pa.array(kth[mine])} | {c: pa.array(chunk.Q[query, j]) for j, c in enumerate(qc)}
        out |= {"needs": _lists(len(query), np.repeat(np.arange(len(query)), n), pa.array(to.astype(np.int32)), many), "found": _lists(len(query), place, items, lists)}
        return pa.Table.from_arrays([out[f.name] if f.name in ("needs", "found") else out[f.name].cast(f.type) for f in asks_schema], schema=asks_schema)

    def home(table: pa.Table) -> pa.Table:
        chunk, own = opened(table)
        if chunk.tree is None or not len(chunk.at):
            return schema.empty_table()
        found, stay = [], np.ones(len(chunk.at), bool)
        for at in chunk.blocks(np.arange(len(chunk.at))):
            some, kth = chunk.search(at, np.full(len(at), np.inf))
            found.append(some)
            stay[at[np.unique(reached(chunk.Q[chunk.at[at]], kth, own)[0])]] = False
        query, (place, rank, row, dist) = chunk.lists(found, np.flatnonzero(stay))
        return named({QUERY_ID: _take(chunk.left, "id", query[place]), RANK: pa.array(rank + 1), TRAIN_ID: _take(chunk.right, "id", row), LABEL: _take(chunk.right, LABEL, row), DIST: pa.array(dist)}, schema)

    def abroad(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return few_schema.empty_table()
        asked = left.select([QUERY_ID, *qc]).rename_columns(["id", *point_names]).cast(left_schema)
        train = _opened(right, (BOTH, TRAIN), right_schema)
        if len(asked) <= len(train) // FEW:
            train = _around(train, matrix(asked, point_names), values(left, "bound"))
        if not len(train):
            return few_schema.empty_table()
        chunk = Chunk(asked, train, d, k, exclude_self, collapse)
        bound = np.zeros(len(chunk.at))
        np.maximum.at(bound, chunk.point, values(left, "bound")[chunk.query])
        found = [chunk.search(at, bound[at])[0] for at in chunk.blocks(np.arange(len(chunk.at)))]
        query, (place, _, row, dist) = chunk.lists(found)
        return named({QUERY_ID: _take(asked, "id", query[place]), TRAIN_ID: _take(chunk.right, "id", row), LABEL: _take(chunk.right, LABEL, row), DIST: pa.array(dist)}, few_schema)

    done = packs.groupBy("_g", "_part").applyInArrow(home, kind)
    if len(boxes) < 2 and halves.parts < 2:
        return done
    asks = checkpoint(packs.groupBy("_g", "_part").applyInArrow(border, asks_kind))
    if asks.isEmpty():
        return done
    to = asks.select(QUERY_ID, *qc, "bound", F.explode("needs").alias("_g"))
    hot = _cut(to, rows)
    held = packs.where(f"_part = 0 and kind <> {QUERY}").select("_g", "kind", "body")
    to, held = _spread_over_cells(to, hot, ["_g"], QUERY_ID, "_parts", "_salts"), _spread_over_cells(held, hot, ["_g"], "_g", "_salts", "_parts")
    there = to.groupBy("_g", "_salt").cogroup(held.groupBy("_g", "_salt")).applyInArrow(abroad, T.StructType([f for f in kind.fields if f.name != RANK]))
    here = asks.select(QUERY_ID, F.explode("found").alias("_n")).select(QUERY_ID, *[F.col(f"_n.{c}").alias(c) for c in (TRAIN_ID, LABEL, DIST)])
    return done.unionByName(rank_neighbours(here.unionByName(there), k))
