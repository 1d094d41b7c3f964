"""Embedding near-duplicates by an inverted multi-index.

Independent codebooks on the two halves of the vectors form a product grid of
cells. Each vector visits its nearest cells in multi-sequence order; how many
cells reach the target recall is measured against brute force, and where links
are too few for that all cells in reach are visited; the vectors of the visited
cells are verified by their exact cosine.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearframe.llm.common import connected_components, materialize, spread_join

#: Vectors aimed at per cell and label, and rows per side of one comparison.
PER_CELL, SIDE = 128, 2048


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = ((c**2).sum(1) - 2 * x @ c.T).argmin(1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def multi_sequence(d1: np.ndarray, d2: np.ndarray, visits: int) -> list[tuple[int, int]]:
    """The first ``visits`` cells (i, j) by growing ``d1[i] + d2[j]``."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1], d2[o2]
    heap, seen, out = [(s1[0] + s2[0], 0, 0)], {(0, 0)}, []
    while heap and len(out) < visits:
        _, i, j = heapq.heappop(heap)
        out.append((int(o1[i]), int(o2[j])))
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(s1) and b < len(s2) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (s1[a] + s2[b], a, b))
    return out


class Grid:
    """Two codebooks; vectors of another width all fall into cell 0."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books = (first, second)
        self.dim = first.shape[1] + second.shape[1]
        self.cells = len(first) * len(second)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.books[0].shape[1]
        return tuple((c**2).sum(1) - 2 * part @ c.T for c, part in zip(self.books, (x[:, :h], x[:, h:]), strict=True))

    def visits(self, x: np.ndarray, n: int) -> list[list[int]]:
        if x.shape[1] != self.dim:
            return [[0] for _ in x]
        d1, d2 = self.distances(x)
        width = len(self.books[1])
        return [[i * width + j for i, j in multi_sequence(a, b, n)] for a, b in zip(d1, d2, strict=True)]

    def place(self, d1: np.ndarray, d2: np.ndarray, cell: int) -> int:
        """Place of a cell in the order of growing ``d1[i] + d2[j]``; of cells
        as far as it, the last."""
        i, j = divmod(cell, len(d2))
        return int(np.searchsorted(np.sort(d2), d1[i] + d2[j] - d1 + 1e-12, side="right").sum()) - 1


def unit(rows: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _packed(distinct: DataFrame) -> DataFrame:
    """Vectors as bytes, for cheap transport."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = [np.array(v.as_py(), np.float64).tobytes() for v in b.column("emb")]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("label"), b.column("dim"), pa.array(vec, pa.binary()), b.column("n")], names=["node", "label", "dim", "vec", "n"])

    return distinct.select("node", "label", "dim", "emb", "n").mapInArrow(run, "node long, label string, dim int, vec binary, n long")


def build_grid(vectors: DataFrame, largest: int, count: int, max_rows: int = 20_000) -> Grid | None:
    """Codebooks of a sample of at most about ``max_rows`` vectors (a documented
    bound); the number of cells grows with the vectors of the largest label."""
    if not count:
        return None
    dim = vectors.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()["dim"]
    sample = vectors.where(F.col("dim") == dim)
    if count > max_rows:
        sample = sample.where(F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) < int(max_rows / count * (1 << 30)))
    rows = sorted(r["vec"] for r in sample.select("vec").collect())
    if not rows:
        return None
    x, k = unit([bytes(r) for r in rows]), int(np.clip(round((largest / PER_CELL) ** 0.5), 2, 1024))
    h = max(dim // 2, 1) if dim > 1 else 1
    return Grid(kmeans(x[:, :h], k), kmeans(x[:, h:], k) if dim > 1 else np.zeros((1, 0)))


def visits_for_recall(vectors: DataFrame, grid: Grid, cosine: float, recall: float, count: int, queries: int = 400, links: int = 1000, linked: int = 100, most: int = 6400) -> tuple[int, float] | None:
    """Cells to visit so that ``recall`` of the true links of a set of query
    vectors is met, and the recall measured there. The queries are compared
    with all vectors by brute force, and the links are counted by the place of
    their cell in the query's order. The set grows fourfold until it has seen
    ``links`` true links at ``linked`` queries or holds every vector. None where
    ``most`` queries see too few links: then made neighbours tell."""
    pool = vectors.where(F.col("dim") == grid.dim)
    while True:
        pick = pool
        if count > queries:
            pick = pick.where(F.pmod(F.xxhash64("node", "vec"), F.lit(1 << 30)) < int(queries / count * (1 << 30)))
        rows = pick.select("node", "label", "vec").orderBy("node").collect()
        seen = _places(pool, grid, cosine, rows) if rows else None
        if count <= queries:
            break  # every vector was asked
        if seen is not None and seen["n"].sum() >= links and int(seen["queries"].sum()) >= linked:
            break
        if queries >= most:
            return None
        queries = min(4 * queries, most)
    if seen is None or not seen["n"].sum():
        return 1, 1.0
    seen = seen[seen["place"] >= 0].sort_values("place")
    share = seen["n"].cumsum() / seen["n"].sum()
    at = int((share >= recall).to_numpy().argmax())
    # one cell more than measured, for the queries that were not asked
    return min(int(seen["place"].iloc[at]) + 2, grid.cells), float(share.iloc[at])


def visits_for_made_neighbours(vectors: DataFrame, grid: Grid, cosine: float, recall: float, count: int, queries: int = 4000, each: int = 5, seed: int = 23) -> tuple[int, float]:
    """The same reading where true links are rare: a bounded set of vectors gets
    neighbours in random directions at exactly ``cosine``, the farthest a link can
    be, and the cells they fall in are counted by their place. Both ends of a link
    look for the other, so fewer links than vectors' visits are missed."""
    pick = vectors.where(F.col("dim") == grid.dim)
    if count > queries:
        pick = pick.where(F.pmod(F.xxhash64("node", "vec"), F.lit(1 << 30)) < int(queries / count * (1 << 30)))
    rows = [bytes(r["vec"]) for r in pick.select("node", "vec").orderBy("node").collect()]
    if not rows or grid.cells == 1:
        return 1, 1.0
    x = np.repeat(unit(rows), each, axis=0)
    rng = np.random.default_rng(seed)
    away = rng.standard_normal(x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    near = [d.argmin(axis=1) for d in grid.distances(cosine * x + (1.0 - cosine * cosine) ** 0.5 * away)]
    cells = near[0] * len(grid.books[1]) + near[1]
    d1, d2 = grid.distances(x)
    places = np.sort([grid.place(a, b, k) for a, b, k in zip(d1, d2, cells.tolist(), strict=True)])
    at = min(math.ceil(recall * len(places)), len(places)) - 1
    return min(int(places[at]) + 1, grid.cells), float((places <= places[at]).mean())


def _places(pool: DataFrame, grid: Grid, cosine: float, rows: list):
    """``place, n, queries``: true links of the queries ``rows`` by the place of
    their cell; place -1 has the number of queries with a link."""
    q = unit([bytes(r["vec"]) for r in rows])
    shared = pool.sparkSession.sparkContext.broadcast((q, np.array([r["node"] for r in rows]), np.array([r["label"] for r in rows]), grid))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, nodes, labels, grid = shared.value
        d1, d2 = grid.distances(q)
        total: dict[tuple[int, int], int] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = unit(b.column("vec").to_pylist())
            near = [d.argmin(axis=1) for d in grid.distances(x)]
            cell = near[0] * len(grid.books[1]) + near[1]
            mine, label = b.column("node").to_numpy(), np.array(b.column("label").to_pylist())
            for s in range(0, len(q), 512):
                e = s + 512
                i, j = np.nonzero((q[s:e] @ x.T >= cosine) & (labels[s:e, None] == label[None]) & (nodes[s:e, None] != mine[None]))
                for c, n in zip(*(v.tolist() for v in np.unique((s + i) * grid.cells + cell[j], return_counts=True)), strict=True):
                    total[c] = total.get(c, 0) + n
        codes = np.array(list(total), np.int64)
        asked = codes // max(grid.cells, 1)
        place = [grid.place(d1[i], d2[i], c) for i, c in zip(asked.tolist(), (codes % grid.cells).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(asked), pa.array(place, pa.int64()), pa.array(list(total.values()), pa.int64())], names=["query", "place", "n"])

    found = pool.select("node", "label", "vec").mapInArrow(run, "query long, place long, n long").groupBy("query", "place").agg(F.sum("n").alias("n"))
    found = materialize(found, "embed-places")
    places = found.groupBy("place").agg(F.sum("n").alias("n"), F.lit(0).cast("long").alias("queries"))
    return places.unionByName(found.agg(F.lit(-1).cast("long").alias("place"), F.lit(0).cast("long").alias("n"), F.countDistinct("query").alias("queries"))).toPandas()


def _assign(vectors: DataFrame, grid: Grid, visits: int) -> DataFrame:
    """The ``visits`` nearest cells of each vector, its own first."""
    shared = vectors.sparkSession.sparkContext.broadcast(grid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            cells: list = [None] * b.num_rows
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                x = unit([b.column("vec")[int(i)].as_py() for i in rows])
                for r, v in zip(rows, shared.value.visits(x, visits), strict=True):
                    cells[r] = v
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*b.schema.names, "visits"])

    return vectors.mapInArrow(run, "node long, label string, dim int, vec binary, n long, visits array<int>")


def _verify(cosine: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b, n = [], [], []
        if left.num_rows and right.num_rows:
            x, y = unit(left.column("vec").to_pylist()), unit(right.column("vec").to_pylist())
            xn, yn = left.column("node").to_numpy(), right.column("node").to_numpy()
            xc, yc = left.column("n").to_numpy(), right.column("n").to_numpy()
            home = np.array([v[0] for v in left.column("visits").to_pylist()])
            seen = [set(v) for v in right.column("visits").to_pylist()]
            i, j = np.nonzero(x @ y.T >= cosine)
            other = xn[i] != yn[j]
            i, j = i[other], j[other]
            # y counts the link itself if it visits x's cell
            back = np.array([h not in seen[k] for h, k in zip(home[i], j, strict=True)], bool)
            cx = np.bincount(i, weights=yc[j], minlength=len(xn)).astype(np.int64)
            cy = np.bincount(j[back], weights=xc[i[back]], minlength=len(yn)).astype(np.int64)
            # a spanning forest of the links of this block
            nodes, at = np.unique(np.concatenate([xn, yn]), return_inverse=True)
            label = np.arange(len(nodes))
            p, q = at[: len(xn)][i], at[len(xn) :][j]
            while len(p):
                u, v = label[p], label[q]
                apart = u != v
                if not apart.any():
                    break
                p, q = p[apart], q[apart]
                np.minimum.at(label, np.maximum(u, v)[apart], np.minimum(u, v)[apart])
                while not np.array_equal(up := label[label], label):
                    label = up
            moved = np.flatnonzero(label != np.arange(len(nodes)))
            a = np.concatenate([xn[cx > 0], yn[cy > 0], nodes[moved]])
            b = pa.array(np.concatenate([np.full((cx > 0).sum() + (cy > 0).sum(), -1), nodes[label[moved]]]))
            n = np.concatenate([cx[cx > 0], cy[cy > 0], np.zeros(len(moved), np.int64)])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def _compare(assigned: DataFrame, cosine: float, count: int, visits: int) -> DataFrame:
    """Counts (b = -1) and spanning links of all visited cells. The members and
    the visitors of a cell are cut into sides of about ``SIDE`` rows; every pair
    of sides is one group, so a hot cell spreads over many tasks."""
    names = assigned.columns
    members = assigned.select(*names, F.col("visits")[0].alias("cell"))
    # a visitor needs its own cell only
    visitors = assigned.select(*names[:-1], F.slice("visits", 1, 1).alias("visits"), F.explode("visits").alias("cell"))
    cell = ["label", "dim", "cell"]
    m, v = members.groupBy(cell).agg(F.count("*").alias("n")), visitors.groupBy(cell).agg(F.count("*").alias("n"))

    def cut(name: str) -> F.Column:
        return F.ceil(F.col("n") / SIDE).cast("int").alias(name)

    sides = m.select(*cell, cut("ms")).join(v.select(*cell, cut("vs")), cell)

    def own(n: str) -> F.Column:
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    def each(n: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = spread_join(visitors, sides, cell, v, count * visits).withColumn("v", own("vs")).withColumn("m", each("ms")).drop("ms", "vs")
    right = spread_join(members, sides, cell, m, count).withColumn("m", own("ms")).withColumn("v", each("vs")).drop("ms", "vs")
    keys = [*cell, "m", "v"]
    # two projections of one frame: give the right side columns of its own
    right = right.select(*[F.col(c).alias(c) for c in left.columns])
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_verify(cosine), "a long, b long, n long")


def embedding_links(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = 0.93, recall: float = 0.999, made_recall: float = 0.9999) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per input row.

    Rows link if their labels are equal and their cosine (in double) is at
    least ``cosine``. Pairs are searched through the grid with the number of
    visits that reaches ``recall`` on a measured query set, or, where that set has
    too few links, ``made_recall`` on made neighbours; every pair found is
    verified, and no pair below the threshold is counted.

    Defined results: a null label, a null or zero vector, and one with a null
    or non-finite component link with nothing (own component, kept); vectors of
    different width never link; equal vectors of a label are found once,
    compared once and count as links of one another; a null id is no minimum of
    a component and is kept only where no other id is; an empty table gives an
    empty result; other columns are ignored.
    """
    e = F.col("emb")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("emb"), F.col(label).cast("string").alias("label"))
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x * x)
    valid = F.coalesce(e.isNotNull() & finite & F.col("label").isNotNull() & (square > 0) & (square < float("inf")), F.lit(False))
    rows = rows.withColumn("valid", valid)
    good = rows.where("valid").drop("valid")
    distinct = good.groupBy("label", "emb").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    distinct = materialize(distinct.select(F.monotonically_increasing_id().alias("node"), "label", F.size("emb").alias("dim"), "emb", "rep", "n"), "embed")
    sizes = distinct.groupBy("label").agg(F.count("*").alias("n"))
    count, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    packed = _packed(distinct)
    grid = build_grid(packed, largest, count)
    alone = rows.where("NOT valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if grid is None:
        out = alone
    else:
        measured = visits_for_recall(packed, grid, cosine, recall, count) or visits_for_made_neighbours(packed, grid, cosine, made_recall, count)
        visits = measured[0]
        assigned = _assign(packed, grid, visits)
        found = materialize(_compare(assigned, cosine, count, visits), "embed-links")
        counts = found.where("b = -1").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
        parts = connected_components(found.where("b <> -1").select("a", "b"))
        named = distinct.join(counts, "node", "left").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = named.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("n"))
        links = (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links")
        classes = spread_join(named.select("component", "label", "emb", links), least.drop("n"), ["component"], least, count)
        # equal vectors may be a third of all rows
        rows_in = distinct.agg(F.sum("n")).first()[0]
        out = spread_join(good, classes.drop("component"), ["label", "emb"], distinct.select("label", "emb", "n"), rows_in).select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
