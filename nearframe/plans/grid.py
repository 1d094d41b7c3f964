"""Exact kNN by uniform grid cells, for low-dimensional features.

Brute force scores ``Q x N`` pairs; here each query only meets the train rows
of the cells its k-neighbour ball touches, so the work grows with the local
density instead of with ``N``. Every step is a DataFrame join, window or
aggregate, and train is shuffled once. The grid serves stored indexes and searches
within known bounds; a plain search goes by ``chunks``:

1. **Cells.** One aggregate over train: row count and quantiles per axis.
   Cells are equal steps of the axis' quantile position, about
   ``TARGET_PER_CELL * kk`` rows each (``kk = k``, plus one when a query's own
   row is excluded), so neither an outlier nor a dense spot decides their
   width. Any cut is correct; it only moves work between the phases.
2. **Train, once.** Train rows get their cell; rows of hot cells (more than
   ``HOT_ROWS``; that small table is kept and counted, and broadcast only
   when the count fits the limit) get a salt from a hash of train_id. Train is
   hash-partitioned by (cell, salt) a single time and kept; both phases
   below join on exactly those keys, so neither shuffles train again.
3. **Bound (phase 1).** Each query meets a bounded sample of train:
   ``row_number <= m`` per (cell, salt) of its own fine cell (a window on
   the existing partitioning, no exchange), and ``<= m1`` per cell of its
   own coarse cell (width x COARSE_FACTOR; the partial window limit before
   that shuffle keeps it small, and the sample is broadcast when its proven
   bound, cells in the box x m1, fits). The k best distances per query are
   cut in the join's own task, so k rows per query are shuffled, and one
   hash aggregate gives the k-th. The k-th distance over any subset is an
   exact upper bound on the true k-th distance, so ``bound`` = the fine one
   when the fine cell had k rows, else the coarse one.
4. **Candidates (phase 2).** Cells intersecting the ball of radius
   ``bound`` (widened by a rounding allowance, clamped to the occupied range) are enumerated with
   ``sequence``/``explode``, replicated per salt of hot cells, joined to the
   kept train on (cell, salt), filtered by the bound and ranked by
   ``(dist, train_id)`` with a partial limit before the last exchange.
5. **Leftovers.** Queries without a finite bound or whose ball touches more
   than ``MAX_CELLS`` cells are counted; they are answered by the vectorized
   pass when that set passes the broadcast size check, else by tiles.

The neighbours are written once with ``checkpoint`` (reliable, in the
session's ``spark.checkpoint.dir``) before the kept train is released, so
the returned frame survives executor loss without recomputing the search.

Equal points. Cells with more than ``BUSY_ROWS`` rows of either side are counted
in one aggregate. In them, exact duplicates of a train point are collapsed to the kk
lowest train ids (no later copy can ever rank), by a window with a partial limit, so
a hot point sends at most kk rows per task into the shuffle; and a point with many
queries is answered once and its list fanned out. What is left of a hot cell is cut:
its train rows into salts of ``HOT_ROWS``, its queries into parts of ``HOT_QUERIES``,
and each salt meets each part in a task of its own.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint
from . import brute, choose
from .prepare import DIST, LABEL, QUERY_ID, RANK, TRAIN_ID, Prepared

log = logging.getLogger(__name__)

TARGET_PER_CELL = 4
SAMPLE_PER_CELL_FACTOR = 2
COARSE_FACTOR = 4
COARSE_SAMPLE_FACTOR = 2
HOT_ROWS = 20_000
#: Queries of one cell that meet in one task, about.
HOT_QUERIES = 10_000
#: Cells with more rows (of either side) are searched for equal points.
BUSY_ROWS = 1_000
MAX_CELLS = 729


def _names(prefix: str, d: int) -> list[str]:
    return [f"{prefix}{j}" for j in range(d)]


def _cell(x: str, knots: list[tuple[float, float, float]], m: int) -> str:
    """Cell index (SQL) of the expression ``x`` on one axis of ``m`` cells.

    ``knots`` are segments (low, high, weight) between quantiles; the position
    of x is the sum of the weights below its segment plus a linear step inside
    it, so cells are narrow where rows are dense and one outlier only stretches
    the last, light segment. The segment is found by nested comparisons, so a
    row evaluates a handful of them and one step, and the code stays small enough
    to be compiled. Every step is held between its segment's ends, so the
    position is monotone in floating point: the cells between those of two ends
    hold all rows between them.
    """
    if m == 1 or not knots:
        return "0L"
    starts = [0.0]
    for _, _, w in knots:
        starts.append(starts[-1] + w * m)

    def leaf(i: int) -> str:
        low, high, _ = knots[i]
        a, b = starts[i], starts[i + 1]
        if i + 1 == len(knots):
            b = float(m)
        slope = (b - a) / (high - low)
        if not math.isfinite(slope):  # a segment of a few denormal steps is one cell
            return f"{a!r}D"
        return f"least(greatest({a!r}D + ({x} - {low!r}D) * {slope!r}D, {a!r}D), {b!r}D)"

    def tree(i: int, j: int) -> str:
        if i + 1 == j:
            return leaf(i)
        mid = (i + j) // 2
        return f"if({x} < {knots[mid][0]!r}D, {tree(i, mid)}, {tree(mid, j)})"

    return f"cast(least(floor({tree(0, len(knots))}), {m - 1}L) as bigint)"


def _cells(cols: list[str], knots: list, m: list[int], prefix: str) -> list[Column]:
    return [F.expr(_cell(c, kn, mj)).alias(f"{prefix}{j}") for j, (c, kn, mj) in enumerate(zip(cols, knots, m))]


def _dedupe(train: DataFrame, tcols: list[str], kk: int) -> DataFrame:
    """Keep the kk lowest train ids of every distinct point; exact, since a
    later copy of a point is tied in distance with kk earlier ones and the
    lower ids rank first."""
    w = Window.partitionBy(*tcols).orderBy(F.col(TRAIN_ID).asc())
    return train.withColumn("_dup", F.row_number().over(w)).where(F.col("_dup") <= kk).drop("_dup")


def _split(df: DataFrame, busy: DataFrame, cnames: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows outside and inside the busy cells."""
    marked = df.join(busy.select(*cnames, F.lit(True).alias("_busy")), cnames, "left")
    return marked.where("_busy is null").drop("_busy"), marked.where("_busy").drop("_busy")


#: Quantiles between which cells are spread evenly; the tails are cut finer, so
#: that far outliers share a segment with few rows.
_STEPS = 8
_TAIL = [1e-4, 1e-2]
QUANTILES = [0.0, *_TAIL, *[i / _STEPS for i in range(1, _STEPS)], *[1 - t for t in reversed(_TAIL)], 1.0]
#: Relative rounding allowance of the ball's ends, far above a few ulps.
SLACK = 1e-12


def _segments(q: list[float]) -> list[tuple[float, float, float]]:
    """(low, high, weight) between neighbouring quantiles of one axis; equal
    neighbours (a value with many rows) leave no segment."""
    parts = [(a, b, qb - qa) for a, b, qa, qb in zip(q, q[1:], QUANTILES, QUANTILES[1:]) if b > a and math.isfinite(b - a)]
    total = sum(w for _, _, w in parts)
    return [(a, b, w / total) for a, b, w in parts]


def plan_width(p: Prepared, kk: int) -> dict:
    """One pass over train: row count and quantiles per axis.

    The width solves ``prod_j max(1, R_j / w) = N / (TARGET_PER_CELL * kk)``
    with ``R_j`` the range between the 1 % and 99 % quantiles, and gives the
    number of cells of each axis.
    """
    d = p.dim
    tc = p.tcols
    box = p.train.agg(
        F.count(F.lit(1)).alias("n"), *[F.percentile_approx(c, QUANTILES, 100_000).alias(f"q{j}") for j, c in enumerate(tc)]
    ).first()
    n = int(box["n"])
    if n == 0:
        return {"n": 0, "knots": [[] for _ in range(d)], "cells": [1] * d}
    qs = [[float(x) for x in box[f"q{j}"]] for j in range(d)]
    one, last = QUANTILES.index(1e-2), QUANTILES.index(1 - 1e-2)
    ranges = [max(q[last] - q[one], 0.0) or max(q[-1] - q[0], 0.0) for q in qs]
    n_cells = max(1.0, n / (TARGET_PER_CELL * kk))
    w = max(ranges) if max(ranges) > 0 else 1.0
    for _ in range(400):
        cells = 1.0
        for r in ranges:
            cells *= max(1.0, r / w)
        if cells >= n_cells:
            break
        w /= 1.1
    return {"n": n, "knots": [_segments(q) for q in qs], "cells": [max(1, int(math.ceil(min(r / w, 2.0**40)))) for r in ranges]}


def _cell_counts(tcell: DataFrame, qcell: DataFrame, cnames: list[str]) -> DataFrame:
    """(cells..., _n, _m): train rows and queries of every busy cell."""
    both = tcell.select(*cnames, F.lit(1).alias("_t"), F.lit(0).alias("_q")).unionByName(qcell.select(*cnames, F.lit(0).alias("_t"), F.lit(1).alias("_q")))
    counts = both.groupBy(*cnames).agg(F.sum("_t").alias("_n"), F.sum("_q").alias("_m"))
    return counts.where(F.greatest("_n", "_m") > BUSY_ROWS)


def _hot_cells(busy: DataFrame, cnames: list[str]) -> DataFrame:
    """(cells..., _salts, _parts) for cells with more than ``HOT_ROWS`` train rows
    or ``HOT_QUERIES`` queries: train rows are cut into salts and copied once per
    part, queries are cut into parts and copied once per salt."""
    cut = lambda c, most: F.ceil(F.greatest(F.col(c), F.lit(1)) / F.lit(most)).cast("int")
    return busy.where((F.col("_n") > HOT_ROWS) | (F.col("_m") > HOT_QUERIES)).select(*cnames, cut("_n", HOT_ROWS).alias("_salts"), cut("_m", HOT_QUERIES).alias("_parts"))


def _spread_over_cells(df: DataFrame, hot: DataFrame | None, cnames: list[str], key: str, own: str, other: str) -> DataFrame:
    """``_salt`` for rows that are cut by ``own`` (a hash of ``key``) and copied
    once per ``other``; cells that are not hot have the one salt 0. ``hot``
    arrives already marked for broadcast when its count allowed it."""
    if hot is None:
        return df.withColumn("_salt", F.lit(0))
    t = df.join(hot, cnames, "left")
    mine = F.coalesce(F.pmod(F.xxhash64(key), F.col(own)), F.lit(0))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
    t = t.withColumn("_mine", mine).withColumn("_copy", copies)
    salt, part = ("_mine", "_copy") if own == "_salts" else ("_copy", "_mine")
    number = F.col(salt) * F.coalesce(F.col("_parts"), F.lit(1)) + F.col(part)
    return t.withColumn("_salt", number.cast("int")).drop("_mine", "_copy", "_salts", "_parts")


def _sample(df: DataFrame, keys: list[str], m: int) -> DataFrame:
    """At most ``m`` rows per key, chosen by a hash of train_id (stable)."""
    w = Window.partitionBy(*keys).orderBy(brute.unit_hash(TRAIN_ID), F.col(TRAIN_ID))
    return df.withColumn("_s", F.row_number().over(w)).where(F.col("_s") <= m).drop("_s")


def _empty(p: Prepared) -> DataFrame:
    sch = T.StructType(
        [
            T.StructField(QUERY_ID, p.queries.schema[QUERY_ID].dataType),
            T.StructField(RANK, T.LongType()),
            T.StructField(TRAIN_ID, p.train.schema[TRAIN_ID].dataType),
            T.StructField(LABEL, p.train.schema[LABEL].dataType),
            T.StructField(DIST, T.DoubleType()),
        ]
    )
    return p.queries.sparkSession.createDataFrame([], sch)


@dataclass
class Grid:
    """Train, cut into cells and kept for both phases of the search.

    ``part`` has ``train_id, t.., label, _c.., _salt`` and is partitioned by (cell,
    salt); ``coarse`` is a bounded sample of each coarse cell; ``hot`` the hot
    cells (or None). ``train`` are the rows without equal points beyond the lowest
    ``kk``."""

    dim: int
    kk: int
    n_train: int
    knots: list
    cells: list[int]
    part: DataFrame
    coarse: DataFrame
    hot: DataFrame | None
    train: DataFrame

    @property
    def coarse_cells(self) -> list[int]:
        return [-(-x // COARSE_FACTOR) for x in self.cells]


def _coarse_sample(train: DataFrame, tc: list[str], knots: list, cells: list[int], kk: int) -> DataFrame:
    kn = _names("_k", len(tc))
    mc = [-(-x // COARSE_FACTOR) for x in cells]
    return _sample(train.select(TRAIN_ID, *tc, *_cells(tc, knots, mc, "_k")), kn, COARSE_SAMPLE_FACTOR * kk)


def knn_grid(
    p: Prepared,
    k: int,
    *,
    broadcast_max_bytes: int,
    parallelism: int = 8,
    dedupe: bool = True,
    collapse: bool = True,
    bounds: DataFrame | None = None,
    sizes: choose.Sizes | None = None,
) -> DataFrame:
    if bounds is None:
        from .chunks import knn_chunks

        return knn_chunks(p, k, parallelism=parallelism, collapse=dedupe, sizes=sizes)
    spark = p.queries.sparkSession
    kk = k + (1 if p.exclude_self else 0)
    plan = plan_width(p, kk)
    log.info("grid plan %s", plan)
    n_train = plan["n"]
    if n_train == 0:
        return _empty(p)
    d, tc, qc = p.dim, p.tcols, p.qcols
    knots, m = plan["knots"], plan["cells"]
    cn = _names("_c", d)
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    train, queries = p.train.select(TRAIN_ID, *tc, LABEL), p.queries.select(QUERY_ID, *qc)

    # 1b. busy cells: a small deterministic aggregate, kept and counted once;
    # broadcast only when the count fits the limit, else a shuffle join
    def small(table: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(table) if rows * choose.row_bytes(d + 2) <= broadcast_max_bytes else table

    tcell, qcell = train.select("*", *_cells(tc, knots, m, "_c")), queries.select("*", *_cells(qc, knots, m, "_c"))
    kept = [_cell_counts(tcell, qcell, cn).persist(StorageLevel.MEMORY_AND_DISK)]
    busy_cells = kept[0]
    sizes = busy_cells.agg(F.count(F.lit(1)).alias("n"), F.max("_n").alias("t"), F.max("_m").alias("q")).first()
    points, n_points, members = None, 0, None
    if sizes["n"] and dedupe:
        busy = small(busy_cells, sizes["n"])
        quiet, crowd = _split(tcell, busy, cn)
        tcell = quiet.unionByName(_dedupe(crowd, tc, kk))
        train = tcell.drop(*cn)
        if collapse and sizes["q"] > BUSY_ROWS:
            points = _equal_queries(_split(qcell, busy, cn)[1], qc)
            kept.append(points)
            n_points = points.count()
        if n_points:
            # queries on such a point are answered once, as one query
            members = queries.join(small(points, n_points), qc).select(QUERY_ID, "_point")
            queries = queries.join(small(points.select(*qc), n_points), qc, "left_anti")
            qcell = queries.select("*", *_cells(qc, knots, m, "_c"))

    # 2. train, partitioned once by (cell, salt) and kept
    hot = None
    if sizes["n"] and (sizes["t"] > HOT_ROWS or sizes["q"] > HOT_QUERIES):
        # counted again: equal rows are gone
        kept.append(_hot_cells(_cell_counts(tcell, qcell, cn), cn).persist(StorageLevel.MEMORY_AND_DISK))
        hot = small(kept[-1], kept[-1].count())
    tpart = _spread_over_cells(tcell, hot, cn, TRAIN_ID, "_salts", "_parts").repartition(n_parts, *cn, "_salt")
    tpart = tpart.persist(StorageLevel.MEMORY_AND_DISK)
    kept.append(tpart)
    grid = Grid(d, kk, n_train, knots, m, tpart, _coarse_sample(train, tc, knots, m, kk), hot, train)
    out = search_grid(grid, Prepared(queries, train, d, p.exclude_self), k, broadcast_max_bytes=broadcast_max_bytes, parallelism=parallelism, bounds=bounds)
    if members is not None:
        out = out.unionByName(_answer_points(p, points, members, train, k, n_points, n_train, broadcast_max_bytes, parallelism))
    out = checkpoint(out)
    for table in kept:
        table.unpersist()
    return out


def _bounds(grid: Grid, p: Prepared, k: int, broadcast_max_bytes: int) -> DataFrame:
    """(query_id, q.., bound) from the fine-cell and coarse-cell samples."""
    d, tc, qc = p.dim, p.tcols, p.qcols
    knots, m, mc, kk, tpart, hot = grid.knots, grid.cells, grid.coarse_cells, grid.kk, grid.part, grid.hot
    cn, kn = _names("_c", d), _names("_k", d)
    queries, n_train = p.queries, grid.n_train
    qcell = queries.select(QUERY_ID, *qc, *_cells(qc, knots, m, "_c"))
    fine = _sample(tpart, cn + ["_salt"], SAMPLE_PER_CELL_FACTOR * kk).select(TRAIN_ID, *tc, *cn, "_salt")
    qfine = _spread_over_cells(qcell, hot, cn, QUERY_ID, "_parts", "_salts")
    coarse = grid.coarse
    coarse_rows = COARSE_SAMPLE_FACTOR * kk * math.prod(mc)
    if choose.row_bytes(2 * d + 2) * min(coarse_rows, n_train) <= broadcast_max_bytes:
        coarse = F.broadcast(coarse)  # proven bound: cells in the box x m1
    qcoarse = queries.select(QUERY_ID, *qc, *_cells(qc, knots, mc, "_k"))

    def kth(pairs: DataFrame, tag: str) -> DataFrame:
        """k best distances per query: the partial window limit runs in the
        join's task, so only k rows per query reach the exchange."""
        if p.exclude_self:
            pairs = pairs.where(F.col(QUERY_ID) != F.col(TRAIN_ID))
        pairs = pairs.select(QUERY_ID, TRAIN_ID, F.lit(None).alias(LABEL), p.dist().alias(DIST))
        return brute.rank_neighbours(pairs, k).select(QUERY_ID, DIST, F.lit(tag).alias("_tag"))

    nul = F.lit(None).cast("double")
    own = queries.select(QUERY_ID, *qc, nul.alias(DIST), F.lit("q").alias("_tag"))
    tops = kth(qfine.join(fine, cn + ["_salt"]), "f").unionByName(kth(qcoarse.join(coarse, kn), "c"))
    tops = tops.select(QUERY_ID, *[nul.alias(c) for c in qc], DIST, "_tag")

    def nth(tag: str):
        hit = F.col("_tag") == F.lit(tag)
        return F.count(F.when(hit, 1)), F.max(F.when(hit, F.col(DIST)))

    (nf_, kf), (nc_, kc) = nth("f"), nth("c")
    agg = own.unionByName(tops).groupBy(QUERY_ID).agg(
        *[F.max(c).alias(c) for c in qc], nf_.alias("_nf"), kf.alias("_kf"), nc_.alias("_nc"), kc.alias("_kc")
    )
    bound = (
        F.when(F.col("_nf") >= k, F.col("_kf"))
        .when(F.col("_nc") >= k, F.col("_kc"))
        .otherwise(F.lit(float("inf")))
    )
    return agg.select(QUERY_ID, *qc, bound.alias("bound"))


def search_grid(grid: Grid, p: Prepared, k: int, *, broadcast_max_bytes: int, parallelism: int = 8, bounds: DataFrame | None = None) -> DataFrame:
    """The k nearest rows of a prepared train side for ``p.queries``.

    With ``bounds`` (query_id, bound) phase 1 is left out and only rows within each
    query's bound are returned."""
    d, qc = p.dim, p.qcols
    knots, m, tpart, hot = grid.knots, grid.cells, grid.part, grid.hot
    cn = _names("_c", d)
    queries, train, n_train = p.queries, grid.train, grid.n_train
    # 3. phase 1
    qb = _bounds(grid, p, k, broadcast_max_bytes) if bounds is None else queries.join(bounds, QUERY_ID).select(QUERY_ID, *qc, "bound")
    finite = brute.is_finite("bound")
    ends, ranges = [], []
    for j, (c, kn_j, m_j) in enumerate(zip(qc, knots, m)):
        # q - t is rounded before it is compared with the bound, so the exact
        # ends could miss the k-th neighbour's cell: widen them by far more
        slack = (F.abs(F.col(c)) + F.col("bound")) * F.lit(SLACK)
        ends += [(F.col(c) - F.col("bound") - slack).alias(f"_a{j}"), (F.col(c) + F.col("bound") + slack).alias(f"_b{j}")]
        ranges += [F.when(finite, F.expr(_cell(f"_{e}{j}", kn_j, m_j))).alias(f"_{n}{j}") for e, n in (("a", "lo"), ("b", "hi"))]
    qb = qb.select(QUERY_ID, *qc, "bound", *ends).select(QUERY_ID, *qc, "bound", *ranges)
    ncell = F.lit(1).cast("long")
    for j in range(d):
        ncell = ncell * (F.col(f"_hi{j}") - F.col(f"_lo{j}") + 1)
    qb = qb.withColumn("_ok", F.coalesce(F.when(finite, ncell) <= F.lit(MAX_CELLS), F.lit(False)))
    qb = checkpoint(qb)

    # 4. phase 2: enumerate the cells of each ball, join the kept train
    qe = qb.where(F.col("_ok"))
    for j in range(d):
        qe = qe.withColumn(f"_c{j}", F.explode(F.sequence(F.col(f"_lo{j}"), F.col(f"_hi{j}"))))
    qe = _spread_over_cells(qe.select(QUERY_ID, *qc, "bound", *cn), hot, cn, QUERY_ID, "_parts", "_salts")
    cond = brute.within_bound(p)
    if p.exclude_self:
        cond = cond & (F.col(QUERY_ID) != F.col(TRAIN_ID))
    pairs = qe.join(tpart, cn + ["_salt"]).where(cond).select(QUERY_ID, TRAIN_ID, LABEL, p.dist().alias(DIST))
    results = [brute.rank_neighbours(pairs, k)]

    # 5. leftovers
    pending = qb.where(~F.col("_ok")).select(QUERY_ID, *qc)
    n_pending = pending.count()
    log.info("grid pending=%d", n_pending)
    if n_pending:
        from . import tiles, vectorized

        rest = Prepared(pending, train, d, p.exclude_self)
        if choose.Sizes(n_pending, n_train, d).query_bytes <= broadcast_max_bytes:
            results.append(vectorized.knn_vectorized(rest, k, n_replicated=n_pending, parallelism=parallelism))
        else:
            blocks = tiles.block_count(n_pending, d), tiles.block_count(n_train, d)
            results.append(tiles.knn_tiles(rest, k, query_blocks=blocks[0], train_blocks=blocks[1]))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def _equal_queries(crowd: DataFrame, qc: list[str]) -> DataFrame:
    """(q..., _point) of the points with more than ``BUSY_ROWS`` queries: at most
    one per ``BUSY_ROWS`` queries. Counted with map-side combine."""
    same = crowd.groupBy(*qc).agg(F.count(F.lit(1)).alias("_m"), F.min(QUERY_ID).alias("_point"))
    return same.where(F.col("_m") > BUSY_ROWS).select(*qc, "_point").persist(StorageLevel.MEMORY_AND_DISK)


def _answer_points(p: Prepared, points: DataFrame, members: DataFrame, train: DataFrame, k: int, n_points: int, n_train: int, limit: int, parallelism: int) -> DataFrame:
    """Neighbours of all queries that share a point: the point's own list, one
    longer where a query leaves out itself (train ids name rows), fanned out."""
    kk = k + (1 if p.exclude_self else 0)
    one = Prepared(points.withColumnRenamed("_point", QUERY_ID).select(QUERY_ID, *p.qcols), train, p.dim, False)
    if n_points * n_train <= choose.BRUTE_PAIRS_PER_CORE * parallelism and choose.Sizes(n_points, n_train, p.dim).query_bytes <= limit:
        from . import vectorized

        lists = vectorized.knn_vectorized(one, kk, n_replicated=n_points, parallelism=parallelism)
    else:
        lists = knn_grid(one, kk, broadcast_max_bytes=limit, parallelism=parallelism, collapse=False)
    lists = lists.withColumnRenamed(QUERY_ID, "_point").withColumnRenamed(RANK, "_at")
    if n_points * kk * choose.row_bytes(5) <= limit:
        lists = F.broadcast(lists)
    rows = members.join(lists, "_point")
    if not p.exclude_self:
        return rows.select(QUERY_ID, F.col("_at").alias(RANK), TRAIN_ID, LABEL, DIST)
    # a query's own row leaves the list; what lies behind it moves up
    own = members.join(lists.select("_point", F.col(TRAIN_ID).alias("_own"), F.col("_at").alias("_own_at")), "_point").where(F.col(QUERY_ID) == F.col("_own")).select(QUERY_ID, "_own_at")
    rows = rows.join(own, QUERY_ID, "left").where(F.col("_own_at").isNull() | (F.col("_at") != F.col("_own_at")))
    rank = F.col("_at") - F.when(F.col("_at") > F.col("_own_at"), 1).otherwise(0)
    return rows.select(QUERY_ID, rank.cast("long").alias(RANK), TRAIN_ID, LABEL, DIST).where(F.col(RANK) <= k)
