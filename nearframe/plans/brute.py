"""Exhaustive kNN strategies: every (query, train) pair is scored.

S1 ``broadcast``  one side replicated (size checked by the caller), the other
                  streamed; per-task partial top-k, one exchange on query_id.
S2 ``bounded``    a hash-chosen train subset gives each query an exact upper
                  bound on its k-th distance; pairs above the bound are dropped
                  before anything is sorted.

S4 ``blocks``, where neither side fits a broadcast, is in ``tiles``.

All end in ``rank_neighbours``: ``row_number`` over ``(dist, train_id)``
with ``rank <= k``, which Spark plans as WindowGroupLimit(Partial) ->
Exchange(query_id) -> WindowGroupLimit(Final).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distance import is_finite, squared_euclidean
from .prepare import DIST, LABEL, QUERY_ID, RANK, TRAIN_ID, Prepared


def rank_neighbours(pairs: DataFrame, k: int) -> DataFrame:
    """Top-k per query by (dist, train_id); non-finite distances never rank (C6).

    Spark orders finite < +inf < NaN < null under ``asc_nulls_last``, so
    non-finite pairs can only fill slots after every finite one and are
    dropped after the window. Filtering them before the window would be
    pushed into the join and inline the distance expression twice more.
    """
    w = Window.partitionBy(QUERY_ID).orderBy(F.col(DIST).asc_nulls_last(), F.col(TRAIN_ID).asc())
    ranked = pairs.withColumn(RANK, F.row_number().over(w)).where(F.col(RANK) <= k)
    return ranked.where(is_finite(DIST)).select(
        QUERY_ID, F.col(RANK).cast("long").alias(RANK), TRAIN_ID, LABEL, DIST
    )


def within_bound(p: Prepared, bound: str = "bound") -> Column:
    """Pair filter ``dist <= bound`` evaluated on the squared distance.

    ``sqrt`` is correctly rounded and monotone, so every pair with
    ``sqrt(sq) <= b`` has ``sq <= b*b*(1 + 2^-52)``; the slack of 1e-12 keeps a
    superset, and the exact ranking happens later on ``dist``. The square
    root is then computed only for pairs that pass.
    """
    sq = squared_euclidean(p.qcols, p.tcols)
    b = F.col(bound)
    return sq <= b * b * F.lit(1.0 + 1e-12)


def spread(df: DataFrame, parallelism: int) -> DataFrame:
    """Give the streamed side at least ``parallelism`` partitions.

    Large inputs already arrive as many file splits and are left alone; a
    small file with one row group would otherwise run the whole pair scan
    as a single task.
    """
    if df.rdd.getNumPartitions() < parallelism:
        return df.repartition(parallelism)
    return df


def _not_self(p: Prepared) -> Column | None:
    return (F.col(QUERY_ID) != F.col(TRAIN_ID)) if p.exclude_self else None


def _pairs(stream: DataFrame, build: DataFrame, cond: Column | None, hint: str) -> DataFrame:
    build = build.hint(hint)
    return stream.join(build, cond, "inner") if cond is not None else stream.crossJoin(build)


def broadcast_pairs(p: Prepared, *, replicate: str = "queries", parallelism: int = 8) -> DataFrame:
    """JOIN-1 with FN-1: (query_id, train_id, label, dist) for all pairs.

    ``replicate="queries"`` streams train (LAY-1, LAY-5); ``"train"``
    streams the queries (LAY-2).
    """
    if replicate == "queries":
        stream, build = spread(p.train, parallelism), p.queries
    else:
        stream, build = spread(p.queries, parallelism), p.train
    joined = _pairs(stream, build, _not_self(p), "broadcast")
    return joined.select(QUERY_ID, TRAIN_ID, LABEL, p.dist().alias(DIST))


def knn_broadcast(p: Prepared, k: int, *, replicate: str = "queries", parallelism: int = 8) -> DataFrame:
    return rank_neighbours(broadcast_pairs(p, replicate=replicate, parallelism=parallelism), k)


def unit_hash(c: str, seed: int = 17) -> Column:
    """Deterministic value in [0, 1) from a column, stable across re-runs."""
    h = F.xxhash64(F.col(c), F.lit(seed))
    return (F.pmod(h, F.lit(1 << 30)).cast("double")) / float(1 << 30)


def subset_fraction(n_train: int, k: int, factor: float = 2.0, max_rows: int | None = None) -> float:
    """About ``factor * sqrt(k * N)`` rows: balances the bound pass (Q * s
    pairs, sorted) against the survivors of the filter (about Q * k * N / s)."""
    if n_train <= 0:
        return 1.0
    s = factor * math.sqrt(k * n_train)
    if max_rows is not None:
        s = min(s, max_rows)
    return min(1.0, max(s, 4.0 * k) / n_train)


def query_bounds(p: Prepared, subset: DataFrame, k: int, *, parallelism: int = 8) -> DataFrame:
    """(query_id, bound): the k-th smallest distance to ``subset``; +inf when
    the subset offers fewer than k finite distances for that query.

    Exact pruning: the k-th distance over any subset of train is >= the k-th
    distance over all of train, so ``dist <= bound`` keeps every neighbour,
    ties included.
    """
    sub = Prepared(p.queries, subset, p.dim, p.exclude_self)
    top = knn_broadcast(sub, k, replicate="train", parallelism=parallelism)
    agg = top.groupBy(QUERY_ID).agg(F.count(F.lit(1)).alias("_n"), F.max(DIST).alias("_kth"))
    return agg.select(
        QUERY_ID,
        F.when(F.col("_n") >= k, F.col("_kth")).otherwise(F.lit(float("inf"))).alias("bound"),
    )


def knn_bounded(
    p: Prepared,
    k: int,
    *,
    n_train: int,
    parallelism: int = 8,
    subset_rows: int | None = None,
) -> DataFrame:
    """S2: exact distance bound from a hash subset, then a pruned pair scan."""
    frac = subset_fraction(n_train, k, max_rows=subset_rows)
    subset = p.train.where(unit_hash(TRAIN_ID) < frac)
    bounds = query_bounds(p, subset, k, parallelism=parallelism)
    qb = p.queries.join(bounds, QUERY_ID, "left").fillna({"bound": float("inf")})
    cond = within_bound(p)
    if p.exclude_self:
        cond = cond & (F.col(QUERY_ID) != F.col(TRAIN_ID))
    pairs = _pairs(spread(p.train, parallelism), qb, cond, "broadcast")
    return rank_neighbours(pairs.select(QUERY_ID, TRAIN_ID, LABEL, p.dist().alias(DIST)), k)
