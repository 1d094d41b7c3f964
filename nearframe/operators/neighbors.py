"""Neighbour operators: pairs (JOIN-1), top-k (TOP-1, TOP-2), kNN join
(JOIN-2), label lookup (JOIN-3) and nested neighbour lists (AGG-3).

Output of ``knn_join``: one row per (query, neighbour)

    query_id, rank (1..k, long), train_id, label, dist (double)

ordered within a query by ``(dist, train_id)``: at equal distance the lower
train id ranks first (contract C3). Queries with fewer than k usable train
rows get the ones that exist (C5).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distance import squared_euclidean
from ..functions.features import FeatureSpec
from ..plans import brute, choose, grid
from ..plans.index import TrainIndex
from ..plans.prepare import DIST, LABEL, QUERY_ID, RANK, TRAIN_ID, Prepared, check_k, prepare

#: Options of the strategies, beside the parameters of ``knn_join``.
OPTIONS = {"replicate", "parallelism", "train_partitions", "query_partitions", "query_blocks", "train_blocks", "dedupe", "pivots", "pack_rows", "counter"}
STRATEGIES = ("auto", "broadcast", "broadcast_train", "bounded", "vectorized", "blocks", "pivots", "grid")


def pairwise_distances(
    queries: DataFrame,
    train: DataFrame,
    features: FeatureSpec,
    *,
    query_id: str = "id",
    train_id: str | None = None,
    label: str | None = None,
    squared: bool = False,
    exclude_self: bool = False,
    dim: int | None = None,
    broadcast_max_bytes: int | None = None,
) -> DataFrame:
    """JOIN-1 + FN-1/FN-2: every (query, train) pair with its distance.

    The output has one row per pair, so this is for inputs where that is
    the point (small tables, tests). One side must pass the broadcast size
    check and is replicated; otherwise this raises. For neighbours at any
    size use ``knn_join``, which never materialises the pairs.
    """
    spark = queries.sparkSession
    lab = label if label is not None else "__nolabel"
    t_in = train if label is not None else train.withColumn(lab, F.lit(0))
    p = prepare(queries, t_in, features, query_id=query_id, train_id=train_id, label=lab, dim=dim, exclude_self=exclude_self)
    limit = choose.broadcast_limit(spark, broadcast_max_bytes)
    par = choose.parallelism(spark)
    expr = squared_euclidean(p.qcols, p.tcols) if squared else p.dist()
    name = "sq_dist" if squared else DIST
    sizes = choose.Sizes(p.queries.count(), 0, p.dim)
    cond = (F.col(QUERY_ID) != F.col(TRAIN_ID)) if exclude_self else None
    if sizes.query_bytes <= limit:
        joined = brute._pairs(brute.spread(p.train, par), p.queries, cond, "broadcast")
    else:
        n_t = p.train.count()
        if choose.Sizes(0, n_t, p.dim).train_bytes > limit:
            raise ValueError("pairwise_distances: neither side fits the broadcast limit; use knn_join")
        joined = brute._pairs(brute.spread(p.queries, par), p.train, cond, "broadcast")
    cols = [QUERY_ID, TRAIN_ID] + ([LABEL] if label is not None else []) + [expr.alias(name)]
    return joined.select(*cols)


def top_k_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    order: Sequence[Column | str],
    k: int,
    rank_col: str = RANK,
) -> DataFrame:
    """TOP-1: the first k rows of each group under ``order``.

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit below
    the exchange, so at most k rows per group leave each map task.
    """
    check_k(k)
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
    return out.withColumn(rank_col, F.col(rank_col).cast("long"))


def merge_top_k(partials: DataFrame | Sequence[DataFrame], k: int) -> DataFrame:
    """TOP-2: merge partial neighbour lists (same schema as ``knn_join``)
    into the global k-list. Exact: the union is re-ranked, never overwritten
    slot by slot.
    """
    check_k(k)
    if isinstance(partials, DataFrame):
        allp = partials
    else:
        partials = list(partials)
        allp = partials[0]
        for more in partials[1:]:
            allp = allp.unionByName(more)
    cols = [QUERY_ID, TRAIN_ID, LABEL, DIST]
    return brute.rank_neighbours(allp.select(*cols), k)


def update_neighbours(
    stored: DataFrame, queries: DataFrame, new_train: DataFrame, features: FeatureSpec, k: int, *, query_id: str = "id", train_id: str | None = None, label: str = "label",
    train_features: FeatureSpec | None = None, dim: int | None = None, exclude_self: bool = False, broadcast_max_bytes: int | None = None,
) -> DataFrame:
    """TOP-2 over time: stored k-lists brought up to date with new train rows.

    The k-th distance of a full list bounds what can still enter it, so the new
    rows are cut into cells and every list's ball names the cells it touches: a new
    row reaches only the queries whose ball it lies in, and the old train rows are
    not read at all. Lists with fewer than k rows, and vectors too wide for cells,
    are searched among the new rows and merged. Equal to a full run over old and
    new rows, provided no train id occurs in both."""
    check_k(k)
    spark = queries.sparkSession
    p = prepare(
        queries, new_train, features, query_id=query_id, train_id=train_id, label=label,
        train_features=train_features, dim=dim, exclude_self=exclude_self,
    )
    limit, par = choose.broadcast_limit(spark, broadcast_max_bytes), choose.parallelism(spark)
    old = stored.select(QUERY_ID, TRAIN_ID, LABEL, DIST)
    if p.dim > choose.GRID_MAX_DIM:
        found = knn_prepared(p, k, broadcast_max_bytes=limit)
    else:
        full = old.groupBy(QUERY_ID).agg(F.count(F.lit(1)).alias("_n"), F.max(DIST).alias("_kth"))
        bounds = p.queries.select(QUERY_ID).join(full, QUERY_ID, "left")
        bounds = bounds.select(QUERY_ID, F.when(F.col("_n") >= k, F.col("_kth")).otherwise(F.lit(float("inf"))).alias("bound"))
        found = grid.knn_grid(p, k, broadcast_max_bytes=limit, parallelism=par, collapse=False, bounds=bounds)
    return merge_top_k([old, found.select(QUERY_ID, TRAIN_ID, LABEL, DIST)], k)


def _resolve(p: Prepared, k: int, strategy: str, limit: int, replicate: str, cores: int) -> tuple[str, str, choose.Sizes | None]:
    if strategy == "grid":
        # the grid counts train in its own planning pass and replicates
        # nothing whose size it has not checked
        return "grid", replicate, None
    sizes = choose.count_prepared(p)
    if strategy == "auto":
        strategy, replicate = choose.choose(sizes, limit, cores)
        if strategy == "grid":
            return "grid", replicate, sizes
    if strategy == "vectorized":
        # one replicated side is the special case: a larger one goes by pivots
        if (sizes.train_bytes if replicate == "train" else sizes.query_bytes) > limit:
            strategy = "pivots"
    elif strategy in ("broadcast", "bounded") and sizes.query_bytes > limit:
        raise ValueError(
            f"strategy {strategy!r} replicates the query side ({sizes.query_bytes} bytes) "
            f"beyond the broadcast limit ({limit}); use 'blocks' or 'grid'"
        )
    if strategy == "broadcast_train" and sizes.train_bytes > limit:
        raise ValueError(f"train side ({sizes.train_bytes} bytes) exceeds the broadcast limit ({limit})")
    return strategy, replicate, sizes


def knn_prepared(p: Prepared, k: int, *, strategy: str = "auto", broadcast_max_bytes: int | None = None, **opts) -> DataFrame:
    """JOIN-2 on already prepared sides (see ``plans.prepare``)."""
    check_k(k)
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; choose one of {STRATEGIES}")
    spark = p.queries.sparkSession
    limit = choose.broadcast_limit(spark, broadcast_max_bytes)
    unknown = set(opts) - OPTIONS
    if unknown:
        raise TypeError(f"unknown options {sorted(unknown)}; known are {sorted(OPTIONS)}")
    replicate = opts.pop("replicate", "queries")
    # LAY-1 splits train, LAY-2 the queries: the caller may set into how many parts
    parts = opts.pop("train_partitions", None), opts.pop("query_partitions", None)
    par = opts.pop("parallelism", None) or parts[replicate == "train"] or choose.parallelism(spark)
    strategy, replicate, sizes = _resolve(p, k, strategy, limit, replicate, par)
    if strategy == "broadcast":
        return brute.knn_broadcast(p, k, replicate="queries", parallelism=par)
    if strategy == "broadcast_train":
        return brute.knn_broadcast(p, k, replicate="train", parallelism=par)
    if strategy == "bounded":
        return brute.knn_bounded(p, k, n_train=sizes.n_train, parallelism=par)
    if strategy == "pivots":
        from ..plans import pivots

        more = {x: opts[x] for x in ("pivots", "pack_rows", "counter") if x in opts}
        found = pivots.knn_pivots(p, k, n_queries=sizes.n_queries, n_train=sizes.n_train, broadcast_max_bytes=limit, **more)
        if found is not None:
            return found
        strategy = "blocks"  # the table of packs is too large to broadcast
    if strategy == "blocks":
        from ..plans import tiles

        # bounded packs at any size; small inputs still give every core a tile
        qb = opts.get("query_blocks") or tiles.block_count(sizes.n_queries, p.dim)
        tb = opts.get("train_blocks") or max(tiles.block_count(sizes.n_train, p.dim), min(-(-par // qb), max(1, sizes.n_train)))
        return tiles.knn_tiles(p, k, query_blocks=qb, train_blocks=tb)
    if strategy == "vectorized":
        from ..plans import vectorized

        held = sizes.n_train if replicate == "train" else sizes.n_queries
        return vectorized.knn_vectorized(p, k, n_replicated=held, parallelism=par, replicate=replicate)
    if strategy == "grid":
        return grid.knn_grid(p, k, broadcast_max_bytes=limit, parallelism=par, dedupe=opts.get("dedupe", True), sizes=sizes)
    raise AssertionError(strategy)


def knn_join(
    queries: DataFrame,
    train: DataFrame | None,
    features: FeatureSpec,
    k: int,
    *,
    query_id: str = "id",
    train_id: str | None = None,
    label: str = "label",
    train_features: FeatureSpec | None = None,
    dim: int | None = None,
    exclude_self: bool = False,
    strategy: str = "auto",
    broadcast_max_bytes: int | None = None,
    index: TrainIndex | None = None,
    **opts,
) -> DataFrame:
    """JOIN-2: for every query its k nearest train rows.

    ``exclude_self=True`` drops the pair ``query_id == train_id``, which is
    leave-one-out when both sides are the same table.
    Strategies (all exact, same result): ``broadcast`` (S1), ``bounded``
    (S2), ``vectorized`` (S3, Arrow + NumPy), ``blocks`` (S4, packed tiles),
    ``pivots`` (partitions by nearest pivot, triangle-inequality bounds), ``grid``
    (exact cell search for low dimension), ``broadcast_train`` (LAY-2) and
    ``auto``. ``vectorized`` replicates one side while that passes the size
    check (``replicate="queries"``, LAY-1, or ``"train"``, LAY-2, with
    ``train_partitions`` / ``query_partitions``) and goes by pivots beyond it.

    Both sides are read more than once (sizes, bounds, candidates): a caller
    whose frames are costly to compute persists them first, or stores the train
    side once with ``build_index`` and passes ``index`` instead of ``train`` (LAY-4).
    """
    if index is not None:
        return _knn_indexed(queries, index, features, k, query_id=query_id, exclude_self=exclude_self, broadcast_max_bytes=broadcast_max_bytes)
    p = prepare(
        queries, train, features, query_id=query_id, train_id=train_id, label=label,
        train_features=train_features, dim=dim, exclude_self=exclude_self,
    )
    return knn_prepared(p, k, strategy=strategy, broadcast_max_bytes=broadcast_max_bytes, **opts)


def _knn_indexed(queries: DataFrame, index: TrainIndex, features: FeatureSpec, k: int, *, query_id: str, exclude_self: bool, broadcast_max_bytes: int | None) -> DataFrame:
    check_k(k)
    if k + int(exclude_self) > index.grid.kk:
        raise ValueError(f"the index keeps {index.grid.kk} rows of a point, too few for k={k}, exclude_self={exclude_self}")
    spark = queries.sparkSession
    p = prepare(queries, queries.withColumn("__label", F.lit(0)), features, query_id=query_id, label="__label", exclude_self=exclude_self)
    if p.dim != index.dim:
        raise ValueError(f"query width {p.dim} differs from the index's {index.dim}")
    limit = choose.broadcast_limit(spark, broadcast_max_bytes)
    return grid.search_grid(index.grid, Prepared(p.queries, index.grid.train, p.dim, exclude_self), k, broadcast_max_bytes=limit, parallelism=choose.parallelism(spark))


def attach_labels(neighbours: DataFrame, train: DataFrame, *, train_id: str = "id", label: str = "label") -> DataFrame:
    """JOIN-3: look the label of each neighbour up by train id.

    The train side is reduced to ``(train_id, label)`` before the equi-join.
    """
    lab = train.select(F.col(train_id).alias(TRAIN_ID), F.col(label).alias(LABEL))
    base = neighbours.drop(LABEL) if LABEL in neighbours.columns else neighbours
    return base.join(lab, TRAIN_ID, "left")


def neighbours_to_lists(neighbours: DataFrame) -> DataFrame:
    """AGG-3: one row per query with ``neighbours`` = array of struct
    (dist, train_id, label) sorted by (dist, train_id). At most k per query,
    so the list is bounded."""
    s = F.struct(F.col(DIST), F.col(TRAIN_ID), F.col(LABEL))
    return neighbours.groupBy(QUERY_ID).agg(F.array_sort(F.collect_list(s)).alias("neighbours"))


def lists_to_neighbours(lists: DataFrame) -> DataFrame:
    """AGG-3 inverse: explode lists back to ranked rows."""
    ex = lists.select(QUERY_ID, F.posexplode("neighbours").alias("_pos", "_n"))
    return ex.select(
        QUERY_ID,
        (F.col("_pos") + 1).cast("long").alias(RANK),
        F.col("_n.train_id").alias(TRAIN_ID),
        F.col("_n.label").alias(LABEL),
        F.col("_n.dist").alias(DIST),
    )


__all__ = [
    "pairwise_distances",
    "top_k_per_group",
    "merge_top_k",
    "knn_join",
    "knn_prepared",
    "attach_labels",
    "neighbours_to_lists",
    "lists_to_neighbours",
    "STRATEGIES",
]

