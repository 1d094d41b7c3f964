"""JOIN-1 as a bounded relation: all pairs within a radius.

Axes are cut into cells as wide as the radius. A query stays in its own cell; a
train row is copied to the cells of the box that the radius spans around it, on the
axes that are cut (at most ``AXES``, those with the most cells, so that a row has some
``3^AXES`` copies; the distance itself decides the others). Every pair within the
radius meets in exactly one cell, the query's, so nothing has to be made distinct.
Work and volume follow the number of pairs in neighbouring cells, not ``Q x N``; cells
with many rows of either side are cut into salts and parts that meet task by task.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import squared_euclidean
from ..functions.features import FeatureSpec
from ..plans import choose
from ..plans.grid import SLACK, _hot_cells, _spread_over_cells
from ..plans.prepare import DIST, LABEL, QUERY_ID, TRAIN_ID, prepare

#: At most this many axes are cut into cells.
AXES = 3


def pairs_within(
    queries: DataFrame,
    train: DataFrame,
    features: FeatureSpec,
    radius: float,
    *,
    query_id: str = "id",
    train_id: str | None = None,
    label: str | None = None,
    exclude_self: bool = False,
    dim: int | None = None,
    broadcast_max_bytes: int | None = None,
) -> DataFrame:
    """``query_id, train_id[, label], dist`` of every pair with ``dist <= radius``.

    Rows with a null id or a null or non-finite feature are in no pair; with
    ``label``, neither are train rows without one. ``exclude_self`` drops pairs of
    equal ids. Rows that repeat give pairs each."""
    if not (radius >= 0 and math.isfinite(radius)):
        raise ValueError(f"radius must be a finite number >= 0, got {radius!r}")
    spark = queries.sparkSession
    lab = label if label is not None else "__nolabel"
    t_in = train if label is not None else train.withColumn(lab, F.lit(0))
    p = prepare(queries, t_in, features, query_id=query_id, train_id=train_id, label=lab, dim=dim, exclude_self=exclude_self)
    limit = choose.broadcast_limit(spark, broadcast_max_bytes)
    q, t = p.queries, p.train
    # the axes with the largest spread, in one pass over the queries
    spread = q.agg(*[(F.max(c) - F.min(c)).alias(c) for c in p.qcols]).first()
    spans = [(float(spread[c]) if spread[c] is not None else 0.0) for c in p.qcols]
    axes = sorted(sorted(range(p.dim), key=lambda j: -spans[j])[:AXES])
    cn = [f"_c{i}" for i in range(len(axes))]
    if radius == 0:
        # equal coordinates: the cell is the point itself
        at = [F.col(p.qcols[j]).alias(c) for c, j in zip(cn, axes)]
        to = [F.col(p.tcols[j]).alias(c) for c, j in zip(cn, axes)]
        q, t = q.select("*", *at), t.select("*", *to)
    else:
        # an axis of more cells than a long counts is cut coarser
        width = [max(radius, spans[j] / 2.0**40) for j in axes]
        cell = lambda x, w: F.floor(x / F.lit(w))
        q = q.select("*", *[cell(F.col(p.qcols[j]), w).alias(c) for c, j, w in zip(cn, axes, width)])
        for c, j, w in zip(cn, axes, width):
            x = F.col(p.tcols[j])
            # the difference is rounded before it is compared: widen by far more
            reach = F.lit(radius) + (F.abs(x) + F.lit(radius)) * F.lit(SLACK)
            t = t.withColumn(c, F.explode(F.sequence(cell(x - reach, w), cell(x + reach, w))))
    both = t.select(*cn, F.lit(1).alias("_t"), F.lit(0).alias("_q")).unionByName(q.select(*cn, F.lit(0).alias("_t"), F.lit(1).alias("_q")))
    busy = both.groupBy(*cn).agg(F.sum("_t").alias("_n"), F.sum("_q").alias("_m"))
    hot = _hot_cells(busy, cn).persist(StorageLevel.MEMORY_AND_DISK)
    n_hot = hot.count()
    table = None if not n_hot else (F.broadcast(hot) if n_hot * choose.row_bytes(len(cn) + 2) <= limit else hot)
    t = _spread_over_cells(t, table, cn, TRAIN_ID, "_salts", "_parts")
    q = _spread_over_cells(q, table, cn, QUERY_ID, "_parts", "_salts")
    sq = squared_euclidean(p.qcols, p.tcols)
    cond = sq <= F.lit(radius * radius * (1.0 + 1e-12) + 1e-300)  # a superset, before the root
    if exclude_self:
        cond = cond & (F.col(QUERY_ID) != F.col(TRAIN_ID))
    # the copies are not in the size that Spark estimates: never a broadcast
    met = q.join(t.hint("merge"), [*cn, "_salt"]).where(cond).select(QUERY_ID, TRAIN_ID, *([LABEL] if label is not None else []), p.dist().alias(DIST))
    return met.where(F.col(DIST) <= F.lit(float(radius)))
