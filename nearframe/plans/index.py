"""A stored train side for the grid search (LAY-1, LAY-4).

``build_index`` cuts train into the grid's cells once and writes a folder:

    part    train rows with cell and salt, bucketed and sorted by (cell, salt)
    coarse  the bounded sample of each coarse cell
    hot     hot cells and their salts
    meta    one row: quantile knots, cells per axis, counts, widths

``load_index`` reads it back in any session: ``part`` is registered as an external
bucketed table, so later searches join it on (cell, salt) without an exchange or a
sort of train, and the quantile and count passes are not repeated.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import FeatureSpec
from . import choose
from .grid import BUSY_ROWS, HOT_ROWS, Grid, _cell_counts, _cells, _coarse_sample, _dedupe, _hot_cells, _names, _split, _spread_over_cells, plan_width
from .prepare import LABEL, TRAIN_ID, check_k, prepare


@dataclass
class TrainIndex:
    """A loaded index; pass it to ``knn_join(..., index=...)``."""

    path: str
    dim: int
    k: int
    grid: Grid


def build_index(
    train: DataFrame, features: FeatureSpec, path: str, k: int, *, train_id: str = "id", label: str = "label", dim: int | None = None,
    exclude_self: bool = False, buckets: int | None = None,
) -> TrainIndex:
    """Write the index of ``train`` to the new folder ``path`` and load it.

    It answers searches for up to ``k`` neighbours (``exclude_self`` keeps one more
    row of each point, so that leave-one-out searches can use it too)."""
    check_k(k)
    spark = train.sparkSession
    p = prepare(train, train, features, query_id=train_id, label=label, dim=dim, exclude_self=exclude_self)
    if p.dim > choose.GRID_MAX_DIM:
        raise ValueError(f"an index has at most {choose.GRID_MAX_DIM} dimensions, got {p.dim}")
    kk = k + (1 if exclude_self else 0)
    plan = plan_width(p, kk)
    d, tc, knots, cells = p.dim, p.tcols, plan["knots"], plan["cells"]
    cn = _names("_c", d)
    limit = choose.broadcast_limit(spark)
    rows = p.train.select(TRAIN_ID, *tc, LABEL)
    tcell = rows.select("*", *_cells(tc, knots, cells, "_c"))
    nobody = tcell.where(F.lit(False))
    busy = _cell_counts(tcell, nobody, cn).persist()
    most = busy.agg(F.count(F.lit(1)).alias("n"), F.max("_n").alias("t")).first()
    if most["n"]:
        quiet, crowd = _split(tcell, F.broadcast(busy) if most["n"] * choose.row_bytes(d + 2) <= limit else busy, cn)
        tcell = quiet.unionByName(_dedupe(crowd, tc, kk))
    hot = None
    if most["n"] and most["t"] > HOT_ROWS:
        _hot_cells(_cell_counts(tcell, nobody, cn), cn).write.parquet(f"{path}/hot")
        hot = spark.read.parquet(f"{path}/hot")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = _spread_over_cells(tcell, hot, cn, TRAIN_ID, "_salts", "_parts").repartition(buckets, *cn, "_salt")
    name = _table_name()
    # one task per bucket, so one sorted file per bucket
    part.write.bucketBy(buckets, *cn, "_salt").sortBy(*cn, "_salt").option("path", f"{path}/part").saveAsTable(name)
    stored = spark.table(name)
    _coarse_sample(stored.select(TRAIN_ID, *tc, LABEL), tc, knots, cells, kk).write.parquet(f"{path}/coarse")
    busy.unpersist()
    meta = {"dim": d, "k": k, "kk": kk, "n_train": plan["n"], "knots": knots, "cells": cells, "buckets": buckets, "hot": hot is not None, "schema": stored.schema.json()}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.text(f"{path}/meta")
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return load_index(spark, path)


def _table_name() -> str:
    return f"nearframe_index_{uuid.uuid4().hex}"


def load_index(spark: SparkSession, path: str) -> TrainIndex:
    """The index of a folder written by ``build_index``."""
    from pyspark.sql import types as T

    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    schema = T.StructType.fromJson(json.loads(meta["schema"]))
    d, name = meta["dim"], _table_name()
    keys = ", ".join([*_names("_c", d), "_salt"])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {meta['buckets']} BUCKETS LOCATION '{path}/part'")
    part = spark.table(name)
    hot = None
    if meta["hot"]:
        hot = spark.read.parquet(f"{path}/hot")
        # counted before it may be broadcast
        if hot.count() * choose.row_bytes(d + 2) <= choose.broadcast_limit(spark):
            hot = F.broadcast(hot)
    coarse = spark.read.parquet(f"{path}/coarse")
    knots = [[tuple(x) for x in axis] for axis in meta["knots"]]
    rows = part.select(TRAIN_ID, *_names("t", d), LABEL)
    grid = Grid(d, meta["kk"], meta["n_train"], knots, meta["cells"], part, coarse, hot, rows)
    return TrainIndex(path, d, meta["k"], grid)


__all__ = ["BUSY_ROWS", "TrainIndex", "build_index", "load_index"]
