"""Normalise query and train tables into the shapes every strategy consumes.

queries -> (query_id, q0 .. q{d-1})            doubles, only finite rows
train   -> (train_id, t0 .. t{d-1}, label)      doubles, only finite rows with a label

Rows with a null, NaN or infinite feature never become neighbours and never
get neighbours (contract C6); ``knn_classify`` brings such queries back with a
null prediction (C7).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import euclidean
from ..functions.features import VALID, FeatureSpec, feature_width, names, vectors_to_arrays, with_features

QUERY_ID = "query_id"
TRAIN_ID = "train_id"
LABEL = "label"
DIST = "dist"
RANK = "rank"


@dataclass(frozen=True)
class Prepared:
    queries: DataFrame  # query_id, q0..
    train: DataFrame  # train_id, t0.., label
    dim: int
    exclude_self: bool
    #: Where both sides are one table with the same ids: train_id, t0.., label of every
    #: query; those without a label are not train.
    both: DataFrame | None = None

    @property
    def qcols(self) -> list[str]:
        return names("q", self.dim)

    @property
    def tcols(self) -> list[str]:
        return names("t", self.dim)

    def dist(self):
        """The one distance expression used by every phase of every strategy."""
        return euclidean(self.qcols, self.tcols)


def prepare(
    queries: DataFrame,
    train: DataFrame,
    features: FeatureSpec,
    *,
    query_id: str = "id",
    train_id: str | None = None,
    label: str = "label",
    train_features: FeatureSpec | None = None,
    dim: int | None = None,
    exclude_self: bool = False,
) -> Prepared:
    """Validate widths (C10) and project both sides to the canonical shape."""
    train_id = train_id or query_id
    train_features = features if train_features is None else train_features
    same = train is queries and train_features == features
    queries = vectors_to_arrays(queries, features)
    train = queries if same else vectors_to_arrays(train, train_features)
    dq = feature_width(queries, features, dim)
    dt = dq if same else feature_width(train, train_features, dim)
    if dq != dt:
        raise ValueError(f"query width {dq} differs from train width {dt}")
    q = with_features(queries, [F.col(query_id).alias(QUERY_ID)], features, "q", dq)
    q = q.where(F.col(QUERY_ID).isNotNull() & F.col(VALID)).drop(VALID)
    t = with_features(train, [F.col(train_id).alias(TRAIN_ID), F.col(label).alias(LABEL)], train_features, "t", dt)
    t = t.where(F.col(TRAIN_ID).isNotNull() & F.col(LABEL).isNotNull() & F.col(VALID))
    t = t.select(TRAIN_ID, *names("t", dt), LABEL)
    both = None
    if same and train_id == query_id:
        both = with_features(queries, [F.col(query_id).alias(TRAIN_ID), F.col(label).alias(LABEL)], features, "t", dq)
        both = both.where(F.col(TRAIN_ID).isNotNull() & F.col(VALID)).select(TRAIN_ID, *names("t", dq), LABEL)
    return Prepared(q, t, dq, exclude_self, both)


def check_k(k: int) -> int:
    if not isinstance(k, int) or isinstance(k, bool) or k < 1:
        raise ValueError(f"k must be an integer >= 1, got {k!r}")
    return k
