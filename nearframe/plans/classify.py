"""API-1: kNN classification end to end.

    knn_join (JOIN-2) -> majority_vote (AGG-2) -> left join onto the queries

Every query row comes back (C7): one without usable features or without any
train row gets a null prediction. The join back needs only
``(query_id, true_label)`` from the query table; the votes are already
partitioned by ``query_id``, so only that narrow projection is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import FeatureSpec
from ..operators.neighbors import knn_prepared
from ..operators.vote import majority_vote
from .prepare import QUERY_ID, prepare


def knn_classify(
    queries: DataFrame,
    train: DataFrame,
    features: FeatureSpec,
    k: int,
    *,
    query_id: str = "id",
    train_id: str | None = None,
    label: str = "label",
    query_label: str | None = None,
    train_features: FeatureSpec | None = None,
    dim: int | None = None,
    exclude_self: bool = False,
    strategy: str = "auto",
    broadcast_max_bytes: int | None = None,
    **opts,
) -> DataFrame:
    """(query_id, [true_label,] prediction) for every query row.

    ``query_label`` names the true class on the query side; when it is given
    the output carries ``true_label`` for ``confusion_matrix`` / ``accuracy``.
    """
    p = prepare(
        queries, train, features, query_id=query_id, train_id=train_id, label=label,
        train_features=train_features, dim=dim, exclude_self=exclude_self,
    )
    nb = knn_prepared(p, k, strategy=strategy, broadcast_max_bytes=broadcast_max_bytes, **opts)
    votes = majority_vote(nb)
    cols = [F.col(query_id).alias(QUERY_ID)]
    if query_label is not None:
        cols.append(F.col(query_label).alias("true_label"))
    base = queries.select(*cols)
    return base.join(votes, QUERY_ID, "left")
