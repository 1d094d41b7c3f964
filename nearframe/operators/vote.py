"""Votes over neighbour rows (AGG-1, AGG-2).

The majority rule is contract C4: the most frequent class wins and a tie goes
to the lowest class. ``mode(label, deterministic=True)`` is exactly that rule,
and it is a hash aggregate over at most k rows per query on the ``query_id``
partitioning the top-k already produced, so no second exchange is planned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.prepare import LABEL, QUERY_ID


def vote_counts(neighbours: DataFrame) -> DataFrame:
    """AGG-1: (query_id, label, n) class histogram per query."""
    return neighbours.groupBy(QUERY_ID, LABEL).agg(F.count(F.lit(1)).alias("n"))


def majority_vote(neighbours: DataFrame, out: str = "prediction") -> DataFrame:
    """AGG-2: (query_id, prediction) with ties broken to the lowest class."""
    return neighbours.groupBy(QUERY_ID).agg(F.mode(F.col(LABEL), True).alias(out))
