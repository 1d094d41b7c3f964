"""Pick a JOIN-2 strategy from checked sizes.

Nothing is broadcast on an estimate: the candidate side is counted and its
byte size bounded (rows x width) before ``broadcast`` is requested. When no
side fits, the plan goes by pivots and packs; low-dimensional inputs
go to the exact grid search, whose work grows with the local density rather
than with ``Q x N``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .prepare import LABEL, Prepared

# Fixed defaults (override per call or with the session keys below).
DEFAULT_BROADCAST_MAX_BYTES = 128 * 1024 * 1024
BROADCAST_CONF_KEY = "nearframe.broadcast.maxBytes"
GRID_MAX_DIM = 8
# Brute force is cheaper than the grid's chain of jobs while the whole pair
# count is small per core: the NumPy kernel scores about 4e7-7e7 pairs/s per
# core at dimension <= 4, so this is 2-3 s of kernel time per core, against
# several seconds of fixed grid passes.
BRUTE_PAIRS_PER_CORE = 125_000_000


def row_bytes(n_fields: int) -> int:
    """UnsafeRow size of ``n_fields`` fixed-width fields plus the null bitset."""
    return 8 * ((n_fields + 63) // 64) + 8 * n_fields + 16


def broadcast_limit(spark: SparkSession, override: int | None = None) -> int:
    if override is not None:
        return int(override)
    v = spark.conf.get(BROADCAST_CONF_KEY, None)
    return int(v) if v else DEFAULT_BROADCAST_MAX_BYTES


def parallelism(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


@dataclass(frozen=True)
class Sizes:
    n_queries: int
    n_train: int
    dim: int

    @property
    def query_bytes(self) -> int:
        return self.n_queries * row_bytes(self.dim + 2)

    @property
    def train_bytes(self) -> int:
        return self.n_train * row_bytes(self.dim + 3)


def count_sides(queries: DataFrame, train: DataFrame, dim: int) -> Sizes:
    """Row counts of both prepared sides in one job (one aggregate over the
    union of two one-column projections; partial counts before the exchange)."""
    side = F.col("_s")
    both = queries.select(F.lit(0).alias("_s")).unionByName(train.select(F.lit(1).alias("_s")))
    row = both.agg(
        F.count(F.when(side == 0, 1)).alias("q"), F.count(F.when(side == 1, 1)).alias("t")
    ).first()
    return Sizes(int(row["q"]), int(row["t"]), dim)


def count_prepared(p: Prepared) -> Sizes:
    """Row counts of prepared sides; of one table that is both in one pass."""
    if p.both is None:
        return count_sides(p.queries, p.train, p.dim)
    row = p.both.agg(F.count(F.lit(1)).alias("q"), F.count(LABEL).alias("t")).first()
    return Sizes(int(row["q"]), int(row["t"]), p.dim)


def choose(sizes: Sizes, limit: int, cores: int = 8) -> tuple[str, str]:
    """(strategy, replicated side). Never a cross join on ``auto``:

    - low dimension and more pairs than ``BRUTE_PAIRS_PER_CORE * cores``:
      ``grid`` (equi-joins on cells, work ~ local density);
    - otherwise ``vectorized``, replicating the smaller side that passes the
      size check (LAY-2 when train, LAY-1 when queries);
    - neither fits: ``grid`` for low dimension, else ``pivots`` (packs by
      nearest pivot; a query meets those its k-th distance reaches).
    """
    small = sizes.n_queries * sizes.n_train <= BRUTE_PAIRS_PER_CORE * max(1, cores)
    fits = sizes.query_bytes <= limit or sizes.train_bytes <= limit
    if sizes.dim <= GRID_MAX_DIM and not (small and fits):
        return "grid", "queries"
    q_fits, t_fits = sizes.query_bytes <= limit, sizes.train_bytes <= limit
    if q_fits and t_fits:
        # replicate the smaller side; on a tie train, whose streamed query
        # tasks then hold final k-lists and need no merge exchange (LAY-2)
        return "vectorized", "train" if sizes.n_train <= sizes.n_queries else "queries"
    if q_fits:
        return "vectorized", "queries"
    if t_fits:
        return "vectorized", "train"
    return "pivots", "queries"
