"""S4 ``blocks`` (LAY-3): packed tiles of both sides, scored with NumPy.

Both sides are hash-split into blocks of at most about ``BLOCK_BYTES``, and each
block is packed into one row. A tile is one block of either side: the packed
rows are copied once per block of the other side and meet as one group, so a
task holds two blocks and one distance block, whatever the size of the tables.
Every tile keeps the k best of its queries; the partial limit of
``rank_neighbours`` merges the tiles of a task before the one exchange on
``query_id``. Nothing is collected or broadcast.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .brute import rank_neighbours
from .choose import row_bytes
from .kernel import Search
from .prepare import LABEL, QUERY_ID, TRAIN_ID, Prepared
from .vectorized import found_batch, matrix, neighbour_schema, pack_blocks, unpacked, values

BLOCK_BYTES = 8 << 20
#: At most this many rows of a side meet in a tile: some seconds of the kernel.
BLOCK_ROWS = 32_768

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def block_count(rows: int, dim: int) -> int:
    return max(1, -(-rows // max(1, min(BLOCK_ROWS, BLOCK_BYTES // row_bytes(dim + 2)))))


def _each(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def _tile(qcols: list[str], tcols: list[str], k: int, exclude_self: bool, schema: pa.Schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return schema.empty_table()
        # one packed row a side
        q, t = (unpacked(x.column("body")[0]) for x in (left, right))
        search = Search(matrix(q, qcols), values(q, QUERY_ID), k, exclude_self)
        search.push(matrix(t, tcols), values(t, TRAIN_ID), values(t, LABEL))
        return pa.Table.from_batches([found_batch(search, schema)])

    return run


def knn_tiles(p: Prepared, k: int, *, query_blocks: int, train_blocks: int) -> DataFrame:
    """Exact k nearest train rows of every query; packed volume moved is
    ``Q * train_blocks + N * query_blocks`` rows in ``query_blocks *
    train_blocks`` pairs of packs."""
    from pyspark.sql.pandas.types import to_arrow_schema

    q = pack_blocks(p.queries.select(QUERY_ID, *p.qcols), QUERY_ID, "_qb", query_blocks).withColumn("_tb", _each(train_blocks))
    t = pack_blocks(p.train.select(TRAIN_ID, LABEL, *p.tcols), TRAIN_ID, "_tb", train_blocks).withColumn("_qb", _each(query_blocks))
    out = neighbour_schema(p, with_rank=False)
    run = _tile(p.qcols, p.tcols, k, p.exclude_self, to_arrow_schema(out))
    tiles = q.groupBy("_qb", "_tb").cogroup(t.groupBy("_qb", "_tb")).applyInArrow(run, out)
    return rank_neighbours(tiles, k)
