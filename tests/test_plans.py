"""T7 plan checks: partial top-k below the exchange, one exchange for the
vote, no cross join on the default path, pushdown and pruning at the scan."""

import io
from contextlib import redirect_stdout

import nearframe as nf
from nearframe.plans import brute
from nearframe.plans.prepare import prepare
from tests.conftest import SF


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top_k_has_partial_limit_before_exchange(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    p = prepare(e, e, "embedding", query_id="vec_id", exclude_self=True)
    txt = plan(brute.knn_broadcast(p, 3))
    assert "WindowGroupLimit" in txt and "Partial" in txt and "Final" in txt
    part = txt.index("Partial")
    assert txt.find("Exchange", 0, txt.index("Final")) != -1 or part < txt.index("Final")


def test_vote_reuses_query_partitioning(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    p = prepare(e, e, "embedding", query_id="vec_id", exclude_self=True)
    txt = plan(nf.majority_vote(brute.knn_broadcast(p, 3)))
    assert txt.count("Exchange hashpartitioning") <= 1 or txt.count("hashpartitioning(query_id") == 1


def test_default_low_dim_plan_has_no_cross_join(spark):
    part = spark.read.parquet(f"{SF}/part.parquet")
    nb = nf.knn_join(part, part, ["p_size", "p_retailprice"], 3, query_id="p_partkey", label="p_brand", exclude_self=True)
    txt = plan(nb)
    assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt


def test_scan_prunes_columns(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    p = prepare(li, li, ["l_quantity", "l_tax"], query_id="l_orderkey", label="l_returnflag")
    txt = plan(p.train)
    read = [line for line in txt.splitlines() if line.startswith("ReadSchema")]
    assert read and "l_shipdate" not in read[0] and "l_tax" in read[0]


def test_auto_choice_follows_checked_sizes():
    from nearframe.plans.choose import Sizes, choose

    limit = 128 << 20
    # small low-dimensional problem: brute force, smaller side replicated
    assert choose(Sizes(20_000, 20_000, 2), limit, 8) == ("vectorized", "train")
    assert choose(Sizes(20_000, 1_000, 2), limit, 8) == ("vectorized", "train")
    assert choose(Sizes(1_000, 20_000, 2), limit, 8) == ("vectorized", "queries")
    # large low-dimensional problem: grid, whatever fits
    assert choose(Sizes(600_000, 600_000, 4), limit, 8)[0] == "grid"
    assert choose(Sizes(10**9, 10**9, 4), limit, 1000)[0] == "grid"
    # wide vectors: replicate what fits, else packs by pivots
    assert choose(Sizes(10**5, 10**9, 64), limit, 1000) == ("vectorized", "queries")
    assert choose(Sizes(10**9, 10**9, 64), limit, 1000) == ("pivots", "queries")


def test_blocks_plan_is_equi_join_without_nested_loops(spark):
    """LAY-3: packed blocks meet by a cogroup on block ids, not by a
    nested-loop join."""
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    nb = nf.knn_join(e, e, "embedding", 3, query_id="vec_id", exclude_self=True, strategy="blocks")
    txt = plan(nb)
    assert "CartesianProduct" not in txt and "NestedLoopJoin" not in txt
    assert "_qb" in txt and "_tb" in txt
